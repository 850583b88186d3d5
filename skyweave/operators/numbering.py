"""Row numbers over data too large, or too skewed, for one window partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.runtime import broadcast_checked, materialize

_IN_PARTITION = (1 << 33) - 1


def number_rows(
    df: DataFrame, order_by: Sequence[Column | str], within: Sequence[str] = (), out: str = "_row"
) -> DataFrame:
    """Number rows from 0 in the given order, restarting for each ``within`` key.

    A range shuffle splits even a single hot key over many tasks; each row's number is its rank
    in its own range plus the rows of its key in earlier ranges. The first checkpoint fixes the
    tie-breaking number, which spreads rows that tie in all keys; the second fixes the ranges.
    """
    salted = materialize(df.withColumn("_salt", F.monotonically_increasing_id()))
    keys = [F.col(c) if isinstance(c, str) else c for c in (*within, *order_by)]
    ranged = materialize(
        salted.repartitionByRange(*keys, F.col("_salt"))
        .sortWithinPartitions(*keys, F.col("_salt"))
        .drop("_salt")
        .withColumns(
            {
                "_range": F.spark_partition_id(),
                "_index": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)),
            }
        )
    )
    # One row per key and range; a key spans many ranges only if it is hot, so the window over
    # the ranges of a key is never longer than the number of shuffle partitions.
    spans = ranged.groupBy("_range", *within).agg(
        F.min("_index").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    same = ["_range", *within]
    joined = ranged.alias("a").join(
        broadcast_checked(starts).alias("b"),
        [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in same],
    )
    number = F.col("_index") - F.col("_first") + F.col("_before")
    return joined.select(*[f"a.{c}" for c in df.columns], number.alias(out))


def number_groups(df: DataFrame, keys: Sequence[str], out: str = "group_no") -> DataFrame:
    """Distinct non-null key groups, numbered from 0 in sorted key order."""
    complete = df.select(*keys).dropna().distinct()
    return number_rows(complete, list(keys), out=out)


def zip_by_position(left: DataFrame, right: DataFrame, position: str = "_row") -> DataFrame:
    """Side-by-side rows of equal position; a row without a partner is an error."""
    message = F.lit("the two tables have unequal lengths")
    both = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), position, "full")
    paired = F.when(F.col("_l").isNull() | F.col("_r").isNull(), F.raise_error(message))
    return both.where(F.coalesce(paired.cast("boolean"), F.lit(True))).drop("_l", "_r")
