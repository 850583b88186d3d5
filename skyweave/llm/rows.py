"""Shared column expressions and distributed running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.runtime import materialize, scratch_path

# ASCII white space, as a Java regular expression.
SPACES = "[\\x20\\x09-\\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"

_IN_PARTITION = (1 << 33) - 1


# Narrow rows that one task writes at least, where their number is known.
TASK_ROWS = 16_384


def written(df: DataFrame, name: str, n_rows: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, read again.

    For tables that stand several times in one plan; Spark 4.1 does not carry the constraints of a
    checkpoint over to its copies there. With ``n_rows``, about the number of narrow rows it has and is
    made from, a small table is one of few files, whatever the number of shuffle partitions.
    """
    if n_rows is not None:
        df = df.coalesce(1 + n_rows // TASK_ROWS)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: Column) -> Column:
    """The text, or an empty string for null."""
    return F.coalesce(column, F.lit(""))


def words(column: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.array_remove(F.split(text_of(column), SPACES), "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


# Numbers in one stretch of a running total.
STRETCH = 256


def running_totals(numbers: Column) -> Column:
    """For each whole number of an array the total up to it; null for null, empty for empty.

    Totals run inside stretches and over the stretches, so no array of the whole length is copied for
    each number.
    """

    def run(values: Column) -> Column:
        empty = F.array().cast("array<int>")
        last = lambda sums: F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0))
        return F.aggregate(values, empty, lambda sums, n: F.concat(sums, F.array((last(sums) + n).cast("int"))))

    def shifted(stretches: Column) -> Column:
        totals = run(F.transform(stretches, lambda s: F.get(s, F.size(s) - 1)))
        before = lambda t, i: F.when(i > 0, F.get(t, i - 1)).otherwise(0)
        return let(
            totals, lambda t: F.flatten(F.transform(stretches, lambda s, i: let(before(t, i), lambda b: F.transform(s, lambda n: n + b))))
        )

    def totals(values: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(values), F.lit(STRETCH)), lambda i: i < F.size(values))
        return let(F.transform(starts, lambda i: run(F.slice(values, i + 1, F.lit(STRETCH)))), shifted)

    return let(numbers, totals)


def cumulate(
    df: DataFrame, order_by: Sequence[str], value: str, within: Sequence[str] = (), prefix: str = "_"
) -> DataFrame:
    """Add each row's rank and the total of ``value`` before it, within its key and in the given order.

    Adds ``<prefix>rank`` and ``<prefix>before``, both from 0. A range shuffle splits even a key
    that holds most rows over many tasks; a running total over the ranges of each key (at most one
    row for each key and shuffle partition) gives every range its start. Rows that tie in all keys
    are told apart by a number fixed by the first checkpoint, which also spreads them.
    """
    salted = materialize(df.withColumn("_salt", F.monotonically_increasing_id()))
    keys = [*within, *order_by, "_salt"]
    ranged = materialize(
        salted.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_salt")
        .withColumns({
            "_range": F.spark_partition_id(),
            "_index": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)),
        })
    )
    spans = ranged.groupBy(*within, "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(
        *within,
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_total"),
    )
    inside = Window.partitionBy(*within, "_range").orderBy("_index")
    counted = ranged.withColumns({
        "_place": F.row_number().over(inside) - 1,
        "_part": F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*within, "_range")]
    return counted.alias("a").join(starts.alias("b"), same).select(
        *[f"a.{c}" for c in df.columns],
        (F.col("_rows") + F.col("_place")).alias(f"{prefix}rank"),
        (F.col("_total") + F.col("_part")).alias(f"{prefix}before"),
    )
