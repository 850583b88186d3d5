"""Column statistics, range checks, and per-field per-band statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.functions.photometry import BANDS
from skyweave.functions.sky import LAYOUT_COLUMNS
from skyweave.functions.nested import nested_fields

# Columns per aggregation; each group of columns is one scan that reads only those columns.
COLUMNS_PER_PASS = 64

# Accepted closed range of each kind of value.
VALUE_RANGES = {
    "RIGHT ASCENSION": (0.0, 360.0),
    "DECLINATION": (-90.0, 90.0),
    "FLUX": (-100_000_000.0, 100_000_000.0),
    "FLUX ERROR": (0.0, 100_000_000.0),
    "MJD": (60600.0, 60700.0),
}

# The named fields, (ra, dec) in degrees, and the radius round them.
SKY_FIELDS = {
    "ECDFS": (53.13, -28.10),
    "EDFS": (59.10, -48.73),
    "SV_38_7": (37.86, 6.98),
    "SV_95_-25": (95.00, -25.00),
    "47_Tuc": (6.02, -72.08),
    "Fornax_dSph": (40.00, -34.45),
}
FIELD_RADIUS_ARCSEC = 7200.0


def _numbers_only(field: T.StructField, value: Column) -> Column:
    """NaN as null, so that no aggregate sees it."""
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns, without layout columns, ids (``…Id``) and magnitudes (``…Mag…``)."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
        and f.name not in LAYOUT_COLUMNS
        and not f.name.endswith("Id")
        and "Mag" not in f.name
    ]


def column_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, min_value, max_value, null_count, n_rows``, one row per column.

    Minimum and maximum are text, since columns differ in type, and null for nested columns.
    NaN counts as no value for the extremes and is not a null.
    """
    wanted = [f for f in df.schema.fields if columns is None or f.name in columns]
    passes = [wanted[i : i + COLUMNS_PER_PASS] for i in range(0, len(wanted), COLUMNS_PER_PASS)]
    result = None
    for fields in passes:
        aggregates = [F.count(F.lit(1)).alias("n_rows")]
        for i, field in enumerate(fields):
            value = _numbers_only(field, F.col(f"`{field.name}`"))
            aggregates.append(F.count_if(F.col(f"`{field.name}`").isNull()).alias(f"_null{i}"))
            if nested_fields(df, field.name):
                aggregates += [F.lit(None).cast("string").alias(f"_{m}{i}") for m in ("min", "max")]
            else:
                aggregates.append(F.min(value).cast("string").alias(f"_min{i}"))
                aggregates.append(F.max(value).cast("string").alias(f"_max{i}"))
        rows = F.array(
            *[
                F.struct(
                    F.lit(field.name).alias("column"),
                    F.col(f"_min{i}").alias("min_value"),
                    F.col(f"_max{i}").alias("max_value"),
                    F.col(f"_null{i}").alias("null_count"),
                    "n_rows",
                )
                for i, field in enumerate(fields)
            ]
        )
        part = df.agg(*aggregates).select(F.inline(rows))
        result = part if result is None else result.unionByName(part)
    return result


def _is_summable(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType) and not isinstance(kind, T.DecimalType)


def partition_statistics(df: DataFrame, by: Sequence[str] = ("Norder", "Dir", "Npix")) -> DataFrame:
    """One row for each partition: ``n_rows`` and, for each column, a struct of what can be merged.

    The struct ``stat_{column}`` has ``min_value, max_value`` in the column's own type, ``null_count``,
    and for numbers ``total`` and ``n_values``, which leave out null and NaN. Layout columns and the fields
    of nested columns have no extremes.
    """
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for field in df.schema.fields:
        if field.name in by:
            continue
        column = F.col(f"`{field.name}`")
        parts = [F.count_if(column.isNull()).alias("null_count")]
        if not nested_fields(df, field.name):
            value = _numbers_only(field, column)
            parts += [F.min(value).alias("min_value"), F.max(value).alias("max_value")]
            if _is_summable(field.dataType):
                parts += [F.coalesce(F.sum(value.cast("double")), F.lit(0.0)).alias("total"), F.count(value).alias("n_values")]
        aggregates.append(F.struct(*parts).alias(f"stat_{field.name}"))
    return df.groupBy(*by).agg(*aggregates)


def merged_statistics(kept: DataFrame, schema: T.StructType) -> DataFrame:
    """``column_statistics`` of the rows behind some ``partition_statistics``, and ``mean_value`` of numbers."""
    total = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
    aggregates, rows = [total], []
    for i, field in enumerate(f for f in schema.fields if f"stat_{f.name}" in kept.columns):
        own = f"`stat_{field.name}`"
        names = kept.schema[f"stat_{field.name}"].dataType.fieldNames()
        nothing = F.lit(None).cast("string")
        low = F.min(F.col(f"{own}.min_value")).cast("string") if "min_value" in names else nothing
        high = F.max(F.col(f"{own}.max_value")).cast("string") if "max_value" in names else nothing
        mean = F.try_divide(F.sum(f"{own}.total"), F.sum(f"{own}.n_values")) if "total" in names else F.lit(None).cast("double")
        nulls = F.coalesce(F.sum(f"{own}.null_count"), F.lit(0))
        aggregates += [low.alias(f"_min{i}"), high.alias(f"_max{i}"), nulls.alias(f"_null{i}"), mean.alias(f"_mean{i}")]
        rows.append(F.struct(
            F.lit(field.name).alias("column"), F.col(f"_min{i}").alias("min_value"), F.col(f"_max{i}").alias("max_value"),
            F.col(f"_null{i}").alias("null_count"), "n_rows", F.col(f"_mean{i}").alias("mean_value"),
        ))
    return kept.agg(*aggregates).select(F.inline(F.array(*rows)))


def without_magnitudes(statistics: DataFrame) -> DataFrame:
    return statistics.where(~F.col("column").contains("Mag"))


def range_checks(statistics: DataFrame, columns_of_kind: Mapping[str, Sequence[str]]) -> DataFrame:
    """Whether the values of each listed column lie in the range of its kind.

    A kind without columns is skipped. Gives ``column, kind, min_value, max_value, in_range``;
    a column without values is in range.
    """
    rules = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(kind).alias("kind"),
            F.lit(VALUE_RANGES[kind][0]).alias("low"),
            F.lit(VALUE_RANGES[kind][1]).alias("high"),
        )
        for kind, columns in columns_of_kind.items()
        for column in columns
    ]
    listed = [column for columns in columns_of_kind.values() for column in columns]
    own = F.filter(F.array(*rules), lambda rule: rule["column"] == F.col("column"))
    checked = statistics.where(F.col("column").isin(listed)).withColumn("_rule", F.explode(own))
    low, high = F.col("min_value").cast("double"), F.col("max_value").cast("double")
    outside = (low < F.col("_rule.low")) | (high > F.col("_rule.high"))
    return checked.select(
        "column",
        F.col("_rule.kind").alias("kind"),
        low.alias("min_value"),
        high.alias("max_value"),
        (~F.coalesce(outside, F.lit(False))).alias("in_range"),
    )


def null_report(statistics: DataFrame) -> DataFrame:
    """Columns with nulls, their number and percentage of the rows, highest first."""
    percent = F.try_divide(F.col("null_count") * 100.0, F.col("n_rows"))
    rows = statistics.where(F.col("null_count") > 0)
    return rows.select("column", "null_count", percent.alias("percent")).orderBy(
        F.desc("percent"), "column"
    )


# ---------------------------------------------------------------------------------------------
# band statistics


def without_sky_sources(df: DataFrame) -> DataFrame:
    """Rows that are no sky sources; rows where that is unknown go too."""
    return df.where(~F.col("sky_source")) if "sky_source" in df.columns else df


def band_statistics(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bands: Sequence[str] = BANDS
) -> DataFrame:
    """Mean, minimum and maximum of each column per band, NaN left out, and ``len``.

    ``len`` counts rows whose ``x`` is a number, or all rows where there is no ``x``.
    """
    rows = without_sky_sources(df).where(F.col("band").isin(list(bands)))
    if "x" in df.columns:
        x = F.col("x")
        size = F.count_if(x.isNotNull() & ~F.isnan(x.cast("double")))
    else:
        size = F.count(F.lit(1))
    aggregates = [size.alias("len")]
    for column in columns:
        value = _numbers_only(df.schema[column], F.col(column)).cast("double")
        aggregates += [
            F.avg(value).alias(f"mean_{column}"),
            F.min(value).alias(f"min_{column}"),
            F.max(value).alias(f"max_{column}"),
        ]
    return rows.groupBy(*by, "band").agg(*aggregates)


def combine_band_statistics(parts: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Weighted combination of per-partition band statistics.

    The weight is the row count ``len`` of a partition, not the number of values of the column;
    with missing values the mean therefore differs from the plain mean. Bands whose weights sum
    to zero are left out.
    """
    weight = F.sum("len")
    aggregates = [weight.alias("len")]
    for column in columns:
        weighted = F.coalesce(F.sum(F.col(f"mean_{column}") * F.col("len")), F.lit(0.0))
        aggregates += [
            F.try_divide(weighted, weight).alias(f"mean_{column}"),
            F.min(f"min_{column}").alias(f"min_{column}"),
            F.max(f"max_{column}").alias(f"max_{column}"),
        ]
    return parts.groupBy(*by, "band").agg(*aggregates).where(F.col("len") > 0)


def field_report(statistics: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Statistics as rows (``mean_{column}_{band}`` …), fields as columns."""
    names = [f"{kind}_{column}" for column in columns for kind in ("mean", "min", "max")]
    long = statistics.unpivot(["field", "band"], names, "_name", "_value")
    statistic = F.concat_ws("_", "_name", "band").alias("statistic")
    return (
        long.select("field", statistic, "_value")
        .groupBy("statistic")
        .pivot("field", list(fields))
        .agg(F.first("_value"))
    )


# ---------------------------------------------------------------------------------------------
# file sizes


def size_histogram(sizes: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Rows per equal-width bin between the minimum and the maximum: ``bin, low, high, n``.

    The last bin includes the maximum; equal values get bins of a total width of one round
    the value. Empty bins are listed.
    """
    ends = sizes.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    ends = ends.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    ends = ends.where(F.col("lo").isNotNull())
    span = ends.select(F.struct("lo", "hi")).scalar()
    bucket = F.least(F.width_bucket(F.col(value).cast("double"), span["lo"], span["hi"], F.lit(bins)), F.lit(bins))
    counted = sizes.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    edges = ends.select("lo", width.alias("w"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    edges = edges.select(
        "bin",
        (F.col("lo") + F.col("w") * (F.col("bin") - 1)).alias("low"),
        (F.col("lo") + F.col("w") * F.col("bin")).alias("high"),
    )
    joined = edges.join(counted.where(F.col("bin").isNotNull()), "bin", "left")
    return joined.select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))
