"""Column statistics, checks and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions.labels import readable_size
from skyweave.operators.keys import duplicate_keys, join_features, missing_keys
from skyweave.operators.statistics import (
    VALUE_RANGES,
    column_statistics,
    null_report,
    range_checks,
    without_magnitudes,
)
from skyweave.operators.calibration import add_magnitudes
from skyweave.queries import fixtures as data
from skyweave.queries import sql
from skyweave.queries.registry import query
from skyweave.runtime import scratch_path
from skyweave.sources.exports import write_statistics

# Some values missing, and the time of a fifth of the rows set beyond the accepted range.
_CHECKED_COLUMNS = ("coord_ra", "coord_dec", "psfFlux", "psfFluxErr", "psfDiffFlux", "midpointMjdTai")


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ra, dec = data.position(F.col("objectId"))
    error, visit = F.col("psfFluxErr"), F.col("visit")
    return data.forced_sources(spark, sf_dir).select(
        ra.alias("coord_ra"),
        dec.alias("coord_dec"),
        F.when(F.col("detector") != 3, F.col("psfFlux")).alias("psfFlux"),
        F.when(error != 0, error).alias("psfFluxErr"),
        "psfDiffFlux",
        (60600.5 + visit % 100 + F.when(visit % 5 == 0, 50.0).otherwise(0.0)).alias("midpointMjdTai"),
    )


_CHECKED = f"""
SELECT ra AS coord_ra, dec AS coord_dec, CASE WHEN detector <> 3 THEN psfFlux END AS psfFlux,
       nullif(psfFluxErr, 0) AS psfFluxErr, psfDiffFlux,
       60600.5::DOUBLE + visit % 100 + CASE WHEN visit % 5 = 0 THEN 50 ELSE 0 END AS midpointMjdTai
FROM (SELECT *, {sql.position('objectId')} FROM ({sql.FORCED}))"""

_STATS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", min({c}) AS min_value, max({c}) AS max_value,"
    f" count(*) - count({c}) AS null_count, count(*) AS n_rows FROM t"
    for c in _CHECKED_COLUMNS
)


@query(f"WITH t AS ({_CHECKED}) {_STATS}")
def column_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum, maximum and nulls of every column; magnitudes are left out."""
    rows = add_magnitudes(_checked(spark, sf_dir), ["psf"])
    stats = without_magnitudes(column_statistics(rows))
    return stats.select(
        "column",
        F.col("min_value").cast("double").alias("min_value"),
        F.col("max_value").cast("double").alias("max_value"),
        "null_count",
        "n_rows",
    )


_KINDS = {
    "RIGHT ASCENSION": ["coord_ra"],
    "DECLINATION": ["coord_dec"],
    "FLUX": ["psfFlux", "psfDiffFlux"],
    "FLUX ERROR": ["psfFluxErr"],
    "MJD": ["midpointMjdTai"],
}
_RANGES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{kind}' AS kind, min({c}) AS min_value, max({c}) AS max_value,"
    f" NOT (min({c}) < {VALUE_RANGES[kind][0]} OR max({c}) > {VALUE_RANGES[kind][1]}) AS in_range FROM t"
    for kind, columns in _KINDS.items()
    for c in columns
)


@query(f"WITH t AS ({_CHECKED}) {_RANGES}")
def value_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each column keeps to the range of its kind; the times do not."""
    return range_checks(column_statistics(_checked(spark, sf_dir)), _KINDS)


@query(f"""
WITH t AS ({_CHECKED}), s AS ({_STATS})
SELECT "column", null_count, round(null_count * 100.0::DOUBLE / n_rows, 6) AS percent FROM s WHERE null_count > 0""")
def null_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns with nulls and their share, highest first."""
    report = null_report(column_statistics(_checked(spark, sf_dir)))
    return report.withColumn("percent", F.round("percent", 6))


@query(f"WITH t AS ({_CHECKED}) {_STATS}")
def stored_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a table written and read back."""
    path = scratch_path(spark, "statistics")
    write_statistics(column_statistics(_checked(spark, sf_dir)), path)
    return spark.read.parquet(path).select(
        "column", F.col("min_value").cast("double").alias("min_value"), F.col("max_value").cast("double").alias("max_value"),
        "null_count", "n_rows",
    )


@query("""
SELECT o_orderkey, CASE WHEN b = 1 THEN '1 Byte' WHEN b < 1024 THEN printf('%.0f Bytes', b)
       WHEN b < 1048576 THEN printf('%.1f KiB', b / 1024) WHEN b < 1073741824 THEN printf('%.1f MiB', b / 1048576)
       ELSE printf('%.1f GiB', b / 1073741824) END AS size
FROM (SELECT o_orderkey, floor(o_totalprice)::BIGINT * CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 3 = 1 THEN 977
             ELSE 99991 END::DOUBLE AS b FROM orders)""")
def readable_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte counts of very different sizes as text."""
    key = F.col("o_orderkey")
    factor = F.when(key % 3 == 0, 1).when(key % 3 == 1, 977).otherwise(99991)
    n_bytes = F.floor("o_totalprice") * factor
    return data.table(spark, sf_dir, "orders").select("o_orderkey", readable_size(n_bytes).alias("size"))


@query(f"""
SELECT visit, detector, count(*) AS n_rows FROM ({sql.FORCED}) s
WHERE NOT EXISTS (SELECT 1 FROM ({sql.VISIT_DETECTORS}) v
                  WHERE v.visitId = s.visit AND v.detector = s.detector AND v.seeing IS NOT NULL)
GROUP BY visit, detector""")
def missing_feature_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(visit, detector) pairs of sources for which no seeing was measured."""
    known = data.visit_detectors(spark, sf_dir).where(F.col("seeing").isNotNull())
    known = known.withColumnRenamed("visitId", "visit")
    return missing_keys(data.forced_sources(spark, sf_dir), known, ["visit", "detector"])


@query(f"""
SELECT objectId, detector, count(*) AS n_rows FROM ({sql.FORCED}) GROUP BY objectId, detector HAVING count(*) > 1""")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(object, detector) pairs that occur more than once."""
    return duplicate_keys(data.forced_sources(spark, sf_dir), ["objectId", "detector"])


@query(f"""
SELECT s.objectId, s.sourceId, s.visit, s.detector, v.skyBg, v.expTime
FROM ({sql.FORCED}) s JOIN ({sql.VISIT_DETECTORS}) v ON v.visitId = s.visit AND v.detector = s.detector""")
def complete_feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with the conditions of their visit and detector, every one of which must be known."""
    features = data.visit_detectors(spark, sf_dir).select(
        F.col("visitId").alias("visit"), "detector", "skyBg", "expTime"
    )
    sources = data.forced_sources(spark, sf_dir).select("objectId", "sourceId", "visit", "detector")
    return join_features(sources, features, ["visit", "detector"])
