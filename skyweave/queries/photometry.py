"""Calibration and nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions.nested import (
    assign_fields,
    available_columns,
    drop_fields,
    flatten,
    full_column_names,
    nest,
    select_columns,
)
from skyweave.operators.calibration import add_magnitudes, add_visit_time, calibrate, narrow_floats
from skyweave.operators.nesting import MAX_ROWS_PER_PART, PART, nest_sources, resort_nested
from skyweave.operators.statistics import band_statistics
from skyweave.queries import fixtures as data
from skyweave.queries import sql
from skyweave.queries.registry import query


def _floats(*columns: str):
    """Results whose last bits depend on the order of summation, at single precision."""
    return [F.col(c).cast("float").alias(c) for c in columns]


@query(f"""
SELECT objectId, ({sql.magnitude('psfFlux')})::FLOAT AS psfMag,
       ({sql.magnitude_error('psfFlux', 'psfFluxErr')})::FLOAT AS psfMagErr,
       ({sql.magnitude('kronFlux')})::FLOAT AS kronMag
FROM ({sql.SIGNED})""")
def ab_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Magnitudes of signed, zero and missing fluxes, with errors where the table has them."""
    rows = add_magnitudes(data.signed_fluxes(spark, sf_dir), ["psf", "kron"])
    return rows.select("objectId", "psfMag", "psfMagErr", "kronMag")


@query(f"""
SELECT psfFlux::FLOAT AS psfFlux, psfFluxErr::FLOAT AS psfFluxErr, kronFlux::FLOAT AS kronFlux, objectId
FROM ({sql.SIGNED})""")
def narrow_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles cast to floats, apart from those that need the precision."""
    return narrow_floats(data.signed_fluxes(spark, sf_dir))


@query(f"""
SELECT s.objectId, s.sourceId, s.visit, s.detector, v.expMidptMJD AS midpointMjdTai
FROM (SELECT * REPLACE (CASE WHEN visit % 9 = 0 THEN -visit ELSE visit END AS visit) FROM ({sql.FORCED})) s
LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId""")
def visit_time_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time of each source's visit; every ninth visit has an unknown number."""
    sources = data.forced_sources(spark, sf_dir).drop("midpointMjdTai")
    odd = F.when(F.col("visit") % 9 == 0, -F.col("visit")).otherwise(F.col("visit"))
    rows = add_visit_time(sources.withColumn("visit", odd), data.visits(spark, sf_dir))
    return rows.select("objectId", "sourceId", "visit", "detector", "midpointMjdTai")


_CALIBRATED = f"""
SELECT s.objectId, s.sourceId, s.visit, s.detector, s.band, s.psfFlux::FLOAT AS psfFlux,
       s.psfFluxErr::FLOAT AS psfFluxErr, v.expMidptMJD AS midpointMjdTai,
       ({sql.magnitude('psfFlux')})::FLOAT AS psfMag,
       ({sql.magnitude_error('psfFlux', 'psfFluxErr')})::FLOAT AS psfMagErr
FROM ({sql.FORCED}) s LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId"""


@query(_CALIBRATED)
def calibrate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole post-processing of a source table."""
    sources = data.forced_sources(spark, sf_dir).drop(
        "midpointMjdTai", "psfDiffFlux", "psfDiffFluxErr", "quantity"
    )
    rows = calibrate(sources, ["psf"], data.visits(spark, sf_dir))
    return rows.select(
        "objectId", "sourceId", "visit", "detector", "band", "psfFlux", "psfFluxErr", "midpointMjdTai",
        "psfMag", "psfMagErr",
    )


def light_curves(spark: SparkSession, sf_dir: str, how: str = "left", max_rows: int = MAX_ROWS_PER_PART) -> DataFrame:
    return nest_sources(
        data.objects(spark, sf_dir),
        [data.forced_sources(spark, sf_dir), data.detections(spark, sf_dir)],
        on="objectId",
        into=["forced", "detected"],
        sort_by="midpointMjdTai",
        tie_break=[*data.FORCED_TIES, "detectionId"],
        how=how,
        max_rows=max_rows,
    )


_NESTED = f"""
SELECT objectId, row_number() OVER (PARTITION BY objectId ORDER BY midpointMjdTai NULLS LAST,
       {sql.FORCED_TIES}) - 1 AS pos, sourceId, visit, detector, band, midpointMjdTai, psfFlux, psfFluxErr
FROM ({sql.FORCED})"""


def _opened(spark: SparkSession, sf_dir: str, max_rows: int) -> DataFrame:
    nested = nest_sources(
        data.objects(spark, sf_dir),
        [data.forced_sources(spark, sf_dir)],
        on="objectId",
        into=["forced"],
        sort_by="midpointMjdTai",
        tie_break=data.FORCED_TIES,
        max_rows=max_rows,
    )
    fields = ["sourceId", "visit", "detector", "band", "midpointMjdTai", "psfFlux", "psfFluxErr"]
    return flatten(nested, "forced", ["objectId"], position="pos").select("objectId", "pos", *fields)


@query(_NESTED)
def nest_forced_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested column, opened again with the position of each source in its light curve."""
    return _opened(spark, sf_dir, MAX_ROWS_PER_PART)


@query(_NESTED)
def nest_in_small_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with light curves that go on over rows of three sources each."""
    return _opened(spark, sf_dir, 3)


_SUMMARY = f"""
WITH f AS (SELECT objectId, count(*) AS n_forced, min(midpointMjdTai) AS first_time,
                  max(midpointMjdTai) AS last_time, avg(psfFlux) AS mean_flux FROM ({sql.FORCED}) GROUP BY objectId),
     d AS (SELECT objectId, count(*) AS n_detected, min(midpointMjdTai) AS first_detected
           FROM ({sql.DETECTIONS}) GROUP BY objectId)
SELECT o.objectId, coalesce(n_forced, 0) AS n_forced, first_time, last_time, mean_flux::FLOAT AS mean_flux,
       coalesce(n_detected, 0) AS n_detected, first_detected
FROM ({sql.OBJECTS}) o LEFT JOIN f USING (objectId) LEFT JOIN d USING (objectId)"""


def _summary(nested: DataFrame) -> DataFrame:
    """What can be read off the sorted arrays of each row, put together over the rows of an object."""
    times, seen = F.col("forced.midpointMjdTai"), F.col("detected.midpointMjdTai")
    rows = nested.select(
        "objectId",
        F.coalesce(F.size("forced"), F.lit(0)).alias("n_forced"),
        F.get(times, 0).alias("first_time"),
        F.get(times, F.size(times) - 1).alias("last_time"),
        F.aggregate("forced.psfFlux", F.lit(0.0), lambda a, b: a + b).alias("total"),
        F.coalesce(F.size("detected"), F.lit(0)).alias("n_detected"),
        F.get(seen, 0).alias("first_detected"),
    )
    return rows.groupBy("objectId").agg(
        F.sum("n_forced").alias("n_forced"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.try_divide(F.sum("total"), F.sum("n_forced")).cast("float").alias("mean_flux"),
        F.sum("n_detected").alias("n_detected"),
        F.min("first_detected").alias("first_detected"),
    )


@query(_SUMMARY)
def light_curve_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both source tables nested under their objects, and what can be read off the sorted arrays."""
    return _summary(light_curves(spark, sf_dir))


@query(_SUMMARY)
def summary_of_small_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with rows of two sources each."""
    return _summary(light_curves(spark, sf_dir, max_rows=2))


@query(f"""
SELECT objectId, count(*) AS n_forced FROM ({sql.FORCED})
WHERE objectId IN (SELECT user_id FROM events) GROUP BY objectId""")
def nest_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only objects that have sources in both tables."""
    nested = light_curves(spark, sf_dir, how="inner", max_rows=4)
    sizes = F.coalesce(F.size("forced"), F.lit(0))
    return nested.groupBy("objectId").agg(F.sum(sizes).alias("n_forced"))


@query(f"""
SELECT band, count(*) AS len, avg(psfFlux)::FLOAT AS mean_psfFlux, min(psfFlux) AS min_psfFlux,
       max(psfFlux) AS max_psfFlux, avg(psfFluxErr)::FLOAT AS mean_psfFluxErr,
       min(psfFluxErr) AS min_psfFluxErr, max(psfFluxErr) AS max_psfFluxErr
FROM ({sql.FORCED}) GROUP BY band""")
def nested_band_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band statistics of nested sources."""
    nested = nest_sources(
        data.objects(spark, sf_dir), [data.forced_sources(spark, sf_dir)], on="objectId", into=["forced"],
        sort_by="midpointMjdTai", tie_break=data.FORCED_TIES,
    )
    flat = flatten(nested, "forced", ["objectId"])
    rows = band_statistics(flat, ["psfFlux", "psfFluxErr"])
    return rows.select(
        "band", "len", "min_psfFlux", "max_psfFlux", "min_psfFluxErr", "max_psfFluxErr",
        *_floats("mean_psfFlux", "mean_psfFluxErr"),
    )


@query(f"""
SELECT objectId, count(*) AS n, sum(psfFlux + psfFluxErr)::FLOAT AS upper_sum,
       count(*) FILTER (WHERE band = 'g') AS n_g
FROM ({sql.FORCED}) GROUP BY objectId""")
def nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-columns selected, assigned from others, and dropped."""
    nested = light_curves(spark, sf_dir)
    cut = select_columns(nested, ["objectId", "forced.band", "forced.psfFlux", "forced.psfFluxErr"])
    upper = assign_fields(F.col("forced"), {"upper": lambda e: e["psfFlux"] + e["psfFluxErr"]})
    wider = cut.withColumn("forced", upper)
    slim = wider.withColumn("forced", drop_fields(wider, "forced", ["psfFlux", "psfFluxErr"]))
    rows = slim.where(F.col("forced").isNotNull()).select(
        "objectId",
        F.size("forced").alias("n"),
        F.aggregate("forced.upper", F.lit(0.0), lambda a, b: a + b).alias("upper"),
        F.size(F.filter("forced.band", lambda b: b == "g")).alias("g"),
    )
    return rows.groupBy("objectId").agg(
        F.sum("n").alias("n"), F.sum("upper").cast("float").alias("upper_sum"), F.sum("g").alias("n_g")
    )


@query(f"""
SELECT objectId, row_number() OVER (PARTITION BY objectId ORDER BY visit NULLS LAST, pos) - 1 AS pos,
       visit, sourceId
FROM (SELECT *, row_number() OVER (PARTITION BY objectId ORDER BY midpointMjdTai NULLS LAST,
             {sql.FORCED_TIES}) AS pos FROM ({sql.FORCED}))""")
def sort_nested_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested column flattened, nested back, and sorted by another of its fields, over all its rows."""
    nested = light_curves(spark, sf_dir, max_rows=5)
    flat = flatten(nested, "forced", ["objectId"]).select("objectId", "_pos", "visit", "sourceId")
    again = nest(flat, ["objectId"], "forced", max_rows=3)
    resorted = resort_nested(again, "objectId", "forced", ["visit", "sourceId"], "visit", max_rows=4)
    rows = flatten(resorted, "forced", ["objectId"], position="pos")
    return rows.select("objectId", "pos", "visit", "sourceId")


@query(f"""
SELECT objectId, round(sum(psfFlux), 2) > 200000 AS bright
FROM ({sql.FORCED}) GROUP BY objectId""")
def default_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested columns that exist, nested ones included; unknown names are left out."""
    nested = light_curves(spark, sf_dir)
    chosen, missing = available_columns(nested, ["objectId", "forced.psfFlux", "forced.unknown", "nowhere"])
    assert missing == ["forced.unknown", "nowhere"] and PART in full_column_names(nested)
    rows = select_columns(nested, chosen).where(F.col("forced").isNotNull())
    total = F.aggregate("forced.psfFlux", F.lit(0.0), lambda a, b: a + b)
    return rows.groupBy("objectId").agg((F.round(F.sum(total), 2) > 200_000).alias("bright"))


@query(f"""
SELECT band, count(*) AS len, min(psfFlux) AS min_psfFlux, max(psfFlux) AS max_psfFlux
FROM ({sql.FORCED}) WHERE visit % 5 <> 0 AND visit % 7 <> 0 GROUP BY band""")
def statistics_without_sky_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band statistics leave out sky sources, and rows for which that is unknown."""
    visit = F.col("visit")
    rows = data.forced_sources(spark, sf_dir).withColumn("sky_source", F.when(visit % 7 != 0, visit % 5 == 0))
    return band_statistics(rows, ["psfFlux"]).select("band", "len", "min_psfFlux", "max_psfFlux")
