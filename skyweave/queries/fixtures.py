"""Sky tables derived from the given tables by arithmetic that any SQL engine repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions.photometry import BANDS, modified_julian_date


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def position(key: Column) -> tuple[Column, Column]:
    """Scatter integer keys over the whole sky, poles included."""
    key = key.cast("double")
    return (key * 137.50776405) % 360.0, (key * 73.13) % 180.0 - 90.0


def crowded_position(key: Column) -> tuple[Column, Column]:
    """As ``position``, but every third key lies in one small patch."""
    ra, dec = position(key)
    crowded = key % 3 == 0
    return (
        F.when(crowded, 40.0 + (key % 97) * 0.01).otherwise(ra),
        F.when(crowded, 10.0 + (key % 89) * 0.01).otherwise(dec),
    )


def band_of(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(b) for b in BANDS]), (number % 6).cast("int") + 1)


def objects(spark: SparkSession, sf_dir: str, crowded: bool = False) -> DataFrame:
    """``objectId, ra, dec`` and fluxes, from orders."""
    place = crowded_position if crowded else position
    ra, dec = place(F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("objectId"), ra.alias("ra"), dec.alias("dec")
    )


def forced_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of objects, from lineitem; ``sourceId`` is the part key."""
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("objectId"),
        F.col("l_partkey").alias("sourceId"),
        F.col("l_suppkey").alias("visit"),
        F.col("l_linenumber").cast("long").alias("detector"),
        band_of(F.col("l_linenumber")).alias("band"),
        modified_julian_date(F.col("l_shipdate")).alias("midpointMjdTai"),
        price.alias("psfFlux"),
        (price * F.col("l_tax")).alias("psfFluxErr"),
        (price - 50000.0).alias("psfDiffFlux"),
        (price * F.col("l_discount")).alias("psfDiffFluxErr"),
        F.col("l_quantity").alias("quantity"),
    )


FORCED_TIES = ("sourceId", "visit", "detector", "quantity", "psfFlux", "psfFluxErr", "psfDiffFluxErr")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second source table, from events."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("objectId"),
        F.col("event_id").alias("detectionId"),
        F.col("event_type").alias("band"),
        modified_julian_date(F.col("ts")).alias("midpointMjdTai"),
        F.col("value").alias("psfFlux"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("visitId"),
        (60600.0 + F.col("s_suppkey") % 100 + 0.5).alias("expMidptMJD"),
    )


def visit_detectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions of every detector of every visit, with gaps in the seeing."""
    numbers = F.sequence(F.lit(1).cast("long"), F.lit(7).cast("long"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", F.explode(numbers).alias("detector"))
    total = F.col("s_suppkey") + F.col("detector")
    return rows.select(
        F.col("s_suppkey").alias("visitId"),
        "detector",
        (F.col("s_acctbal") / 10.0).alias("skyBg"),
        F.when(total % 5 != 0, 0.6 + (total % 7) * 0.125).alias("seeing"),
        (15.0 + F.col("s_suppkey") % 2 * 15.0).alias("expTime"),
        band_of(F.col("s_suppkey")).alias("band"),
    )


def detectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Focal-plane positions of the detectors in use."""
    number = F.col("l_linenumber").cast("long")
    rows = table(spark, sf_dir, "lineitem").select(number.alias("detector")).distinct()
    return rows.select(
        "detector",
        (F.col("detector") - 4).cast("double").alias("x"),
        (F.col("detector") % 3 - 1).cast("double").alias("y"),
    )


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outside survey from customer: 0.05″ from an object for even keys, 0.5″ for odd ones."""
    ra, dec = position(F.col("c_custkey"))
    shift = F.when(F.col("c_custkey") % 2 == 0, 0.05 / 3600.0).otherwise(0.5 / 3600.0)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("objectid"), ra.alias("ra"), (dec + shift).alias("dec")
    )


def signed_fluxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fluxes of both signs, zero and missing, from customer."""
    key, flux = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        key.alias("objectId"),
        F.when(key % 11 == 0, F.lit(0.0)).when(key % 13 != 0, flux).alias("psfFlux"),
        F.when(key % 7 == 0, F.abs(flux)).otherwise((key % 50) * 10.0).alias("psfFluxErr"),
        (flux * 2.0).alias("kronFlux"),
    )
