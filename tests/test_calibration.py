import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyweave.functions.labels import joined_label, readable_size
from skyweave.functions.photometry import (
    ab_magnitude,
    ab_magnitude_error,
    band_flags,
    band_selected,
    clip,
    modified_julian_date,
    out_of_range,
    polar_features,
)
from skyweave.operators.calibration import (
    add_magnitudes,
    add_visit_time,
    calibrate,
    is_processed,
    narrow_floats,
)

INF = float("inf")


def test_magnitude_of_special_fluxes(spark):
    rows = [(1.0,), (0.0,), (-3.0,), (None,), (float("nan"),), (-0.0,)]
    df = spark.createDataFrame(rows, "f double").select(ab_magnitude(F.col("f")).alias("m"))
    found = [r["m"] for r in df.collect()]
    assert found[0] == pytest.approx(31.4, abs=1e-6)
    assert found[1:] == [INF, None, None, None, INF]
    assert df.schema["m"].dataType.simpleString() == "float"


def test_magnitude_error(spark):
    rows = [(10.0, 1.0), (1.0, 1.0), (1.0, 2.0), (0.0, 0.0), (0.0, 1.0), (5.0, None)]
    df = spark.createDataFrame(rows, "f double, e double")
    found = [r["m"] for r in df.select(ab_magnitude_error(F.col("f"), F.col("e")).alias("m")).collect()]
    assert found[0] == pytest.approx(2.5 * (math.log10(11) - math.log10(9)) / 2, rel=1e-6)
    assert found[1:] == [INF, None, None, None, None]


def test_error_column_only_where_it_exists(spark):
    df = spark.createDataFrame([(1.0, 0.1, 2.0)], "psfFlux double, psfFluxErr double, kronFlux double")
    assert add_magnitudes(df, ["psf", "kron"]).columns[3:] == ["psfMag", "psfMagErr", "kronMag"]


def test_visit_time(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (None,)], "visit long")
    visits = spark.createDataFrame(
        [(1, 5.0, 0), (2, 8.0, 1), (2, 6.0, 2), (None, 1.0, 3)], "visitId long, expMidptMJD double, n int"
    )
    times = {r["visit"]: r["midpointMjdTai"] for r in add_visit_time(df, visits, ordinal="n").collect()}
    assert times == {1: 5.0, 2: 6.0, 9: None, None: None}
    with pytest.raises(ValueError, match="missing"):
        add_visit_time(df.withColumnRenamed("visit", "v"), visits)
    with pytest.raises(ValueError, match="exists"):
        add_visit_time(df.withColumn("midpointMjdTai", F.lit(0.0)), visits)


def test_narrow_floats_keeps_positions(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], "ra double, flux double, n int")
    assert narrow_floats(df).dtypes == [("ra", "double"), ("flux", "float"), ("n", "int")]


def test_processed_predicate():
    assert not is_processed(["a"], [], False)
    assert is_processed(["psfMag"], ["psf"], False)
    assert not is_processed(["psfMag"], ["psf"], True)
    assert not is_processed(["midpointMjdTai"], ["psf"], True)


def test_calibrate_computes_only_what_is_missing(spark):
    df = spark.createDataFrame([(7, 1.0, 5.5)], "visit long, psfFlux double, midpointMjdTai double")
    visits = spark.createDataFrame([(7, 9.0)], "visitId long, expMidptMJD double")
    row = calibrate(df, ["psf"], visits).first()
    assert row["midpointMjdTai"] == 5.5 and row["psfMag"] == pytest.approx(31.4, abs=1e-5)


def test_clip_and_flag(spark):
    df = spark.createDataFrame([(0.05,), (100.0,), (1.0,), (float("nan"),), (None,)], "u double")
    rows = df.select(clip(F.col("u"), 0.1, 50.0).alias("c"), out_of_range(F.col("u"), 0.1, 50.0).alias("f")).collect()
    assert [(r["c"], r["f"]) for r in rows[:3]] == [(0.1, True), (50.0, True), (1.0, False)]
    assert math.isnan(rows[3]["c"]) and not rows[3]["f"]
    assert rows[4]["c"] is None and not rows[4]["f"]


def test_band_features(spark):
    df = spark.createDataFrame([("g", 0.5, None), (None, 0.5, 1.0)], "band string, g double, r double")
    flags = df.withColumns(band_flags(F.col("band")))
    flag_of = {b: F.col(f"is_{b}_band") for b in "gr"}
    rows = flags.withColumn("v", band_selected({"g": F.col("g"), "r": F.col("r")}, flag_of)).collect()
    assert rows[0]["is_g_band"] == 1.0 and rows[0]["v"] == 0.5
    assert all(rows[1][f"is_{b}_band"] == 0.0 for b in "ugrizy") and rows[1]["v"] == 0.0


def test_polar_features(spark):
    df = spark.createDataFrame([(3.0, 4.0), (0.0, 0.0)], "x double, y double")
    rows = df.select([c.alias(n) for n, c in polar_features(F.col("x"), F.col("y")).items()]).collect()
    assert tuple(rows[0]) == pytest.approx((5.0, 0.6, 0.8), abs=1e-6)
    assert tuple(rows[1]) == pytest.approx((0.0, 1.0, 0.0))


def test_modified_julian_date(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12, 0, 0, 500000),)], "t timestamp_ntz")
    assert df.select(modified_julian_date(F.col("t"))).first()[0] == pytest.approx(60310.5 + 0.5 / 86400, abs=1e-9)


def test_labels(spark):
    sizes = spark.createDataFrame([(1,), (512,), (1536,), (5 * 1024**2,), (3 * 1024**4,)], "n long")
    assert [r[0] for r in sizes.select(readable_size(F.col("n"))).collect()] == [
        "1 Byte", "512 Bytes", "1.5 KiB", "5.0 MiB", "3.0 TiB",
    ]
    label = joined_label("/", F.lit("DRP"), F.lit(None).cast("string"), F.lit(""), F.lit("w"))
    assert sizes.select(label).first()[0] == "DRP/w"
