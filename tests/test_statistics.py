import pytest
from pyspark.sql import functions as F

from skyweave.operators import statistics as st
from skyweave.operators.keys import duplicate_keys, join_features, missing_keys

NAN = float("nan")


def test_column_statistics(spark):
    schema = "a double, b int, c string, d boolean, e array<struct<x:int>>, aMag float"
    df = spark.createDataFrame(
        [(NAN, 1, "p", True, [(1,)], 1.0), (2.0, None, None, None, None, None), (None, -5, "q", False, [], 2.0)], schema
    )
    rows = {r["column"]: r for r in st.column_statistics(df).collect()}
    assert (rows["a"]["min_value"], rows["a"]["max_value"], rows["a"]["null_count"]) == ("2.0", "2.0", 1)
    assert (rows["b"]["min_value"], rows["b"]["max_value"], rows["b"]["null_count"]) == ("-5", "1", 1)
    assert (rows["c"]["min_value"], rows["d"]["max_value"]) == ("p", "true")
    assert (rows["e"]["min_value"], rows["e"]["null_count"], rows["e"]["n_rows"]) == (None, 1, 3)
    kept = st.without_magnitudes(st.column_statistics(df))
    assert "aMag" not in {r["column"] for r in kept.collect()}


def test_statistics_of_a_wide_table(spark):
    df = spark.range(5).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(150)])
    rows = {r["column"]: (r["min_value"], r["max_value"]) for r in st.column_statistics(df).collect()}
    assert rows == {f"c{i}": (str(i), str(i + 4)) for i in range(150)}


def test_range_checks(spark):
    df = spark.createDataFrame([(0.0, -90.5, None), (360.0, 10.0, None)], "ra double, dec double, t double")
    rules = {"RIGHT ASCENSION": ["ra"], "DECLINATION": ["dec"], "MJD": ["t"], "FLUX": []}
    rows = {r["column"]: (r["kind"], r["in_range"]) for r in st.range_checks(st.column_statistics(df), rules).collect()}
    assert rows == {"ra": ("RIGHT ASCENSION", True), "dec": ("DECLINATION", False), "t": ("MJD", True)}


def test_null_report_is_sorted(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, 2), (1, 3, 2), (1, 4, 2)], "a int, b int, c int")
    report = st.null_report(st.column_statistics(df)).collect()
    assert [(r["column"], r["null_count"], r["percent"]) for r in report] == [("b", 2, 50.0), ("c", 1, 25.0)]
    assert st.null_report(st.column_statistics(df.select("a"))).count() == 0


def test_band_statistics(spark):
    schema = "band string, f double, x double, sky_source boolean"
    rows = [
        ("g", 1.0, 1.0, False), ("g", NAN, NAN, False), ("g", 3.0, None, False), ("g", 100.0, 1.0, True),
        ("g", 100.0, 1.0, None), ("r", NAN, 1.0, False), ("?", 5.0, 1.0, False),
    ]
    df = spark.createDataFrame(rows, schema)
    found = {r["band"]: r for r in st.band_statistics(df, ["f"]).collect()}
    assert set(found) == {"g", "r"}
    assert (found["g"]["mean_f"], found["g"]["min_f"], found["g"]["max_f"], found["g"]["len"]) == (2.0, 1.0, 3.0, 1)
    assert (found["r"]["mean_f"], found["r"]["len"]) == (None, 1)
    whole = {r["band"]: r["len"] for r in st.band_statistics(df.drop("x", "sky_source"), ["f"]).collect()}
    assert whole == {"g": 5, "r": 1}


def test_weighted_combination_uses_row_counts(spark):
    parts = spark.createDataFrame(
        [("A", "g", 10, 2.0, 1.0, 3.0), ("A", "g", 30, 4.0, 0.5, 9.0), ("A", "r", 0, 4.0, 0.5, 9.0), ("A", "g", 5, None, None, None)],
        "field string, band string, len long, mean_f double, min_f double, max_f double",
    )
    rows = st.combine_band_statistics(parts, ["f"], by=["field"]).collect()
    assert [(r["band"], r["len"], r["min_f"], r["max_f"]) for r in rows] == [("g", 45, 0.5, 9.0)]
    assert rows[0]["mean_f"] == pytest.approx(140 / 45)


def test_field_report(spark):
    stats = spark.createDataFrame(
        [("A", "g", 1.0, 0.0, 2.0), ("B", "g", 5.0, 4.0, 6.0)], "field string, band string, mean_f double, min_f double, max_f double"
    )
    rows = {r["statistic"]: (r["A"], r["B"], r["C"]) for r in st.field_report(stats, ["f"], ["A", "B", "C"]).collect()}
    assert rows == {"mean_f_g": (1.0, 5.0, None), "min_f_g": (0.0, 4.0, None), "max_f_g": (2.0, 6.0, None)}


def test_numeric_columns(spark):
    df = spark.createDataFrame(
        [(1, 1, 1.0, 1.0, True, "a", 1)],
        "objectId long, n int, flux float, psfMag float, flag boolean, band string, _healpix_29 long",
    )
    assert st.numeric_columns(df) == ["n", "flux"]


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (9.99,), (10.0,)], "v double")
    rows = st.size_histogram(df, "v").orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 0, 0, 0, 0, 0, 0, 0, 0, 2]
    assert (rows[0]["low"], rows[9]["high"]) == (0.0, 10.0)
    equal = st.size_histogram(df.where("v = 0.5"), "v").collect()
    assert sum(r["n"] for r in equal) == 1 and len(equal) == 10
    assert st.size_histogram(df.limit(0), "v").count() == 0


def test_key_checks(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 2)], "visit long, detector long")
    features = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.6), (2, 2, 0.7)], "visit long, detector long, f double")
    keys = ["visit", "detector"]
    assert sorted(r["f"] for r in join_features(rows, features, keys).collect()) == [0.5, 0.6, 0.7, 0.7]
    missing = missing_keys(rows, features.where("f < 0.7"), keys).collect()
    assert [tuple(r) for r in missing] == [(2, 2, 2)]
    assert [tuple(r) for r in duplicate_keys(rows, keys).collect()] == [(2, 2, 2)]
    with pytest.raises(Exception, match="no feature row for 2 2"):
        join_features(rows, features.where("f < 0.7"), keys).collect()
    # One missing and one repeated key do not cancel.
    both = features.where("f < 0.7").unionByName(features.where("f = 0.6"))
    with pytest.raises(ValueError, match="repeated"):
        join_features(rows, both, keys)
