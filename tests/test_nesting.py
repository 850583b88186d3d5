import pytest
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
from skyweave.operators import nesting
from skyweave.operators.nesting import nest_sources, resort_nested, sort_nested
from skyweave.operators.numbering import number_groups, number_rows, zip_by_position


@pytest.fixture(scope="module")
def objects(spark):
    return spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id long, ra double")


@pytest.fixture(scope="module")
def sources(spark):
    rows = [
        (1, None, 7, "a"), (1, 5.0, 2, "b"), (1, 3.0, 9, "c"), (1, 5.0, 1, "d"),
        (2, 1.0, 4, "e"), (8, 1.0, 5, "f"), (None, 1.0, 6, "g"),
    ]
    return spark.createDataFrame(rows, "id long, t double, tie int, name string")


def test_left_nesting_sorts_nulls_last_and_keeps_lonely_objects(objects, sources):
    nested = nest_sources(objects, [sources], on="id", into=["s"], sort_by="t", tie_break=["tie"])
    assert full_column_names(nested) == ["id", "ra", "_part", "_start", "s.t", "s.tie", "s.name"]
    found = {r["id"]: r["s"] and [e["name"] for e in r["s"]] for r in nested.collect()}
    assert found == {1: ["c", "d", "b", "a"], 2: ["e"], 3: None}


def test_inner_nesting_needs_sources_in_every_table(objects, sources):
    second = sources.where("id = 2").select("id", "t")
    nested = nest_sources(objects, [sources, second], on="id", into=["a", "b"], sort_by="t", how="inner")
    assert [r["id"] for r in nested.collect()] == [2]


def test_bad_arguments(objects, sources):
    with pytest.raises(ValueError, match="1 source tables for 2"):
        nest_sources(objects, [sources], on="id", into=["a", "b"], sort_by="t")
    with pytest.raises(ValueError, match="neither"):
        nest_sources(objects, [sources], on="id", into=["a"], sort_by="t", how="outer")


def test_crowded_object_goes_on_in_parts(spark, objects):
    """One id holds most rows, with equal and missing times; nothing is lost and order holds."""
    n = 2_000
    crowd = spark.range(n).select(
        F.lit(1).cast("long").alias("id"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 31 % 50).cast("double")).alias("t"),
        F.col("id").alias("k"),
    )
    rest = spark.createDataFrame([(2, 4.0, -1), (2, 3.0, -2)], "id long, t double, k long")
    sources = crowd.unionByName(rest)
    few = sources.where("k % 1000 = 0").select("id", "t", F.col("k").alias("other"))
    nested = nest_sources(
        objects, [sources, few], on="id", into=["s", "few"], sort_by="t", tie_break=["k"], max_rows=300
    )
    rows = sorted(nested.collect(), key=lambda r: (r["id"], r["_part"]))
    assert [(r["id"], r["_part"], len(r["s"] or [])) for r in rows] == [
        *[(1, p, 300) for p in range(6)], (1, 6, 200), (2, 0, 2), (3, 0, 0),
    ]
    flat = flatten(nested, "s", ["id"]).where("id = 1").orderBy("_pos").collect()
    whole = [(e["t"], e["k"]) for r in rows if r["id"] == 1 for e in r["s"]]
    assert [(r["_pos"], r["t"], r["k"]) for r in flat] == [(i, *e) for i, e in enumerate(whole)]
    again = nest(flatten(nested, "s", ["id"]), ["id"], "s", max_rows=450)
    by_k = resort_nested(again, "id", "s", ["t", "k"], "k", max_rows=70)
    found = flatten(by_k, "s", ["id"]).where("id = 1").orderBy("_pos").collect()
    assert [(r["_pos"], r["k"]) for r in found] == [(i, i) for i in range(n)]
    assert max(len(r["s"]) for r in by_k.collect()) == 70
    keyed = [(t is None, t or 0.0, k) for t, k in whole]
    assert keyed == sorted(keyed) and len({k for _, k in whole}) == n
    assert [len(r["few"] or []) for r in rows] == [2, 0, 0, 0, 0, 0, 0, 0, 0]
    assert all(r["ra"] == 10.0 for r in rows if r["id"] == 1)


def test_nested_fields(objects, sources):
    nested = nest_sources(objects, [sources], on="id", into=["s"], sort_by="t", tie_break=["tie"])
    assert available_columns(nested, ["s.t", "id", "s.none", "x"]) == (["s.t", "id"], ["s.none", "x"])
    cut = select_columns(nested, ["id", "s.tie", "s.t"])
    assert cut.dtypes == [("id", "bigint"), ("s", "array<struct<tie:int,t:double>>")]
    wider = cut.withColumn("s", assign_fields(F.col("s"), {"twice": lambda e: e["tie"] * 2}))
    slim = wider.withColumn("s", drop_fields(wider, "s", ["t", "tie"]))
    found = {r["id"]: r["s"] and [e["twice"] for e in r["s"]] for r in slim.collect()}
    assert found == {1: [18, 2, 4, 14], 2: [8], 3: None}


def test_flatten_and_nest_are_inverse(spark):
    df = spark.createDataFrame(
        [(1, [(3, "a"), (1, "b")]), (2, []), (3, None)], "id long, s array<struct<v:int,w:string>>"
    )
    assert [tuple(r) for r in flatten(df, "s", ["id"]).collect()] == [(1, 0, 3, "a"), (1, 1, 1, "b")]
    outer = sorted((r["id"], r["v"]) for r in flatten(df, "s", ["id"], outer=True).where("id > 1").collect())
    assert outer == [(2, None), (3, None)]
    again = nest(flatten(df, "s", ["id"]), ["id"], "s").collect()
    assert [(r["id"], [tuple(e) for e in r["s"]]) for r in again] == [(1, [(3, "a"), (1, "b")])]


def test_sort_nested_is_stable_with_nulls_last(spark):
    df = spark.createDataFrame(
        [([(None, 1), (2, 2), (1, 3), (2, 4)],), ([],), (None,)], "s array<struct<k:int,n:int>>"
    )
    rows = [r["s"] for r in df.select(sort_nested(F.col("s"), "k").alias("s")).collect()]
    assert [e["n"] for e in rows[0]] == [3, 2, 4, 1] and rows[1:] == [[], None]


def test_number_rows_over_many_partitions(spark):
    df = spark.range(5_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 5_003).alias("v"))
    crowded = df.withColumn("g", F.when(F.col("v") % 2 == 0, 0).otherwise(F.col("g")))
    rows = number_rows(crowded, ["v"], within=["g"]).collect()
    by_group = {}
    for r in rows:
        by_group.setdefault(r["g"], []).append((r["v"], r["_row"]))
    for pairs in by_group.values():
        assert [n for _, n in sorted(pairs)] == list(range(len(pairs)))


def test_number_rows_spreads_equal_rows(spark):
    numbers = number_rows(spark.range(1_000).select(F.lit(1).alias("v")), ["v"]).collect()
    assert sorted(r["_row"] for r in numbers) == list(range(1_000))


def test_number_groups_drops_null_keys(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 1), ("a", 1), ("a", 2)], "x string, y int")
    found = {(r["x"], r["y"]): r["group_no"] for r in number_groups(df, ["x", "y"]).collect()}
    assert found == {("a", 1): 0, ("a", 2): 1, ("b", 1): 2}


def test_zip_refuses_unequal_lengths(spark):
    a = spark.createDataFrame([("x", 0), ("y", 1)], "a string, _row long")
    b = spark.createDataFrame([("p", 0), ("q", 1)], "b string, _row long")
    assert sorted((r["a"], r["b"]) for r in zip_by_position(a, b).collect()) == [("x", "p"), ("y", "q")]
    with pytest.raises(Exception, match="unequal lengths"):
        zip_by_position(a, b.limit(1)).collect()


def opened(nested, columns):
    rows = nested.select("id", "_part", "_start", *columns).collect()
    return sorted(([tuple(map(tuple, x)) if isinstance(x, list) else x for x in r] for r in rows), key=repr)


def test_short_light_curves_are_cut_without_numbering(spark, monkeypatch):
    objects = spark.createDataFrame([(i,) for i in (1, 1, 2, 3, 4, None)], "id long")
    a = spark.createDataFrame([(i, float(k % 4) if k % 5 else None, k) for i, n in ((1, 7), (2, 4), (9, 3)) for k in range(n)], "id long, t double, k long")
    b = spark.createDataFrame([(i, float(-k), k) for i, n in ((1, 2), (2, 9), (3, 5), (None, 2)) for k in range(n)], "id long, t double, k long")

    def nested(held, how):
        monkeypatch.setattr(nesting, "MAX_ROWS_HELD", held)
        return opened(nest_sources(objects, [a, b], on="id", into=["a", "b"], sort_by="t", tie_break=["k"], how=how, max_rows=3), ["a", "b"])

    for how in ("left", "inner"):
        numbered = nested(3, how)
        assert numbered == nested(5, how)
        with monkeypatch.context() as patched:
            patched.setattr(nesting, "number_rows", None)
            assert nested(10, how) == numbered
    assert [(r[0], r[1], r[2], r[3] and len(r[3]), len(r[4])) for r in nested(10, "inner") if r[0] == 2] == [(2, 0, 0, 3, 3), (2, 1, 3, 1, 3), (2, 2, 6, None, 3)]


def test_resorting_runs_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(i % 3, i, float(-i)) for i in range(30)], "id long, k long, t double").mapInPandas(counted, "id long, k long, t double")
    again = nest(rows.withColumn("_pos", F.col("k")), ["id"], "s", max_rows=10_000)
    by_t = resort_nested(again, "id", "s", ["t"], "t", max_rows=4)
    assert [r["t"] for r in flatten(by_t, "s", ["id"]).where("id = 1").orderBy("_pos").collect()] == [float(-i) for i in range(28, 0, -3)]
    assert seen.value == 30
