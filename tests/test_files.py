import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.runtime import broadcast_checked, fits_broadcast, scratch_path, shared_folder
from skyweave.sources.exports import export_tables, write_statistics
from skyweave.sources.files import (
    file_inventory,
    first_file_schema,
    indexed_scan,
    join_keys_to_paths,
    listed_files,
    partition_size_estimate,
    read_index_files,
    read_key_table,
    read_path_list,
    seeded_schema,
    write_index_files,
)
from skyweave.streaming.ingest import ingest_available, stream_files


def one_file(df, folder):
    df.coalesce(1).write.parquet(str(folder))
    return str(next(p for p in folder.iterdir() if p.suffix == ".parquet"))


@pytest.fixture()
def raw(spark, tmp_path):
    """Three files: one plain, one without rows, one that holds the key itself."""
    a = spark.createDataFrame([(1, 0.5), (2, 1.5)], "id long, flux double")
    b = a.limit(0)
    c = spark.createDataFrame([(3, 2.5, 70), (4, 3.5, None)], "id long, flux double, tract long")
    return [one_file(df, tmp_path / name) for df, name in ((a, "a"), (b, "b"), (c, "c"))]


def test_scan_attaches_keys_only_where_a_file_lacks_them(spark, raw):
    index = spark.createDataFrame([(p, 10 + i, "g") for i, p in enumerate(raw)], "path string, tract long, band string")
    rows = indexed_scan(spark, index).select("id", "tract", "band").collect()
    assert {r["band"] for r in rows} == {"g"}
    assert {(r["id"], r["tract"]) for r in rows} == {(1, 10), (2, 10), (3, 70), (4, None)}


def test_projected_scan_has_no_keys(spark, raw):
    index = spark.createDataFrame([(p, 1) for p in raw[:2]], "path string, tract long")
    assert indexed_scan(spark, index, columns=["flux"]).columns == ["flux"]


def test_scan_of_a_folder_keeps_listed_files(spark, raw, tmp_path):
    index = spark.createDataFrame([(raw[0], 5)], "path string, tract long")
    schema = spark.read.parquet(raw[0]).schema
    rows = indexed_scan(spark, index, schema=schema).collect()
    assert sorted((r["id"], r["tract"]) for r in rows) == [(1, 5), (2, 5)]


def test_scan_keeps_columns_that_only_some_files_have(spark, tmp_path):
    first = one_file(spark.createDataFrame([(1, 0.5)], "id long, f double"), tmp_path / "p")
    more = one_file(spark.createDataFrame([(2, 1.5, 99, "x")], "id long, f double, tract long, g string"), tmp_path / "q")
    index = spark.createDataFrame([(first, 10), (more, 20)], "path string, tract long")
    rows = {r["id"]: (r["f"], r["tract"], r["g"]) for r in indexed_scan(spark, index).collect()}
    assert rows == {1: (0.5, 10, None), 2: (1.5, 99, "x")}
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("tract", T.LongType())])
    fixed = indexed_scan(spark, index, schema=schema)
    assert fixed.columns == ["id", "tract"]
    assert sorted(map(tuple, fixed.collect())) == [(1, 10), (2, 99)]


def test_only_listed_files_are_opened(spark, tmp_path):
    """One listed file among many, one of them broken, and others of another schema."""
    listed = one_file(spark.createDataFrame([(1, 0.5)], "id long, f double"), tmp_path / "many" / "a")
    for i in range(5):
        one_file(spark.createDataFrame([(i, "x")], "id long, other string"), tmp_path / "many" / f"o{i}")
    (tmp_path / "many" / "a" / "broken.parquet").write_bytes(b"no parquet")
    index = spark.createDataFrame([(listed, 3), (listed, 3)], "path string, tract long")
    assert listed_files(index) == [listed]
    rows = indexed_scan(spark, index)
    assert rows.columns == ["id", "f", "tract"]
    assert [tuple(r) for r in rows.collect()] == [(1, 0.5, 3)]
    assert len(rows.inputFiles()) == 1
    assert partition_size_estimate(spark, index).first()["n_files"] == 1


def test_empty_index(spark):
    index = spark.createDataFrame([], "path string, tract long")
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert indexed_scan(spark, index, schema=schema).columns == ["id", "tract"]
    with pytest.raises(ValueError, match="empty index"):
        indexed_scan(spark, index)


def test_path_list_and_keys_by_position(spark, tmp_path):
    (tmp_path / "paths.txt").write_text("  /x/1 \n\n/x/2\n   \n/x/3")
    (tmp_path / "refs.csv").write_text("band,tract\ng,3\nr,2\ni,1\n")
    paths = read_path_list(spark, str(tmp_path / "paths.txt"))
    keys = read_key_table(spark, str(tmp_path / "refs.csv"))
    both = join_keys_to_paths(keys, paths).collect()
    assert sorted((r["band"], r["tract"], r["path"]) for r in both) == [("g", 3, "/x/1"), ("i", 1, "/x/3"), ("r", 2, "/x/2")]


def test_index_files(spark, tmp_path):
    table = spark.createDataFrame(
        [("g", 20, "/1"), ("g", 10, "/2"), ("r", 10, "/3"), (None, 10, "/4"), ("g", 20, "/5")],
        "band string, day_obs long, path string",
    )
    write_index_files(table, ["band", "day_obs"], ["band", "day_obs"], str(tmp_path / "index"))
    index = read_index_files(spark, str(tmp_path / "index"), "band string, day_obs long, path string, group_no int")
    assert sorted((r["group_no"], r["path"]) for r in index.collect()) == [(0, "/2"), (1, "/1"), (1, "/5"), (2, "/3")]


def test_seeded_schema(spark, raw, tmp_path):
    (tmp_path / "paths.txt").write_text("\n".join(raw))
    first = first_file_schema(spark, read_path_list(spark, str(tmp_path / "paths.txt")))
    index = T.StructType([T.StructField("tract", T.LongType()), T.StructField("band", T.StringType())])
    assert seeded_schema(first, index, ["tract", "band"]).simpleString() == (
        "struct<id:bigint,flux:double,tract:bigint,band:string>"
    )


def test_size_estimate(spark, raw, tmp_path):
    (tmp_path / "paths.txt").write_text("\n".join(raw[:2]))
    row = partition_size_estimate(spark, read_path_list(spark, str(tmp_path / "paths.txt"))).first()
    assert (row["n_files"], row["n_rows"]) == (2, 2)
    assert row["low_rows"] == int(300 * 1024 * 1024 / row["n_bytes"] * 2)
    assert row["high_rows"] == int(1024**3 / row["n_bytes"] * 2)
    (tmp_path / "none.txt").write_text("\n")
    empty = partition_size_estimate(spark, read_path_list(spark, str(tmp_path / "none.txt"))).first()
    assert (empty["n_files"], empty["low_rows"]) == (0, None)


def test_inventory(spark, tmp_path):
    spark.range(4).select((F.col("id") % 2).alias("tract"), "id").write.partitionBy("tract").parquet(str(tmp_path / "r"))
    files = file_inventory(spark, str(tmp_path / "r"), {"tract": (r"/tract=(\d+)/", "long"), "none": (r"/none=(\d+)/", "long")})
    rows = files.select("tract", "none", "n_bytes").distinct().collect()
    assert {r["tract"] for r in rows} == {0, 1} and all(r["n_bytes"] > 0 and r["none"] is None for r in rows)


def test_exports(spark, raw, tmp_path):
    assert export_tables(spark, {}, str(tmp_path / "out")) == []
    (written,) = export_tables(spark, {"t.parquet": raw[0]}, str(tmp_path / "out"))
    assert spark.read.parquet(written).count() == 2
    write_statistics(spark.read.parquet(written), str(tmp_path / "stats"))
    assert spark.read.parquet(str(tmp_path / "stats")).count() == 2


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    visits = spark.createDataFrame([(1, 60000.5)], "visitId long, expMidptMJD double")
    schema = "id long, visit long, psfFlux double"

    def run():
        rows = stream_files(spark, folder, T.StructType.fromDDL(schema))
        ingest_available(rows, output, checkpoint, ["psf"], visits).awaitTermination()
        found = spark.read.parquet(output).select("id", "psfFlux", "midpointMjdTai", "psfMag").collect()
        return sorted((r["id"], r["psfFlux"], r["midpointMjdTai"]) for r in found)

    spark.createDataFrame([(1, 1, 1.0)], schema).write.parquet(folder)
    assert run() == [(1, 1.0, 60000.5)]
    assert run() == [(1, 1.0, 60000.5)]
    spark.createDataFrame([(2, 1, 2.0)], schema).write.mode("append").parquet(folder)
    assert run() == [(1, 1.0, 60000.5), (2, 2.0, 60000.5)]


def test_broadcast_is_bounded(spark):
    df = spark.range(1000)
    assert fits_broadcast(df) and not fits_broadcast(df, max_bytes=1000)
    assert "Broadcast" not in broadcast_checked(df, 10)._jdf.queryExecution().analyzed().toString()
    assert not fits_broadcast(df.select(F.array("id").alias("a")))
    assert not fits_broadcast(df.select(F.repeat(F.lit("x"), 10_000).alias("long")), max_bytes=1_000_000)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_raw_files_are_written_by_several_tasks(spark, tmp_path):
    from skyweave.queries.files import add_raw_files

    rows = spark.range(4000).select("id", (F.col("id") % 2).alias("tract"), F.element_at(F.array(F.lit("g"), F.lit("r")), (F.col("id") % 2 + 1).cast("int")).alias("band"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        for _ in range(2):
            add_raw_files(rows, str(tmp_path / "raw"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "raw")).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 2000
