import random

import pytest
from pyspark.sql import functions as F

from skyweave.functions.sky import PIXEL, with_pixel
from skyweave.operators.correction import Model, batch_scorer
from skyweave.operators.keys import lookup_places
from skyweave.operators.nesting import PART
from skyweave.operators.partitioning import assign_partitions, partition_map, pixel_histogram
from skyweave.operators.statistics import column_statistics
from skyweave.plans.release import (
    catalog_density,
    collect,
    correct_collection,
    match_surveys,
    nest_catalog,
    verify_columns,
)
from skyweave.plans.settings import (
    CATALOGS,
    COLLECTIONS,
    NESTINGS,
    RANGE_RULES,
    CollectionSettings,
    CorrectionSettings,
    NestingSettings,
    SurveySettings,
    corrected_columns,
)
from skyweave.sources.catalog import (
    catalog_problems,
    dataset_exists,
    is_reusable_margin,
    is_valid_catalog,
    open_catalog,
    process_partitions,
    repartition_catalog,
    rewrite_catalog,
    write_catalog,
    write_index,
    write_margin,
    write_statistics,
)
from skyweave.sources.exports import collection_summary, write_summaries


def sky_rows(n=1500):
    rng = random.Random(21)
    rows = [(i, rng.uniform(0, 360), rng.uniform(-80, 80)) for i in range(n // 2)]
    return rows + [(n + i, 40 + rng.gauss(0, 1), 10 + rng.gauss(0, 1)) for i in range(n // 2)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(sky_rows(), "objectId long, ra double, dec double")


def write(table, root, **kwargs):
    settings = dict(name="object", catalog_type="object", ra="ra", dec="dec", threshold=200, highest_order=6)
    return write_catalog(table, str(root), **{**settings, **kwargs})


@pytest.fixture(scope="module")
def catalog(table, tmp_path_factory):
    return write(table, tmp_path_factory.mktemp("catalogs") / "object")


def ids(df):
    return sorted(r["objectId"] for r in df.select("objectId").collect())


def test_round_trip(spark, table, catalog):
    again = open_catalog(spark, catalog.root)
    assert ids(again.rows()) == ids(table)
    assert again.properties["total_rows"] == table.count()
    parts = again.partitions().collect()
    assert sum(r["n_rows"] for r in parts) == table.count()
    assert again.properties["n_partitions"] == len(parts) > 12
    assert all(r["Dir"] == r["Npix"] // 10_000 * 10_000 and r["n_bytes"] > 0 for r in parts)
    assert is_valid_catalog(spark, catalog.root, strict=True)


def test_rows_inside_a_file_follow_the_sky_curve(spark, catalog):
    file = F.col("_metadata.file_path")
    rows = catalog.all_rows().select(file.alias("f"), "_metadata.row_index", PIXEL).collect()
    by_file = {}
    for f, at, pixel in rows:
        by_file.setdefault(f, []).append((at, pixel))
    for pairs in by_file.values():
        pixels = [p for _, p in sorted(pairs)]
        assert pixels == sorted(pixels)


def test_existing_catalog_is_refused_resumed_or_replaced(spark, table, tmp_path):
    first = write(table, tmp_path / "c")
    with pytest.raises(FileExistsError):
        write(table, tmp_path / "c")
    assert write(table.limit(5), tmp_path / "c", resume=True).properties == first.properties
    assert write(table.limit(5), tmp_path / "c", overwrite=True).properties["total_rows"] == 5
    assert ids(open_catalog(spark, str(tmp_path / "c")).rows()) == ids(table.limit(5))


def test_absent_catalog(spark, tmp_path):
    assert not is_valid_catalog(spark, str(tmp_path / "none"))
    assert not dataset_exists(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        open_catalog(spark, str(tmp_path / "none"))


def test_row_without_position_is_an_error(spark, tmp_path):
    bad = spark.createDataFrame([(1, 1.0, None)], "objectId long, ra double, dec double")
    with pytest.raises(Exception, match="no position"):
        write(bad, tmp_path / "bad")


def test_empty_catalog(spark, table, tmp_path):
    empty = write(table.limit(0), tmp_path / "empty")
    assert empty.properties["total_rows"] == 0 and empty.all_rows().count() == 0
    assert is_valid_catalog(spark, empty.root, strict=True)
    margin = write_margin(empty, str(tmp_path / "margin"), 1.0)
    assert margin.all_rows().columns == empty.all_rows().columns


def test_damage_is_noticed(spark, table, tmp_path):
    damaged = write(table, tmp_path / "damaged")
    extra = damaged.all_rows().limit(1).withColumn(PIXEL, F.lit(0).cast("long"))
    extra = extra.withColumns({"Norder": F.lit(5), "Npix": F.lit(77), "Dir": F.lit(0)})
    extra.write.mode("append").partitionBy("Norder", "Dir", "Npix").parquet(damaged.data_path)
    found = {r["problem"]: r["n"] for r in catalog_problems(spark, damaged.root).collect()}
    assert found == {
        "partitions not recorded": 1, "rows outside their pixel": 1, "difference to the recorded total": 1,
    }
    assert not is_valid_catalog(spark, damaged.root) and not is_valid_catalog(spark, damaged.root, strict=True)


def test_crowded_pixel_is_written_by_several_tasks(spark, tmp_path):
    """A third of all rows at one point: the write splits them over tasks and files."""
    n = 30_000
    df = spark.range(0, n, 1, 8).select(
        F.col("id").alias("objectId"),
        F.when(F.col("id") % 3 == 0, 40.0).otherwise((F.col("id") * 137.5) % 360).alias("ra"),
        F.when(F.col("id") % 3 == 0, 10.0).otherwise((F.col("id") * 7.3) % 160 - 80).alias("dec"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.1",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        crowded = write(df, tmp_path / "crowded", threshold=3_000)
    finally:
        for key in conf:
            spark.conf.unset(key)
    files = crowded.all_rows().select("Norder", "Npix", F.col("_metadata.file_path").alias("f"))
    per_partition = files.groupBy("Norder", "Npix").agg(F.countDistinct("f").alias("n"), F.count("f").alias("rows"))
    top = per_partition.orderBy(F.desc("rows")).first()
    assert top["rows"] >= n // 3 and top["n"] > 1
    assert is_valid_catalog(spark, crowded.root, strict=True)


def test_cone_reads_only_near_folders(catalog, table):
    cone = catalog.cone(40.0, 10.0, 1800.0)
    plan = cone._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    from skyweave.operators.spatial import cone_search

    assert ids(cone) == ids(cone_search(table, 40.0, 10.0, 1800.0)) != []


def test_default_columns_and_repartition(spark, catalog, tmp_path):
    fine = repartition_catalog(
        catalog, str(tmp_path / "fine"), threshold=50, highest_order=8, default_columns=["objectId", "none", "ra"]
    )
    assert fine.properties["default_columns"] == "objectId,ra"
    assert fine.rows().columns == ["objectId", "ra"]
    assert fine.rows(["dec"]).columns == ["dec"]
    assert set(fine.rows("all").columns) == {"objectId", "ra", "dec", PIXEL, "Norder", "Dir", "Npix"}
    assert fine.properties["n_partitions"] > catalog.properties["n_partitions"]
    assert ids(fine.rows()) == ids(catalog.rows())


def test_rewrite_keeps_old_files_and_partitions(spark, table, tmp_path):
    before = write(table, tmp_path / "r")
    after = rewrite_catalog(before, lambda df: df.withColumn("twice", F.col("ra") * 2))
    assert ids(before.all_rows()) == ids(after.all_rows())
    places = lambda c: sorted(tuple(r) for r in c.partitions().select("Norder", "Npix", "n_rows").collect())
    assert places(before) == places(after)
    assert "twice" in open_catalog(spark, before.root).rows().columns
    assert is_valid_catalog(spark, after.root, strict=True)


def test_unfinished_partitions_are_processed(spark, catalog, tmp_path):
    output = str(tmp_path / "done")
    add = lambda df: df.withColumn("psfMag", F.lit(1.0))
    n = catalog.properties["n_partitions"]
    some = catalog.partitions().where(F.col("Norder") > 1).select("Norder", "Npix")
    n_some = some.count()
    tally = lambda *args: {r["status"]: r["n_partitions"] for r in process_partitions(catalog, output, add, *args).collect()}
    assert tally("a", some) == {"processed": n_some}
    assert tally("a") == {"processed": n - n_some, "skipped": n_some} and 0 < n_some < n
    assert ids(spark.read.parquet(output)) == ids(catalog.all_rows())
    assert tally("a") == {"skipped": n}
    assert tally("b", some) == {"processed": n_some}
    assert tally("b") == {"processed": n - n_some, "skipped": n_some}
    assert ids(spark.read.parquet(output)) == ids(catalog.all_rows())


def test_lost_partition_is_not_made_up_for_by_another(spark, table, tmp_path):
    catalog = write(table, tmp_path / "v")
    assert is_valid_catalog(spark, catalog.root)
    record = f"{catalog.root}/partitions-{catalog.properties['version']}"
    moved = catalog.partitions().withColumn("Npix", F.col("Npix") + 100_000).collect()
    spark.createDataFrame(moved, catalog.partitions().schema).write.mode("overwrite").parquet(record)
    assert not is_valid_catalog(spark, catalog.root)


def test_stale_index_and_margin_are_built_anew(spark, table, tmp_path):
    first = write(table, tmp_path / "s")
    settings = CollectionSettings("s", "objectId", margin_arcsec=300.0)
    collect(first, str(tmp_path / "k"), settings)
    finer = write(table, tmp_path / "s", threshold=20, overwrite=True)
    second = collect(finer, str(tmp_path / "k"), settings, resume=True)
    wanted = table.select("objectId").limit(40)
    assert second.rows_of(wanted).count() == wanted.count()
    assert second.margin.properties["source_version"] == finer.properties["version"]
    assert finer.properties["number"] == 2


def test_row_outside_the_plan_is_an_error(spark, table):
    placed = with_pixel(table, "ra", "dec")
    plan = partition_map(pixel_histogram(placed.where("dec > 0"), 6), 6, 50)
    assert assign_partitions(placed.where("dec > 0"), plan).count() == placed.where("dec > 0").count()
    with pytest.raises(Exception, match="no planned partition"):
        assign_partitions(placed, plan).collect()
    assert assign_partitions(placed, plan, outside="drop").count() >= placed.where("dec > 0").count()


def test_collection(spark, catalog, tmp_path):
    root = str(tmp_path / "collection")
    collection = collect(catalog, root, CollectionSettings("object_lc", "objectId", margin_arcsec=300.0))
    wanted = spark.createDataFrame([(3,), (1510,), (10**9,)], "objectId long")
    assert ids(collection.rows_of(wanted)) == [3, 1510]
    assert is_reusable_margin(collection.catalog, collection.margin.root, 300.0)
    assert not is_reusable_margin(collection.catalog, collection.margin.root, 5.0)
    again = write_margin(catalog, collection.margin.root, 300.0, resume=True)
    assert again.properties["version"] == collection.margin.properties["version"]
    index = collection.index()
    assert index.count() == catalog.properties["total_rows"]

    survey = catalog.all_rows().select(F.col("objectId").alias("objectid"), "ra", (F.col("dec") + 1e-5).alias("dec"))
    survey.where("objectid % 2 = 0").write.parquet(str(tmp_path / "survey"))
    surveys = {"ztf": SurveySettings(str(tmp_path / "survey"), "_ztf", "objectid")}
    written = match_surveys({"c": collection}, surveys, root)
    pairs = open_catalog(spark, written["object_x_ztf"]).all_rows()
    assert open_catalog(spark, written["object_x_ztf"]).properties["catalog_type"] == "association"
    assert {PIXEL, "Norder", "Dir", "Npix", "_dist_arcsec", "objectid_ztf"} <= set(pairs.columns)
    assert ids(pairs) == sorted(i for i in ids(catalog.all_rows()) if i % 2 == 0)
    assert match_surveys({"c": collection}, surveys, root, resume=True) == written


def test_far_ids_read_their_folders_only(spark, catalog, tmp_path):
    index = write_index(catalog, str(tmp_path / "index"), "objectId", rows_per_folder=50)
    assert index.select("_h").distinct().count() == 30 == index.first()["_n"]
    assert index.count() == catalog.properties["total_rows"]
    wanted = spark.createDataFrame([(0,), (2_249,)], "objectId long")
    places = lookup_places(index, wanted, "objectId")
    assert sorted(r["objectId"] for r in places.collect()) == [0, 2249]
    plan = places._jdf.queryExecution().executedPlan().toString()
    assert "In(objectId, [0,2249])" in plan and "dynamicpruning" in plan
    folders = index.where(F.col("objectId").isin(0, 2_249)).select(F.input_file_name()).distinct().count()
    assert folders <= 2
    assert lookup_places(index.limit(0), wanted, "objectId").isEmpty()


def test_statistics_of_a_version(spark, tmp_path):
    """Merged from partitions they are those of the rows; after a change only the changed partitions are read."""
    rng = random.Random(3)
    rows = [(i, ra, dec, None if i % 7 == 0 else float("nan") if i % 5 == 0 else rng.gauss(0, 9), f"s{i % 11}") for i, ra, dec in sky_rows(400)]
    rows = spark.createDataFrame(rows, "objectId long, ra double, dec double, v double, s string")
    first = write(rows, tmp_path / "c", threshold=30)
    write_statistics(first)
    columns = ["column", "min_value", "max_value", "null_count", "n_rows"]
    direct = lambda df: sorted(map(tuple, column_statistics(df.drop("Norder", "Dir", "Npix")).select(*columns).collect()))
    kept = lambda c, *a: sorted(map(tuple, c.statistics(*a).select(*columns).collect()))
    assert kept(first) == direct(first.all_rows())
    some = first.partitions().where("Npix % 2 = 0").select("Norder", "Npix")
    assert kept(first, some) == direct(first.all_rows().join(some, ["Norder", "Npix"], "left_semi"))
    mean = {r["column"]: r["mean_value"] for r in first.statistics().collect()}
    assert mean["v"] == pytest.approx(first.all_rows().where("not isnan(v)").agg(F.avg("v")).first()[0])
    assert mean["s"] is None
    second = rewrite_catalog(first, lambda df: df.withColumn("v", F.when(F.col("Npix") % 2 == 0, F.col("v") * 2).otherwise(F.col("v"))))
    write_statistics(second, before=first, changed=some)
    assert kept(second) == direct(second.all_rows())
    files = {f.rsplit("/", 2)[-2] for f in second.statistics().inputFiles()}
    assert all("statistics-" in f for f in second.partition_statistics().inputFiles()) and files


def test_light_curves_corrected(spark, catalog, table, tmp_path):
    sources = table.crossJoin(spark.range(3).withColumnRenamed("id", "n")).select(
        "objectId", "ra", "dec", F.col("n").alias("visit"), F.lit(1).cast("long").alias("detector"),
        (60000.0 - F.col("n")).alias("midpointMjdTai"), (F.col("n") + 1.0).alias("psfFlux"),
        F.lit(2.0).alias("psfFluxErr"), F.lit(1.0).alias("psfDiffFlux"), F.lit(4.0).alias("psfDiffFluxErr"),
    )
    source_catalog = write(sources, tmp_path / "forced", name="forced", catalog_type="source", threshold=500)
    settings = NestingSettings("object", "objectId", ("forced",), ("objectForcedSource",), threshold=100, highest_order=7,
                               default_columns=("objectId", "objectForcedSource.visit"))
    nested = nest_catalog(catalog, [source_catalog], str(tmp_path / "lc"), "object_lc", settings)
    assert is_valid_catalog(spark, nested.root, strict=True)
    assert nested.properties["default_columns"] == f"objectId,objectForcedSource.visit,{PART},_start"
    assert nested.rows().where("objectId = 3").first()["objectForcedSource"] == [(2,), (1,), (0,)]
    assert catalog_density(nested, (2, 4)).groupBy("map_order").agg(F.sum("n_rows").alias("n")).select("n").distinct().collect() == [(1500,)]

    names = ["skyBg", "seeing", "expTime", "detector_rho", "detector_cos_phi", "detector_sin_phi"]
    names += [f"is_{b}_band" for b in "ugrizy"]
    features = spark.range(3).select(
        F.col("id").alias("visit"), F.lit(1).cast("long").alias("detector"), *[F.lit(1.0).alias(n) for n in names]
    )
    models = {
        "science_source": Model(batch_scorer(lambda: lambda b: b[:, 0]), 15),
        "diff_source": Model(batch_scorer(lambda: lambda b: b[:, 1]), 16),
    }
    corrected = correct_collection(
        nested, str(tmp_path / "corrected"), CorrectionSettings(False, corrected_columns("objectForcedSource")), models,
        features, "objectId",
    )
    assert is_valid_catalog(spark, corrected.root, strict=True)
    row = corrected.rows().where("objectId = 3").first()["objectForcedSource"]
    assert [e["psfFluxErr_corrected"] for e in row] == [6.0, 4.0, 2.0]
    assert [e["psfDiffFluxErr_corrected"] for e in row] == [16.0] * 3
    assert not any(e["psfFluxErr_corrected_flag"] for e in row)


def test_summary(spark, catalog, tmp_path):
    summary = collection_summary(catalog, "object_collection", version="w1", run=None, tag=None, badges=["Internal"])
    write_summaries([summary, summary], str(tmp_path / "w1.json"))
    row = spark.read.json(str(tmp_path / "w1.json")).first()
    assert (row["label"], row["name"], row["description"]) == (
        "w1/object_collection", "w1 object_collection", "DRP/w1 object_collection",
    )
    assert row["metadata"]["numRows"] == 1500 and row["metadata"]["numPartitions"] == catalog.properties["n_partitions"]
    assert row["metadata"]["builder"].startswith("skyweave") and row["badges"][0]["title"] == "Internal"


def test_report(spark, catalog):
    statistics, ranges, nulls = verify_columns(catalog.all_rows(), RANGE_RULES["dia_object"])
    assert {r["column"]: r["in_range"] for r in ranges.collect()} == {"ra": False, "dec": True} or all(
        r["in_range"] for r in ranges.collect()
    )
    assert statistics.count() == 7 and nulls.count() == 0


def test_settings_fit_together():
    assert set(COLLECTIONS) == {"dia_object_collection", "object_collection"}
    for collection in COLLECTIONS.values():
        nesting = NESTINGS[collection.nested_catalog]
        assert {nesting.object_catalog, *nesting.source_catalogs} <= set(CATALOGS)
        assert len(nesting.source_catalogs) == len(nesting.nested_columns)
        assert collection.index_column == nesting.join_id
    assert set(RANGE_RULES) == set(CATALOGS)


def test_small_files_are_dealt_over_tasks_and_crowded_partitions_in_pieces(spark, monkeypatch):
    from skyweave.sources import catalog as module

    monkeypatch.setattr(module, "FILES_PER_TASK", 8)
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("Npix"))
    rows = rows.withColumns({"Norder": F.lit(5), "Dir": F.lit(0).cast("long"), "_healpix_29": F.col("id")})
    planned = rows.groupBy("Norder", "Dir", "Npix").agg(F.count(F.lit(1)).alias("n_rows"))
    dealt = module._dealt(rows, planned, 0)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 3 and max(sizes) < 1500
    assert dealt.columns == rows.columns and sorted(r["id"] for r in dealt.collect()) == list(range(3000))
    chunks = module._dealt(rows, planned, 10)
    assert chunks.rdd.getNumPartitions() == 44


def test_a_version_is_listed_once(spark, tmp_path):
    rows = spark.range(100).select(F.col("id"), (F.col("id") * 3.0).alias("ra"), (F.col("id") * 0.5).alias("dec"))
    catalog = write_catalog(rows, str(tmp_path / "c"), name="c", catalog_type="object", ra="ra", dec="dec", threshold=10)
    assert catalog.all_rows() is catalog.all_rows()
    assert catalog.all_rows().count() == open_catalog(spark, catalog.root).all_rows().count() == 100


def test_small_files_of_margins_and_associations_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    from skyweave.sources import catalog as module

    monkeypatch.setattr(module, "FILES_PER_TASK", 8)
    rows = spark.range(600).select(F.col("id"), (F.col("id") * 137.5 % 360).alias("ra"), (F.col("id") * 73.1 % 180 - 90).alias("dec"))
    catalog = write_catalog(rows, str(tmp_path / "c"), name="c", catalog_type="object", ra="ra", dec="dec", threshold=10, highest_order=3)
    collection = collect(catalog, str(tmp_path / "collection"), CollectionSettings("c", "id", margin_arcsec=7200.0))
    rows.select(F.col("id").alias("other"), "ra", "dec").write.parquet(str(tmp_path / "survey"))
    written = match_surveys({"c": collection}, {"s": SurveySettings(str(tmp_path / "survey"), "_s", "other")}, str(tmp_path / "matches"))
    matches = open_catalog(spark, written["c_x_s"])
    assert matches.properties["total_rows"] == 600
    for table in (collection.margin, matches):
        writers = table.all_rows().select(F.regexp_extract(F.col("_metadata.file_path"), r"/part-(\d+)-", 1)).distinct().count()
        assert table.properties["n_partitions"] > 40 and writers > 3


def test_folders_are_listed_by_few_tasks_and_files_have_no_checksum_files(spark, tmp_path):
    rows = spark.range(4_000).select("id", (F.col("id") % 360).cast("double").alias("ra"), (F.col("id") % 170 - 85.0).alias("dec"))
    written = write_catalog(rows, f"{tmp_path}/c", name="c", catalog_type="object", ra="ra", dec="dec", threshold=20, highest_order=5)
    most = 4 * spark.sparkContext.defaultParallelism
    assert written.properties["n_partitions"] > most
    spark.sparkContext.setJobGroup("listing", "folders of a catalog")
    try:
        again = open_catalog(spark, f"{tmp_path}/c").all_rows()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)]
    assert tasks and max(tasks) <= most
    assert again.count() == 4_000
    assert not list((tmp_path / "c" / f"data-{written.properties['version']}").rglob(".*.parquet.crc"))
