"""Catalogs that grow: late sources, appended rows, files imported in steps."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from skyweave.functions.nested import flatten
from skyweave.operators.nesting import merge_sources, nest_sources
from skyweave.plans import release
from skyweave.plans.settings import CatalogSettings, NestingSettings
from skyweave.sources.catalog import append_rows, finished_files, is_valid_catalog, open_catalog, read_remote, rewrite_catalog, write_catalog
from skyweave.sources.files import file_inventory
from skyweave.streaming import ingest

FIELDS = "objectId long, t double, k long, v string"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    objects = [(i, rng.uniform(0, 360), rng.uniform(-80, 80)) for i in range(60)] + [(7, 10.0, 10.0), (None, 1.0, 1.0)]

    def sources(n, first):
        ids = [rng.choice([None, 3, 3, 3, *range(20), 999]) for _ in range(n)]
        return [(i, rng.choice([None, float(rng.randrange(5))]), first + j, rng.choice("ab")) for j, i in enumerate(ids)]

    batches = [sources(150, 0), sources(60, 1000), sources(80, 2000)]
    frame = lambda rows: spark.createDataFrame(rows, FIELDS)
    return spark.createDataFrame(objects, "objectId long, ra double, dec double"), [frame(b) for b in batches]


def curves(df, columns=("lc", "more")):
    out = []
    for c in columns:
        flat = flatten(df, c, ["objectId", "ra"])
        out.append(sorted((tuple(r) for r in flat.select("objectId", "ra", "_pos", "t", "k", "v").collect()), key=repr))
    parts = df.select("objectId", "ra", "_part", "_start", *[F.size(c) for c in columns])
    return out, sorted((tuple(r) for r in parts.collect()), key=repr)


@pytest.mark.parametrize("max_rows", [3, 1000])
def test_late_sources_give_what_all_sources_give(spark, tables, max_rows):
    objects, (a, b, c) = tables
    how = dict(on="objectId", into=["lc", "more"], sort_by="t", tie_break=["k"], max_rows=max_rows)
    before = nest_sources(objects, [a, b], **how)
    after = merge_sources(before, {"lc": c.withColumn("unknown", F.lit(1))}, **how)
    assert curves(after) == curves(nest_sources(objects, [a.unionByName(c), b], **how))
    both = merge_sources(before, {"more": a, "lc": b.drop("v")}, **how)
    assert curves(both) == curves(nest_sources(objects, [a.unionByName(b.withColumn("v", F.lit(None).cast("string"))), b.unionByName(a)], **how))
    assert curves(merge_sources(before, {"lc": a.limit(0)}, **how)) == curves(before)
    assert curves(merge_sources(before.limit(0), {"lc": a}, **how)) == ([[], []], [])
    with pytest.raises(ValueError):
        merge_sources(before, {"other": a}, **how)


def test_late_sources_leave_other_partitions(spark, tables, tmp_path):
    objects, (a, b, c) = tables
    settings = NestingSettings("object", "objectId", (), ("lc", "more"), sort_by="t", density_orders=(2,))
    how = dict(on="objectId", into=["lc", "more"], sort_by="t", tie_break=["k"], max_rows=4)
    nested = nest_sources(objects, [a, b], **how)
    root = str(tmp_path / "lc")
    first = write_catalog(nested, root, name="lc", catalog_type="object", ra="ra", dec="dec", threshold=6, highest_order=6)
    release.catalog_density(first, [2]).write.parquet(first.density_path)
    late = c.where("objectId in (5, 6, 999)")
    second = release.add_sources(first, {"lc": late}, settings, tie_break=["k"], max_rows=4)
    assert curves(second.all_rows()) == curves(nest_sources(objects, [a.unionByName(late), b], **how))
    assert curves(first.all_rows()) == curves(nested)
    assert is_valid_catalog(spark, root) and is_valid_catalog(spark, root, strict=True)
    own = second.placed_partitions().where(F.col("data_version") == second.properties["version"])
    assert 0 < own.count() <= 2 < second.properties["n_partitions"]
    assert second.properties["total_rows"] == second.all_rows().count()
    assert spark.read.parquet(second.density_path).count() == spark.read.parquet(first.density_path).count()
    third = release.add_sources(second, {"more": a}, settings, tie_break=["k"], max_rows=4)
    wanted = curves(nest_sources(objects, [a.unionByName(late), b.unionByName(a)], **how))
    assert curves(open_catalog(spark, root).all_rows()) == wanted
    whole = rewrite_catalog(third, lambda df: df)
    assert whole.data_versions == [whole.properties["version"]] and curves(whole.all_rows()) == wanted


def partition_spans(catalog):
    rows = catalog.partitions().collect()
    return sorted((r.Npix << 2 * (29 - r.Norder), (r.Npix + 1) << 2 * (29 - r.Norder), r.Norder, r.n_rows) for r in rows)


def test_appended_rows(spark, tmp_path):
    rng = random.Random(5)
    place = lambda n: [(rng.uniform(0, 360), rng.uniform(-89, 89)) if rng.random() < 0.4 else (rng.gauss(50, 0.5), rng.gauss(5, 0.5)) for _ in range(n)]
    batches = [[(1000 * b + i, *p) for i, p in enumerate(place(n))] for b, n in enumerate((80, 150, 0, 200, 5))]
    batches[3] += [(9999, 50.0, 5.0)] * 90  # more rows at one place than a partition may hold
    frame = lambda rows: spark.createDataFrame(rows, "id long, ra double, dec double")
    root, threshold, order = str(tmp_path / "grow"), 25, 7
    first = write_catalog(frame(batches[0]), root, name="x", catalog_type="object", ra="ra", dec="dec", threshold=threshold, highest_order=order)
    catalog = first
    for b, rows in enumerate(batches[1:], 1):
        catalog = append_rows(catalog, frame(rows).withColumn("unknown", F.lit(1)), threshold, batch=str(b))
        again = append_rows(catalog, frame(rows), threshold, batch=str(b))
        assert again.properties["version"] == catalog.properties["version"]
        wanted = sorted(r for rows in batches[: b + 1] for r in rows)
        assert sorted((r.id, r.ra, r.dec) for r in open_catalog(spark, root).all_rows().collect()) == wanted
        assert is_valid_catalog(spark, root) and is_valid_catalog(spark, root, strict=True)
        spans = partition_spans(catalog)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        assert all(n <= threshold or o == order for *_, o, n in spans)
        assert sum(n for *_, n in spans) == len(wanted) == catalog.properties["total_rows"]
        assert len(spans) == catalog.properties["n_partitions"]
    assert len(catalog.data_versions) > 1
    assert first.all_rows().count() == 80
    cone = catalog.cone(50.0, 5.0, 600.0).count()
    assert cone == rewrite_catalog(catalog, lambda df: df).cone(50.0, 5.0, 600.0).count() > 90
    with pytest.raises(Exception, match="no position"):
        append_rows(open_catalog(spark, root), frame([(1, None, 2.0)]), threshold)


def test_appended_to_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, ra double, dec double")
    root = str(tmp_path / "none")
    catalog = write_catalog(empty, root, name="x", catalog_type="object", ra="ra", dec="dec", threshold=5)
    rows = spark.createDataFrame([(i, 30.0 * i, 5.0) for i in range(12)], empty.schema)
    assert append_rows(catalog, rows, 5).all_rows().count() == 12
    assert is_valid_catalog(spark, root, strict=True)


def test_interrupted_import_goes_on(spark, tmp_path, monkeypatch):
    folder, root = str(tmp_path / "raw"), str(tmp_path / "catalog")
    rows = spark.range(300).selectExpr("id", "id * 1.1 AS ra", "(id % 90) - 45.0 AS dec", "id % 6 AS tract")
    rows.repartition("tract").write.partitionBy("tract").parquet(folder)
    index = file_inventory(spark, folder, {"tract": (r"/tract=(\d+)/", "bigint")}).select("path", "tract")
    settings = CatalogSettings(dims=("tract",), group_by=("tract",), ra="ra", dec="dec", catalog_type="object", threshold=40)
    go = lambda: release.import_new_files(spark, index, root, "x", settings, files_per_step=2)
    real = release.append_rows

    def lost(*_args, **_kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(release, "append_rows", lost)
    with pytest.raises(RuntimeError, match="lost"):
        go()
    assert finished_files(spark, root).count() == 2
    monkeypatch.setattr(release, "append_rows", real)
    assert (len(go()), len(go())) == (2, 0)
    found = sorted((r.id, r.tract) for r in open_catalog(spark, root).all_rows().collect())
    assert found == [(i, i % 6) for i in range(300)]
    assert is_valid_catalog(spark, root, strict=True)


def test_streamed_batches_are_taken_once(spark, tmp_path, monkeypatch):
    """A batch lost after its version was recorded, one lost before, a new checkpoint, and files imported by list."""
    folder, root, state = (str(tmp_path / n) for n in ("raw", "catalog", "state"))
    rows = spark.range(300).selectExpr("id", "id * 1.1 AS ra", "(id % 90) - 45.0 AS dec", "id % 6 AS tract")
    settings = CatalogSettings(dims=("tract",), group_by=("tract",), ra="ra", dec="dec", catalog_type="object", threshold=40)
    keys = {"tract": (r"/tract=(\d+)/", "bigint"), "absent": (r"/absent=(\d+)/", "int")}

    def arrive(condition):
        rows.where(condition).coalesce(1).write.mode("append").partitionBy("tract").parquet(folder)

    def run(checkpoint=state):
        stream = ingest.stream_keyed_files(spark, folder, rows.drop("tract").schema, keys, max_files_per_trigger=1)
        ingest.import_available(stream, root, "x", settings, checkpoint).awaitTermination()

    def found():
        return sorted((r.id, r.tract) for r in open_catalog(spark, root).all_rows().where("absent is null").collect())

    arrive("tract < 3")
    real = ingest.take_in

    def recorded_then_lost(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost after")

    monkeypatch.setattr(ingest, "take_in", recorded_then_lost)
    with pytest.raises(Exception, match="lost after"):
        run()
    assert finished_files(spark, root).count() == 1
    monkeypatch.setattr(ingest, "take_in", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost before")))
    with pytest.raises(Exception, match="lost before"):
        run()
    monkeypatch.setattr(ingest, "take_in", real)
    run()
    assert found() == [(i, i % 6) for i in range(300) if i % 6 < 3]
    assert open_catalog(spark, root).properties["number"] == 3

    arrive("tract in (3, 4)")
    index = file_inventory(spark, folder, {"tract": keys["tract"]}).where("tract = 3").select("path", "tract")
    assert len(release.import_new_files(spark, index, root, "x", settings)) == 1
    run()
    run(f"{state}-new")
    arrive("tract = 5")
    run(f"{state}-new")
    assert found() == [(i, i % 6) for i in range(300)]
    assert open_catalog(spark, root).properties["number"] == 6
    assert finished_files(spark, root).groupBy("path").count().where("count > 1").isEmpty()
    assert is_valid_catalog(spark, root, strict=True)


def test_catalog_is_calibrated_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, 10.0, 5.0, 7, 3631.0), (2, 20.0, 5.0, None, None)], "id long, ra double, dec double, visit long, psfFlux double")
    visits = spark.createDataFrame([(7, 60000.5)], "visitId long, expMidptMJD double")
    root = str(tmp_path / "sources")
    catalog = write_catalog(rows, root, name="x", catalog_type="source", ra="ra", dec="dec", threshold=5)
    plain = CatalogSettings(dims=(), group_by=(), ra="ra", dec="dec", catalog_type="source", threshold=5)
    assert release.calibrate_catalog(catalog, plain).properties["number"] == 1
    magnitudes = replace(plain, flux_prefixes=("psf",))
    both = replace(magnitudes, add_time=True)
    second = release.calibrate_catalog(catalog, magnitudes)
    third = release.calibrate_catalog(second, both, visits)
    assert [c.properties["number"] for c in (second, third, release.calibrate_catalog(third, both, visits))] == [2, 3, 3]
    assert [r.midpointMjdTai for r in third.all_rows().orderBy("id").collect()] == [60000.5, None]
    assert "midpointMjdTai" not in second.all_rows().columns and "psfMag" not in catalog.all_rows().columns


def test_surveys_over_http_are_an_error(spark):
    with pytest.raises(ValueError, match="not over http"):
        read_remote(spark, "https://example.org/survey")
