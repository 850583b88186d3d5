"""Refinement of partition lists, and joins that follow the cells of a catalog."""

import random

import pytest
from pyspark.sql import functions as F

from skyweave.operators.alignment import CELL, cell_number, refinement, stray_keys
from skyweave.operators.nesting import nest_in_cells, nest_sources
from skyweave.sources.catalog import open_catalog, write_catalog

LAYOUT = ["_healpix_29", "Norder", "Dir", "Npix"]


def span(order, pixel):
    return pixel << 2 * (29 - order), (pixel + 1) << 2 * (29 - order)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_refinement_against_ranges(spark, how):
    rng = random.Random(2)

    def tree():
        """Disjoint pixels of mixed orders."""
        out, todo = [], [(0, p) for p in range(12)]
        while todo:
            order, pixel = todo.pop()
            if order < 4 and rng.random() < 0.55:
                todo += [(order + 1, 4 * pixel + k) for k in range(4)]
            elif rng.random() < 0.6:
                out.append((order, pixel))
        return out

    left, right = tree(), tree()
    frame = lambda rows: spark.createDataFrame(rows, "Norder int, Npix long")
    found = {tuple(r) for r in refinement(frame(left), frame(right), how).collect()}
    wanted = set()
    for a in left:
        partners = [b for b in right if span(*a)[0] < span(*b)[1] and span(*b)[0] < span(*a)[1]]
        wanted |= {(*a, *b, *max(a, b, key=lambda x: (x[0], x == b))) for b in partners}
        if not partners and how == "left":
            wanted.add((*a, None, None, *a))
    assert {f[:4] + (f[4], f[5] if f[2] is not None else f[1]) for f in found} == wanted
    with pytest.raises(ValueError):
        refinement(frame(left), frame(right), "outer")


def test_cell_numbers_differ(spark):
    rows = [(o, p) for o in range(5) for p in range(12 * 4**o)] + [(29, 12 * 4**29 - 1), (29, 0)]
    numbers = spark.createDataFrame(rows, "o int, p long").select(cell_number("o", "p").alias("c"))
    assert numbers.distinct().count() == len(rows)
    assert numbers.where("c <= 0").isEmpty()


@pytest.fixture(scope="module")
def catalogs(spark, tmp_path_factory):
    rng = random.Random(4)
    objects = [(i, 40 + rng.gauss(0, 1.5), 10 + rng.gauss(0, 1.5)) for i in range(400)] + [(1000 + i, rng.uniform(0, 360), rng.uniform(-60, 60)) for i in range(100)]
    sources = []
    for i, ra, dec in objects:
        if i % 5:
            sources += [(i, len(sources) + k, ra + rng.gauss(0, 0.02), dec + rng.gauss(0, 0.02), rng.random()) for k in range(rng.randrange(6))]
    sources += [(7, 10_000 + k, 40.0, 10.0, rng.random()) for k in range(60)]  # far from their object, and many
    sources += [(1, 20_000, 200.0, -89.0, None), (None, 20_001, 40.0, 10.0, 0.5), (999_999, 20_002, 40.0, 10.0, 0.5)]
    root = tmp_path_factory.mktemp("cells")
    common = dict(catalog_type="object", ra="ra", dec="dec", highest_order=6)
    first = write_catalog(
        spark.createDataFrame(objects, "objectId long, ra double, dec double"), str(root / "o"), name="o", threshold=40, n_buckets=4, **common
    )
    second = write_catalog(
        spark.createDataFrame(sources, "objectId long, sourceId long, ra double, dec double, t double"),
        str(root / "s"), name="s", threshold=90, align_to=first, **common,
    )
    return first, second


def both(catalogs, how="left", max_rows=20):
    objects, sources = (c.cells().drop(*LAYOUT) for c in catalogs)
    settings = dict(on="objectId", into=["lc"], sort_by="t", tie_break=["sourceId"], how=how, max_rows=max_rows)
    return nest_in_cells(objects, [sources], **settings), nest_sources(objects.drop(CELL), [sources.drop(CELL)], **settings)


@pytest.mark.parametrize("how,max_rows", [("left", 20), ("inner", 3)])
def test_cells_nest_as_ids_do(catalogs, how, max_rows):
    by_cell, by_id = both(catalogs, how, max_rows)
    assert by_cell.columns == by_id.columns
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(by_cell) == rows(by_id)


def test_rows_at_home_are_not_shuffled(spark, catalogs):
    objects, sources = (c.cells().drop(*LAYOUT) for c in catalogs)
    away = {r.objectId for r in stray_keys(sources, objects, "objectId").collect()}
    assert {1, 7} <= away and 0 < len(away) < 400
    at_home = sources.where(~F.col("objectId").isin([*away, 999_999]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nested = nest_in_cells(objects, [at_home], on="objectId", into=["lc"], sort_by="t")
        plan = nested._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    cell_part = plan[: plan.index("special-keys")] if "special-keys" in plan else plan
    assert "SelectedBucketsCount: 4 out of 4" in plan
    assert "Exchange hashpartitioning(_cell" not in plan
    assert cell_part.count("Bucketed: true") >= 1


def test_opened_in_another_session(spark, catalogs):
    """The bucketed table is registered anew where the session does not know it."""
    first, second = catalogs
    for catalog in catalogs:
        spark.sql(f"DROP TABLE skyweave_{catalog.properties['version']}")
    again = open_catalog(spark, second.root)
    assert again.cells().count() == second.all_rows().count() == again.properties["total_rows"]
    own = open_catalog(spark, first.root).cells()
    assert own.where(F.col(CELL) != cell_number("Norder", "Npix")).isEmpty()


def test_buckets_must_agree(spark, catalogs, tmp_path):
    rows = spark.createDataFrame([(1, 1.0, 1.0)], "objectId long, ra double, dec double")
    settings = dict(name="x", catalog_type="object", ra="ra", dec="dec", threshold=10)
    with pytest.raises(ValueError, match="buckets"):
        write_catalog(rows, str(tmp_path / "a"), n_buckets=7, align_to=catalogs[0], **settings)
    plain = write_catalog(rows, str(tmp_path / "b"), **settings)
    with pytest.raises(ValueError, match="buckets"):
        plain.cells()
    with pytest.raises(ValueError, match="buckets"):
        write_catalog(rows, str(tmp_path / "c"), align_to=plain, **settings)


def test_keys_to_nest_by_id_are_found_in_one_reading_of_the_cells(catalogs, monkeypatch):
    """Cells are many small files: the passes over the keys read what one scan kept of them, and opened none again."""
    from skyweave.operators import nesting

    opened = []

    def watched(name):
        function = getattr(nesting, name)

        def call(*frames_and_options):
            opened.extend(f.inputFiles() for f in frames_and_options if hasattr(f, "inputFiles"))
            return function(*frames_and_options)

        monkeypatch.setattr(nesting, name, call)

    watched("stray_keys")
    watched("crowded_keys")
    in_cells, by_id = both(catalogs)
    assert in_cells.count() == by_id.count()
    assert opened == [[]] * 3
