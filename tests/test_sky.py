import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweave.functions import pixels
from skyweave.functions.pixels import coverage, edge_distance, face_vector, near_edge, split_pixel
from skyweave.functions.sky import (
    PIXEL,
    chord,
    parent_pixel,
    pixel_reach,
    pixel_width_arcsec,
    ra_dec_of,
    with_face_position,
    with_face_vector,
    with_pixel,
    with_unit_vector,
)
from skyweave.operators.partitioning import (
    assign_partitions,
    density_map,
    partition_map,
    pixel_histogram,
)
from skyweave.operators.spatial import (
    cone_search,
    crossmatch,
    declination_bands,
    margin_rows,
    rows_in_coverage,
    multi_cone,
    partitions_in_cone,
    tree_candidates,
)

VECTOR = ("vx", "vy", "vz")


def separation(a, b):
    (ra1, dec1), (ra2, dec2) = a, b
    ra1, dec1, ra2, dec2 = map(math.radians, (ra1, dec1, ra2, dec2))
    h = math.sin((dec1 - dec2) / 2) ** 2 + math.cos(dec1) * math.cos(dec2) * math.sin((ra1 - ra2) / 2) ** 2
    return math.degrees(2 * math.asin(min(1.0, math.sqrt(h)))) * 3600


def uniform(n, seed=1):
    rng = random.Random(seed)
    return [(i, rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for i in range(n)]


def points(spark, rows):
    return spark.createDataFrame(rows, "id long, ra double, dec double")


SPECIAL = [
    (0, 0.0, 90.0), (1, 10.0, -90.0), (2, 0.0, 0.0), (3, 360.0, 0.0), (4, -10.0, 5.0), (5, 350.0, 5.0),
    (6, 45.0, math.degrees(math.asin(2 / 3))), (7, 45.0, -math.degrees(math.asin(2 / 3))), (8, 359.9999999999, 41.8),
]


def test_pixels_of_all_orders_are_shifts_of_the_finest(spark):
    df = points(spark, SPECIAL + [(i + 100, r, d) for i, r, d in uniform(4000)])
    for order in (0, 1, 5, 11):
        both = with_pixel(with_pixel(df), out="direct", order=order)
        assert both.where(F.col("direct") != parent_pixel(F.col(PIXEL), 29, order)).count() == 0
        assert both.where((F.col("direct") < 0) | (F.col("direct") >= 12 * 4**order)).count() == 0


def test_equivalent_right_ascensions(spark):
    pixels = {r["id"]: r[PIXEL] for r in with_pixel(points(spark, SPECIAL)).collect()}
    assert pixels[2] == pixels[3] and pixels[4] == pixels[5]


def test_missing_positions_have_no_pixel(spark):
    rows = [(1, None, 1.0), (2, 1.0, float("nan"))]
    assert [r[PIXEL] for r in with_pixel(points(spark, rows)).collect()] == [None, None]


def test_pixels_have_equal_areas(spark):
    counts = pixel_histogram(with_pixel(points(spark, uniform(48_000))), 1).collect()
    assert len(counts) == 48 and all(800 < r["n_rows"] < 1200 for r in counts)


@pytest.mark.parametrize("order", [0, 3, 6])
def test_pixel_centres_map_back(spark, order):
    pixels = spark.range(12 * 4**order).select(F.col("id").alias("p"), F.lit(order).alias("o"))
    placed = with_face_position(pixels, "p", "o")
    centre = with_face_vector(placed, "_face", F.col("_ix") + 0.5, F.col("_iy") + 0.5, F.lit(1 << order), VECTOR)
    ra, dec = ra_dec_of(*[F.col(v) for v in VECTOR])
    back = with_pixel(centre.withColumns({"ra": ra, "dec": dec}), out="q", order=order)
    assert back.where(F.col("q") != F.col("p")).count() == 0


@pytest.mark.parametrize("order", [0, 2, 5])
def test_reach_bounds_the_pixel(spark, order):
    df = with_pixel(points(spark, uniform(20_000)))
    df = df.select("ra", "dec", parent_pixel(F.col(PIXEL), 29, order).alias("p"), F.lit(order).alias("o"))
    placed = with_face_position(df, "p", "o")
    centre = with_face_vector(placed, "_face", F.col("_ix") + 0.5, F.col("_iy") + 0.5, F.lit(1 << order), VECTOR)
    ra, dec = F.radians("ra"), F.radians("dec")
    dot = F.col("vx") * F.cos(dec) * F.cos(ra) + F.col("vy") * F.cos(dec) * F.sin(ra) + F.col("vz") * F.sin(dec)
    far = centre.where(F.acos(F.least(dot, F.lit(1.0))) > pixel_reach(F.lit(1 << order)))
    assert far.count() == 0


@pytest.mark.parametrize(
    "ra,dec,radius", [(0.0, 0.0, 3.0), (359.0, 40.0, 8.0), (10.0, 89.0, 5.0), (200.0, -88.0, 4.0), (80.0, 10.0, 120.0)]
)
def test_cone_against_brute_force(spark, ra, dec, radius):
    rows = uniform(4000) + [(9000 + i, r, d) for i, r, d in SPECIAL]
    found = {r["id"] for r in cone_search(points(spark, rows), ra, dec, radius * 3600).collect()}
    assert found == {i for i, r, d in rows if separation((r, d), (ra, dec)) <= radius * 3600}


def test_multi_cone_against_brute_force(spark):
    rows = uniform(4000)
    fields = {"a": (0.5, 1.0), "b": (3.0, 2.0), "pole": (0.0, 90.0)}
    found = {(r["field"], r["id"]) for r in multi_cone(points(spark, rows), fields, 10 * 3600.0).collect()}
    assert found == {
        (f, i) for f, at in fields.items() for i, r, d in rows if separation((r, d), at) <= 36_000
    }


def clustered(spark, n=6000):
    rng = random.Random(3)
    rows = uniform(n // 2, seed=2)
    rows += [(n + i, 40 + rng.gauss(0, 0.3), 10 + rng.gauss(0, 0.3)) for i in range(n // 2)]
    return with_pixel(points(spark, rows))


def test_partition_map_is_disjoint_complete_and_bounded(spark):
    order, threshold = 6, 100
    df = clustered(spark)
    pmap = partition_map(pixel_histogram(df, order), order, threshold)
    placed = assign_partitions(df, pmap)
    assert placed.count() == df.count()
    inside = F.expr("shiftright(_healpix_29, 2 * (29 - Norder)) = Npix")
    assert placed.where(inside).count() == df.count()
    parts = pmap.collect()
    assert sum(r["n_rows"] for r in parts) == df.count()
    assert all(r["n_rows"] <= threshold or r["Norder"] == order for r in parts)
    assert any(r["n_rows"] > threshold for r in parts)
    ranges = sorted((r["Npix"] << 2 * (29 - r["Norder"]), (r["Npix"] + 1) << 2 * (29 - r["Norder"])) for r in parts)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    # The coarsest fitting pixel was taken: no parent would fit.
    for r in parts:
        if r["Norder"] > 0:
            parent = parent_pixel(F.col(PIXEL), 29, r["Norder"] - 1)
            assert df.where(parent == r["Npix"] >> 2).count() > threshold


def plain_partition_map(counts, order, threshold):
    """Chosen (order, pixel, rows) by definition; what has no pixel fits nowhere inside another."""
    totals = {}
    for pixel, n in counts:
        for o in range(order + 1):
            key = (o, None if pixel is None else pixel >> 2 * (order - o))
            totals[key] = totals.get(key, 0) + n
    fits = {k for k, n in totals.items() if n <= threshold or k[0] == order}
    return sorted(
        ((o, p, totals[o, p]) for o, p in fits if p is None or o == 0 or (o - 1, p >> 2) not in fits),
        key=lambda r: (r[0], r[1] is not None, r[1] or 0),
    )


@pytest.mark.parametrize("order", [0, 1, 2, 5])
@pytest.mark.parametrize("threshold", [0, 7, 60, 10_000])
def test_partition_map_by_definition(spark, order, threshold):
    rng = random.Random(order * 100 + threshold)
    counts = [(rng.randrange(12 * 4**order) >> rng.choice([0, 0, 3]), rng.randrange(1, 20)) for _ in range(120)]
    counts += [(None, 4), (None, 5)]
    histogram = spark.createDataFrame(counts, "pixel long, n_rows long")
    found = [(r["Norder"], r["Npix"], r["n_rows"]) for r in partition_map(histogram, order, threshold).collect()]
    assert sorted(found, key=lambda r: (r[0], r[1] is not None, r[1] or 0)) == plain_partition_map(counts, order, threshold)


def test_partition_map_adds_levels_up_once(spark):
    histogram = spark.createDataFrame([(p, 5) for p in range(300)], "pixel long, n_rows long")
    plan = partition_map(histogram, 6, 100)._jdf.queryExecution().optimizedPlan().toString()
    # One sum over all levels, not one for the pixels and one for their parents; levels in two halves.
    assert plan.count("sum(") <= 2 and "LeftAnti" not in plan


def test_partition_map_of_nothing_and_of_one_row(spark):
    df = with_pixel(points(spark, [(1, 5.0, 5.0)]))
    assert partition_map(pixel_histogram(df.limit(0), 4), 4, 10).count() == 0
    only = partition_map(pixel_histogram(df, 4), 4, 10).collect()
    assert [(r["Norder"], r["n_rows"]) for r in only] == [(0, 1)]


def test_partitions_too_many_to_broadcast(spark, monkeypatch):
    df = clustered(spark)
    pmap = partition_map(pixel_histogram(df, 6), 6, 100)
    usual = assign_partitions(df, pmap).collect()
    monkeypatch.setattr("skyweave.operators.partitioning.fits_broadcast", lambda frame: False)
    assert sorted(assign_partitions(df, pmap).collect()) == sorted(usual)


def test_density_map_totals(spark):
    df = clustered(spark)
    maps = density_map(pixel_histogram(df, 6), 6, (2, 4, 6)).groupBy("map_order").agg(F.sum("n_rows").alias("n"))
    assert {r["map_order"]: r["n"] for r in maps.collect()} == dict.fromkeys((2, 4, 6), df.count())


def test_no_partition_of_a_cone_is_missed(spark):
    order = 5
    df = clustered(spark)
    pmap = partition_map(pixel_histogram(df, order), order, 50)
    placed = assign_partitions(df, pmap).cache()
    for ra, dec, radius in [(40.0, 10.0, 0.5), (0.0, 0.0, 5.0), (120.0, 89.0, 3.0)]:
        near = {(r["Norder"], r["Npix"]) for r in partitions_in_cone(pmap, ra, dec, radius * 3600).collect()}
        hits = cone_search(placed, ra, dec, radius * 3600).select("Norder", "Npix").distinct().collect()
        assert {tuple(r) for r in hits} <= near
        assert len(near) < pmap.count()


# ------------------------------------------------------------------------------------ cross-match


def brute_match(left, right, radius, n):
    pairs = set()
    for i, r, d in left:
        near = sorted((separation((r, d), (r2, d2)), j) for j, r2, d2 in right)
        pairs |= {(i, j) for s, j in [p for p in near if p[0] <= radius][:n]}
    return pairs


def match(spark, left, right, radius, n, **kwargs):
    found = crossmatch(
        points(spark, left), points(spark, right), left_id="id", right_id="id",
        radius_arcsec=radius, n_neighbors=n, suffix="_s", **kwargs,
    ).collect()
    assert len({(r["id"], r["id_s"]) for r in found}) == len(found)
    at = {i: (r, d) for i, r, d in left}
    there = {i: (r, d) for i, r, d in right}
    for r in found:
        assert r["_dist_arcsec"] == pytest.approx(separation(at[r["id"]], there[r["id_s"]]), rel=1e-6, abs=1e-7)
    return {(r["id"], r["id_s"]) for r in found}


@pytest.mark.parametrize("radius,n", [(3600.0, 50), (7200.0, 2), (30_000.0, 3)])
def test_crossmatch_against_brute_force(spark, radius, n):
    left = uniform(300, seed=5) + [(1000, 0.0, 89.9), (1001, 359.99, 0.0), (1002, 180.0, -89.9)]
    right = uniform(700, seed=6) + [(5000, 180.0, 89.95), (5001, 0.01, 0.0), (5002, 0.0, -89.95)]
    assert match(spark, left, right, radius, n) == brute_match(left, right, radius, n)


def test_crossmatch_in_a_crowded_cell(spark):
    """Dense cells, copies at one position, and few rows apart from the crowd: all exact."""
    rng = random.Random(8)

    def near(n, spread, start):
        return [(start + i, 40 + rng.gauss(0, spread) / 3600, 10 + rng.gauss(0, spread) / 3600) for i in range(n)]

    left = near(60, 0.4, 0) + [(500 + i, 40.0, 10.0) for i in range(20)] + uniform(50, seed=9)[10:]
    left = [(i, r, d) for i, (_, r, d) in enumerate(left)]
    right = near(250, 0.3, 0) + [(3000 + i, 40.0, 10.0) for i in range(80)] + near(10, 3.0, 9000)
    for n in (3, 20):
        assert match(spark, left, right, 1.0, n, hot_cell_rows=20) == brute_match(left, right, 1.0, n)


def test_crowded_and_usual_cells_agree_on_repeated_rows(spark):
    """Equal right rows are several neighbours, equal left rows have theirs each, in a clump finer than the first radius."""
    rng = random.Random(4)
    clump = [(i, 50 + rng.gauss(0, 1e-6), 10 + rng.gauss(0, 1e-6)) for i in range(60)]
    right = spark.createDataFrame([*clump, *clump[:5], *clump[:5], (99, 50.0001, 10.0)], "objid long, ra double, dec double")
    left = spark.createDataFrame([(1, 50.0, 10.0), (1, 50.0, 10.0), (1, 50.0002, 10.0), (2, 50.0, 10.0)], "id long, ra double, dec double")

    def matched(hot):
        pairs = crossmatch(left, right, left_id="id", right_id="objid", radius_arcsec=1.0, n_neighbors=7, suffix="_s", hot_cell_rows=hot)
        return sorted((r["id"], r["objid_s"], round(r["_dist_arcsec"], 6)) for r in pairs.collect())

    usual = matched(10**6)
    assert matched(3) == usual
    assert len(usual) == 4 * 7


def test_clump_probed_from_outside(spark):
    """A dense clump within the radius of far probes: candidates follow the neighbours wanted, not the clump."""
    rng = random.Random(12)
    clump = [(i, 50 + rng.gauss(0, 2e-6), 10 + rng.gauss(0, 2e-6)) for i in range(3000)] + [(5000 + i, 50.0, 10.0) for i in range(40)]
    probes = [(i, 50 + 2e-4 * math.cos(i), 10 + 2e-4 * math.sin(i)) for i in range(12)] + [(90, 50.0, 10.0), (91, 50.1, 10.0)]
    for n in (1, 6):
        assert match(spark, probes, clump, 1.0, n, hot_cell_rows=50) == brute_match(probes, clump, 1.0, n)
    left = with_unit_vector(points(spark, probes), "ra", "dec", ("_lx", "_ly", "_lz"))
    right = with_unit_vector(points(spark, clump), "ra", "dec", ("_rx", "_ry", "_rz"))
    right = right.select(F.col("id").alias("_rid"), F.col("id").alias("_rno"), "_rx", "_ry", "_rz")
    pairs = tree_candidates(left.select("_lx", "_ly", "_lz"), right, chord(1.0), 6)
    assert pairs.count() < 150 * len(probes)  # of 3,040 each


def test_cones_of_no_and_of_any_width(spark):
    sky = spark.createDataFrame([(1, 10.0, 20.0), (2, 190.0, -20.0), (3, 11.0, 20.0)], "id long, ra double, dec double")
    found = lambda radius: sorted(r["id"] for r in multi_cone(sky, {"f": (10.0, 20.0)}, radius).collect())
    assert found(0.0) == [1]
    assert found(200.0 * 3600) == [1, 2, 3]
    many = {f"f{i}": ((i * 37) % 360, (i * 1.7) % 160 - 80) for i in range(90)}
    bands = declination_bands([dec for _, dec in many.values()], 60.0)
    assert len(bands) <= 64
    assert all(any(low <= dec <= high for low, high in bands) for _, dec in many.values())
    plan = multi_cone(sky, many, 60.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "dec" in plan and ">=" in plan


def test_crossmatch_ignores_missing_positions(spark):
    left = [(1, 10.0, 10.0), (2, None, 1.0), (3, float("nan"), 1.0)]
    right = [(7, 10.0, 10.0), (8, 1.0, None), (9, 1.0, float("nan"))]
    found = crossmatch(
        points(spark, left), points(spark, right), left_id="id", right_id="id",
        radius_arcsec=1.0, n_neighbors=5, suffix="_s",
    ).collect()
    assert [(r["id"], r["id_s"], r["_dist_arcsec"]) for r in found] == [(1, 7, 0.0)]


# ---------------------------------------------------------------------------------------- margins


def pixel_of(spark, positions, order):
    df = spark.createDataFrame(positions, "k long, ra double, dec double")
    return {r["k"]: r["p"] for r in with_pixel(df, out="p", order=order).select("k", "p").collect()}


def test_margin_misses_nothing_within_the_threshold(spark):
    """Against dense samples of each row's disc, on an adaptive map, with rows at pixel corners."""
    order = 5
    threshold = 0.03 * pixel_width_arcsec(order)
    rng = random.Random(11)
    rows = uniform(3000, seed=12) + [(9000 + i, 40 + rng.gauss(0, 3), 10 + rng.gauss(0, 3)) for i in range(1500)]
    # Rows close to corners of pixels.
    corners = spark.range(12 * 4**3).select((F.col("id") * 16).alias("p"), F.lit(order).alias("o"))
    vectors = with_face_vector(with_face_position(corners, "p", "o"), "_face", F.col("_ix"), F.col("_iy"), F.lit(1 << order), VECTOR)
    ra, dec = ra_dec_of(*[F.col(v) for v in VECTOR])
    for i, r in enumerate(vectors.select(ra.alias("ra"), dec.alias("dec")).collect()):
        if abs(r["dec"]) < 85:
            jitter = threshold / 3600 * 0.7
            rows.append((20_000 + i, r["ra"] + rng.uniform(-jitter, jitter), r["dec"] + rng.uniform(-jitter, jitter)))
    df = with_pixel(points(spark, rows))
    pmap = partition_map(pixel_histogram(df, order), order, 40)
    placed = assign_partitions(df, pmap)
    found = margin_rows(placed, pmap, threshold)
    assert found.columns == placed.select("id", "ra", "dec", PIXEL, "Norder", "Dir", "Npix").columns
    copies = {(r["id"], r["Norder"], r["Npix"]) for r in found.collect()}
    assert len(copies) == found.count()

    place_of = {}
    for r in pmap.collect():
        tiles = 4 ** (order - r["Norder"])
        place_of |= {p: (r["Norder"], r["Npix"]) for p in range(r["Npix"] * tiles, (r["Npix"] + 1) * tiles)}
    own = {r["id"]: (r["Norder"], r["Npix"]) for r in placed.collect()}
    sampled, keys = [], []
    for i, r, d in rows:
        for share in (0.35, 0.7, 0.999):
            for k in range(24):
                turn = 2 * math.pi * k / 24
                step = share * threshold / 3600
                sampled.append((len(keys), r + step * math.cos(turn) / math.cos(math.radians(d)), d + step * math.sin(turn)))
                keys.append((i, r, d))
    expected = set()
    for k, p in pixel_of(spark, sampled, order).items():
        i, r, d = keys[k]
        if abs(d) < 80 and separation((r, d), sampled[k][1:]) <= threshold and p in place_of and place_of[p] != own[i]:
            expected.add((i, *place_of[p]))
    assert len(expected) > 300
    assert expected <= copies
    assert len(copies) <= 1.15 * len(expected) + 50


@pytest.mark.parametrize("order,threshold", [(3, 200.0), (4, 20_000.0), (2, 60_000.0)])
def test_margin_against_dense_outlines(spark, order, threshold):
    """Partitions of several orders, margins narrower and wider than a pixel; distances to outlines of many points."""
    rows = uniform(250, seed=31) + [(9000 + i, 40 + i * 0.03, 10 + i * 0.02) for i in range(60)] + [(9900, 10.0, 90.0), (9901, 45.0, -89.99)]
    df = with_pixel(points(spark, rows))
    pmap = partition_map(pixel_histogram(df, order), order, 12)
    placed = assign_partitions(df, pmap)
    copies = [(r["id"], r["Norder"], r["Npix"]) for r in margin_rows(placed, pmap, threshold).collect()]
    assert len(copies) == len(set(copies))
    parts = [(r["Norder"], r["Npix"]) for r in pmap.collect()]
    own = {r["id"]: (r["Norder"], r["Npix"]) for r in placed.collect()}
    steps = np.linspace(0, 1, 4001)
    wanted, close = set(), set()
    vectors = {i: np.array([math.cos(math.radians(d)) * math.cos(math.radians(r)), math.cos(math.radians(d)) * math.sin(math.radians(r)), math.sin(math.radians(d))]) for i, r, d in rows}
    for o, p in parts:
        face, x, y = (int(v[0]) for v in split_pixel(np.array([p]), np.array([o])))
        n = np.full(len(steps), float(1 << o))
        faces = np.full(len(steps), face)
        outline = np.concatenate([face_vector(faces, x + a, y + b, n) for a, b in ((steps, 0), (steps, 1), (0 * steps, steps), (0 * steps + 1, steps))])
        for i, v in vectors.items():
            away = 2 * math.asin(min(1.0, math.sqrt(((outline - v) ** 2).sum(1).min()) / 2)) * 206264.80624709636
            if own[i] != (o, p) and away <= threshold * 1.001:
                close.add((i, o, p))
                if away <= threshold * 0.999:
                    wanted.add((i, o, p))
    assert len(wanted) > 5 and wanted <= set(copies) <= close


def test_margin_of_rows_in_no_partition(spark):
    df = with_pixel(points(spark, [(1, 45.0, 0.1), (2, 200.0, 0.0), (3, None, 1.0)]))
    parts = spark.createDataFrame([(0, 4)], "Norder int, Npix long")
    rows = df.withColumns({"Norder": F.lit(None).cast("int"), "Dir": F.lit(None).cast("long"), "Npix": F.lit(None).cast("long")})
    assert [(r["id"], r["Norder"], r["Npix"]) for r in margin_rows(rows, parts, 3600.0 * 30).collect()] == [(1, 0, 4)]
    assert margin_rows(rows, parts.limit(0), 10.0).count() == 0


def test_coverage_misses_nothing(spark):
    cones = [(40.0, 10.0, 3600.0), (0.0, 89.9, 7200.0), (359.99, -5.0, 100.0), (120.0, -45.0, 0.01), (200.0, 0.0, 3600.0 * 200)]
    rng = random.Random(7)
    for ra, dec, radius in cones:
        ranges = coverage([(ra, dec, radius)])
        assert len(ranges) <= 64 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        near = [(i, (ra + rng.uniform(-1, 1) * radius / 3600 / max(0.01, math.cos(math.radians(dec)))) % 360, max(-90.0, min(90.0, dec + rng.uniform(-1, 1) * radius / 3600))) for i in range(300)]
        placed = with_pixel(points(spark, near)).where(F.lit(True))
        hits = cone_search(placed, ra, dec, radius)
        assert hits.count() == rows_in_coverage(hits, ranges).count() > 0
    pixels = 12 << 58
    one = coverage([cones[0]])
    assert sum(b - a for a, b in one) / pixels < 20 * math.radians(1.0) ** 2 / 4
    both = coverage([cones[0], cones[2]], most=2)
    assert len(both) == 2


def test_equal_rows_have_separate_margin_copies(spark):
    df = with_pixel(points(spark, [(1, 45.0001, 0.0)] * 3 + [(2, 44.9999, 0.0)]))
    order = 4
    pmap = partition_map(pixel_histogram(df, order), order, 0)
    placed = assign_partitions(df, pmap)
    assert placed.select("Npix").distinct().count() == 2
    assert margin_rows(placed, pmap, 5.0).where("id = 1").count() == 3


@pytest.mark.parametrize("order", [0, 1, 6, 17])
def test_outlines_are_measured_only_where_a_first_look_cannot_tell(monkeypatch, order):
    generator = np.random.default_rng(order)
    pixel = np.concatenate([generator.integers(0, 12 << (2 * order), 3000), np.repeat([0, (1 << (2 * order)) - 1], 500)])
    orders, n = np.full(len(pixel), order), np.full(len(pixel), float(1 << order))
    face, x, y = split_pixel(pixel, orders)
    vector = face_vector(face, x + 0.5, y + 0.5, n) + generator.normal(size=(len(pixel), 3)) / (1 << order)
    vector /= np.linalg.norm(vector, axis=1)[:, None]
    exact, measured = edge_distance(vector, pixel, orders), []
    monkeypatch.setattr(pixels, "edge_distance", lambda *rows: measured.append(len(rows[1])) or edge_distance(*rows))
    for share in (0.02, 0.3, 1.0):
        measured.clear()
        assert (near_edge(vector, pixel, orders, share / (1 << order)) == (exact <= share / (1 << order))).all()
        assert sum(measured) < len(pixel) / 4


def test_strip_of_a_margin_is_dealt_over_all_tasks(spark, monkeypatch):
    from skyweave.operators import spatial
    from skyweave.runtime import materialize

    sizes = []

    def watched(df):
        if "_strip" in df.columns:
            sizes.extend(row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect())
        return materialize(df)

    monkeypatch.setattr(spatial, "materialize", watched)
    rows = spark.range(0, 4000, 1, 1).select("id", (45.0 + F.col("id") * 1e-6).alias("ra"), F.lit(0.0).alias("dec"))
    placed = rows.select("*", F.lit(0).alias("Norder"), F.lit(0).cast("long").alias("Dir"), F.lit(4).cast("long").alias("Npix"))
    margin_rows(placed, spark.createDataFrame([(0, p) for p in range(12)], "Norder int, Npix long"), 3600.0 * 50).count()
    assert len(sizes) == 4 and max(sizes) < 2000


def test_deeper_levels_of_a_tree_read_rows_of_open_cells_only(spark, monkeypatch):
    from skyweave.operators import spatial
    from skyweave.runtime import materialize

    kept = []

    def watched(df):
        df = materialize(df)
        if df.columns == ["_rid", "_rno", *spatial._RIGHT]:
            kept.append(df.count())
        return df

    monkeypatch.setattr(spatial, "materialize", watched)
    def clumps(step, clump):  # 500 rows, apart but for a clump
        rows = spark.range(500).select("id", (F.col("id") * step % 3.0).alias("ra"), (F.col("id") % 31 * 0.09).alias("dec"))
        close = spark.range(500, 600).select("id", (1.0 + F.col("id") * 1e-9).alias("ra"), (F.lit(clump) + F.col("id") % 7 * 1e-9).alias("dec"))
        return rows.unionByName(close)

    left, right = clumps(0.013, 1.0), clumps(0.017, 1.0)
    options = dict(left_id="id", right_id="id", radius_arcsec=3600.0, n_neighbors=3, suffix="_r")
    found = sorted(map(tuple, crossmatch(left, right, hot_cell_rows=50, **options).collect()))
    assert len(kept) > 4 and max(kept[1:]) <= 600 and min(kept) <= 130
    usual = sorted(map(tuple, crossmatch(left, right, hot_cell_rows=10_000, **options).collect()))
    assert found == usual


def test_copies_for_cells_are_not_broadcast(spark, tmp_path, capsys):
    from skyweave.operators.spatial import _LEFT, _RIGHT, _pairs

    spark.range(300).select("id", *[(F.col("id") * 0.001).alias(v) for v in (*_LEFT, *_RIGHT)]).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    pairs = _pairs(rows.select("id", *_LEFT), rows.select(F.col("id").alias("_rid"), *_RIGHT), 0.002, 0.01)
    pairs.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert pairs.where("id = _rid").count() == 300


def test_crowded_cells_write_in_proportion_to_the_neighbours_wanted(spark, monkeypatch):
    """Many spots among many rows: the tables between the steps hold cells, spots and their n nearest, not all pairs in reach."""
    from skyweave.operators import spatial
    from skyweave.runtime import materialize

    written = []

    def watched(df):
        df = materialize(df)
        written.append(df.count())
        return df

    monkeypatch.setattr(spatial, "materialize", watched)
    rng = random.Random(21)
    left, right = ([(i, rng.uniform(20, 22), rng.uniform(-1, 1)) for i in range(n)] for n in (3000, 600))
    assert match(spark, left, right, 7200.0, 3, hot_cell_rows=50) == brute_match(left, right, 7200.0, 3)
    assert max(written) <= 6 * len(left)  # pairs of cells; pairs of spots within reach of the last cells were 40 times as many
