"""Sky joins: cone search, cross-match and margins.

Points within a radius of each other are found by an equi-join on cells of a cubic grid over
unit vectors. One side takes its own cell; the other is copied to every cell its search ball
touches. A true pair meets in exactly one cell, so nothing needs de-duplication, and neither the
poles nor the wrap of right ascension are special.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.functions.pixels import REACH, coverage, near_edge
from skyweave.functions.sky import (
    ARCSEC_PER_RADIAN,
    FINEST_ORDER,
    PIXEL,
    chord,
    directory_of,
    pixel_reach,
    separation_arcsec,
    squared_chord,
    unit_vector,
    with_face_position,
    with_face_vector,
    with_pixel,
    with_unit_vector,
)
from skyweave.runtime import broadcast_checked, materialize

CELL = ("_cx", "_cy", "_cz")
# The cell of a spot, beside cells of the rows it is matched with.
HOME = ("_hx", "_hy", "_hz")
_LEFT = ("_lx", "_ly", "_lz")
_RIGHT = ("_rx", "_ry", "_rz")


def _slack(radius: float) -> float:
    """A radius widened by more than the rounding of cell arithmetic."""
    return radius * (1.0 + 1e-9) + 1e-15


def with_cell(df: DataFrame, vector: tuple[str, str, str], size: float) -> DataFrame:
    return df.withColumns({c: F.floor(F.col(v) / size) for c, v in zip(CELL, vector)})


def with_touched_cells(
    df: DataFrame, vector: tuple[str, str, str], size: float, radius: float
) -> DataFrame:
    """One copy of each row per cell that a box of half-width ``radius`` round it touches."""
    reach = _slack(radius)
    for cell, axis in zip(CELL, vector):
        low, high = F.floor((F.col(axis) - reach) / size), F.floor((F.col(axis) + reach) / size)
        df = df.withColumn(cell, F.explode(F.sequence(low, high)))
    return df


# ---------------------------------------------------------------------------------------------
# cones


def cone_prefilter(ra: str, dec: str, ra0: float, dec0: float, radius_arcsec: float) -> Column:
    """Right ascension and declination bounds round a cone, in a form the parquet scan can use."""
    radius = radius_arcsec / 3600.0 + 1e-9
    bounds = F.col(dec).between(dec0 - radius, dec0 + radius)
    if abs(dec0) + radius >= 90.0:
        return bounds
    half = math.degrees(
        math.asin(min(1.0, math.sin(math.radians(radius)) / math.cos(math.radians(dec0))))
    )
    half += 1e-9
    ra0 = ra0 % 360.0
    low, high = ra0 - half, ra0 + half
    column = F.col(ra)
    # Positions outside [0, 360) may be stored; only those inside can be bounded.
    odd = (column < 0) | (column >= 360)
    if low < 0:
        return bounds & ((column >= low + 360.0) | (column <= high) | odd)
    if high >= 360:
        return bounds & ((column >= low) | (column <= high - 360.0) | odd)
    return bounds & (column.between(low, high) | odd)


def cone_search(
    df: DataFrame, ra0: float, dec0: float, radius_arcsec: float, ra: str = "ra", dec: str = "dec"
) -> DataFrame:
    """Rows within a radius of a position."""
    box = df.where(cone_prefilter(ra, dec, ra0, dec0, radius_arcsec))
    vectors = with_unit_vector(box, ra, dec, _LEFT)
    centre = unit_vector_of(ra0, dec0)
    squared = sum((F.col(a) - c) * (F.col(a) - c) for a, c in zip(_LEFT, centre))
    # Half a turn or more covers the sphere.
    limit = chord(min(radius_arcsec, 180.0 * 3600.0))
    return vectors.where(squared <= limit * limit).drop(*_LEFT)


def unit_vector_of(ra: float, dec: float) -> tuple[float, float, float]:
    ra, dec = math.radians(ra), math.radians(dec)
    return math.cos(dec) * math.cos(ra), math.cos(dec) * math.sin(ra), math.sin(dec)


def partitions_in_cone(
    partitions: DataFrame, ra0: float, dec0: float, radius_arcsec: float
) -> DataFrame:
    """Partitions whose pixel may hold points of the cone; never misses one."""
    spots = with_face_position(partitions, "Npix", "Norder")
    n = F.expr("shiftleft(1L, cast(Norder as int))")
    spots = with_face_vector(spots, "_face", F.col("_ix") + 0.5, F.col("_iy") + 0.5, n, _LEFT)
    centre = unit_vector_of(ra0, dec0)
    squared = sum((F.col(a) - c) * (F.col(a) - c) for a, c in zip(_LEFT, centre))
    angle = F.radians(separation_arcsec(squared) / 3600.0)
    near = angle <= radius_arcsec / ARCSEC_PER_RADIAN + pixel_reach(n)
    return spots.where(near).select(partitions.columns)


def declination_bands(centres: Sequence[float], radius_arcsec: float, most: int = 64) -> list[tuple[float, float]]:
    """At most ``most`` intervals of declination that hold all cones: close ones are joined."""
    radius = radius_arcsec / 3600.0 + 1e-9
    bands: list[list[float]] = []
    for centre in sorted(centres):
        if bands and centre - radius <= bands[-1][1]:
            bands[-1][1] = centre + radius
        else:
            bands.append([centre - radius, centre + radius])
    widest = sorted((b[0] - a[1] for a, b in zip(bands, bands[1:])), reverse=True)[: most - 1]
    joined: list[list[float]] = []
    for low, high in bands:
        if joined and not (widest and low - joined[-1][1] >= widest[-1]):
            joined[-1][1] = high
        else:
            joined.append([low, high])
    return [(low, high) for low, high in joined]


def covered(ranges: Sequence[tuple[int, int]], low: Column, high: Column) -> Column:
    """Whether finest-order pixels [low, high) meet any of the sorted ranges, as bounds the parquet scan can use."""
    meets = F.lit(False)
    for first, end in ranges:
        meets = meets | ((low < F.lit(end)) & (high > F.lit(first)))
    return meets


def rows_in_coverage(df: DataFrame, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of a catalog whose finest-order pixel lies in the ranges.

    Files are sorted by that pixel, so the bounds let the scan skip row groups.
    """
    inside = F.lit(False)
    for first, end in ranges:
        inside = inside | F.col(PIXEL).between(F.lit(first), F.lit(end - 1))
    return df.where(inside)


def partitions_in_coverage(partitions: DataFrame, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """Partitions (``Norder, Npix``) that overlap the ranges."""
    shift = f"(2 * ({FINEST_ORDER} - cast(Norder as int)))"
    low, high = F.expr(f"shiftleft(Npix, {shift})"), F.expr(f"shiftleft(Npix + 1, {shift})")
    return partitions.where(covered(ranges, low, high))


def multi_cone(
    df: DataFrame,
    fields: Mapping[str, tuple[float, float]],
    radius_arcsec: float,
    ra: str = "ra",
    dec: str = "dec",
) -> DataFrame:
    """Rows of several named cones in one pass, with the name as ``field``.

    A row in two cones comes out twice. The cones are copied to grid cells, at most 27 each,
    and equi-joined, so the work per row does not grow with the number of cones.
    """
    spark = df.sparkSession
    radius = chord(min(radius_arcsec, 180.0 * 3600.0))
    size = max(2.0 * radius, 1e-9)
    rows = [(name, *unit_vector_of(*position)) for name, position in fields.items()]
    centres = spark.createDataFrame(rows, "field string, _rx double, _ry double, _rz double")
    cells = broadcast_checked(with_touched_cells(centres, _RIGHT, size, radius))
    boxed = F.lit(False)
    for low, high in declination_bands([position[1] for position in fields.values()], radius_arcsec):
        boxed = boxed | F.col(dec).between(low, high)
    points = with_cell(with_unit_vector(df.where(boxed), ra, dec, _LEFT), _LEFT, size)
    pairs = points.join(cells, list(CELL))
    return pairs.where(squared_chord(_LEFT, _RIGHT) <= radius * radius).select("field", *df.columns)


# ---------------------------------------------------------------------------------------------
# cross-match

# Candidates per cell beyond which a cell is matched through a tree of ever smaller cells.
HOT_CELL_ROWS = 256
# Rows round a cell of spots that are compared one by one; at least twice the neighbours wanted.
LEAF_ROWS = 64
# Spots of a cell that are compared together, rows of a group of such cells, and distances in memory at once.
CHUNK_SPOTS, GROUP_ROWS, COMPARED_AT_ONCE = 4_096, 200_000, 1 << 20
# Cells are halved no further than the steps of a coordinate near 1.
_SMALLEST_CELL = 2.0**-52


def _nearest(pairs: DataFrame, on: list[str], n: int) -> DataFrame:
    """The ``n`` nearest per left row, ties by right id; Spark cuts each task's rows to n first."""
    by_distance = Window.partitionBy(*on).orderBy("_d2", "_rid", "_rno")
    return pairs.withColumn("_rank", F.row_number().over(by_distance)).where(F.col("_rank") <= n).drop("_rank")


def _pairs(left: DataFrame, right: DataFrame, radius: float, size: float) -> DataFrame:
    return _cell_pairs(with_cell(left, _LEFT, size), with_touched_cells(right, _RIGHT, size, radius), radius)


def _cell_pairs(left: DataFrame, touched: DataFrame, radius: float) -> DataFrame:
    """Pairs of one cell within the radius, by shuffle.

    Spark takes the copies for as few as the rows they are made from, and would send them all through
    the driver to every task; the tasks would also be as few as the files of the left.
    """
    joined = left.join(touched.hint("merge"), list(CELL))
    return joined.withColumn("_d2", squared_chord(_LEFT, _RIGHT)).where(F.col("_d2") <= radius * radius)


def _box_distances(size: float) -> tuple[Column, Column]:
    """Squared distances that points of a row's two cells, ``HOME`` and ``CELL``, have at least and at most."""
    near, far = F.lit(0.0), F.lit(0.0)
    for home, cell in zip(HOME, CELL):
        apart = F.abs(F.col(cell) - F.col(home))
        gap, reach = F.greatest(apart - 1, F.lit(0)) * size, (apart + 1) * size
        near, far = near + gap * gap, far + reach * reach
    return near * (1.0 - 1e-12), far * (1.0 + 1e-12)


def _with_home(spots: DataFrame, size: float) -> DataFrame:
    return spots.withColumns({h: F.floor(F.col(v) / size) for h, v in zip(HOME, _LEFT)})


def _compared(radius: float, n: int):
    """For groups of spots and candidates: the pairs of one piece within the radius, up to the n-th distance of each spot."""

    def compare(spots: pa.Table, rows: pa.Table) -> pa.Table:
        homes = [t["_home"].to_numpy() for t in (spots, rows)]
        chunks = [t["_chunk"].to_numpy() for t in (spots, rows)]
        _, number = np.unique(np.concatenate(homes), return_inverse=True)
        pieces = number * (1 + max((int(c.max()) for c in chunks if len(c)), default=0)) + np.concatenate(chunks)
        own, other = pieces[: len(spots)], pieces[len(spots) :]
        by_own, by_other = np.argsort(own, kind="stable"), np.argsort(other, kind="stable")
        left = np.stack([spots[v].to_numpy() for v in _LEFT])[:, by_own]
        right = np.stack([rows[v].to_numpy() for v in _RIGHT])[:, by_other]
        own, other = own[by_own], other[by_other]
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for piece in np.unique(own):
            first, last = np.searchsorted(own, [piece, piece + 1])
            low, high = np.searchsorted(other, [piece, piece + 1])
            step = max(1, COMPARED_AT_ONCE // max(1, high - low))
            for at in range(first, last, step) if high > low else ():
                x, y, z = (left[k, at : min(at + step, last), None] - right[k, None, low:high] for k in range(3))
                squared = x * x + y * y + z * z
                within = squared <= radius * radius
                if high - low > n:
                    within &= squared <= np.partition(squared, n - 1, axis=1)[:, n - 1 : n]
                i, j = np.nonzero(within)
                found.append((by_own[at + i], by_other[low + j], squared[i, j]))
        i, j, squared = (np.concatenate(part) for part in zip(*found))
        i, j = pa.array(i), pa.array(j)
        columns = [spots[v].take(i) for v in _LEFT] + [rows[c].take(j) for c in ("_rid", "_rno")]
        return pa.Table.from_arrays([*columns, pa.array(squared)], names=[*_LEFT, "_rid", "_rno", "_d2"])

    return compare


def _leaf_pairs(spots: DataFrame, kept: DataFrame, right: DataFrame, radius: float, n: int) -> DataFrame:
    """Spots beside the rows of the cells kept for their home, compared in Arrow batches of whole pieces of homes.

    ``kept`` has ``HOME, CELL, _spots``. A home of many spots is cut into chunks, so no group of a task
    is larger than others; of each spot only pairs up to its n-th distance come back, ties included.
    """
    chunks = F.ceil(F.col("_spots") / CHUNK_SPOTS).cast("int")
    homes = kept.groupBy(*HOME).agg(F.first(chunks).alias("_chunks"), F.sum("_rows").alias("_near"))
    homes = materialize(homes.withColumn("_home", F.monotonically_increasing_id()))
    weight = homes.agg(F.coalesce(F.sum(F.col("_chunks") * (F.col("_near") + CHUNK_SPOTS // 64)), F.lit(0))).first()[0]
    bucket = F.pmod(F.xxhash64("_home", "_chunk"), F.lit(1 + weight // GROUP_ROWS)).alias("_group")
    homes = homes.select(*HOME, "_home", "_chunks")
    placed = spots.join(homes, list(HOME)).withColumn("_chunk", F.pmod(F.xxhash64(*_LEFT), "_chunks"))
    placed = placed.select("_home", "_chunk", *_LEFT, bucket)
    rows = kept.join(homes, list(HOME)).select("_home", "_chunks", *CELL).join(right.hint("merge"), list(CELL))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks").cast("long") - 1)).alias("_chunk")
    rows = rows.select("_home", copies, "_rid", "_rno", *_RIGHT).select("*", bucket)
    schema = T.StructType(
        [
            *[T.StructField(v, T.DoubleType()) for v in _LEFT],
            T.StructField("_rid", right.schema["_rid"].dataType),
            T.StructField("_rno", T.LongType()),
            T.StructField("_d2", T.DoubleType()),
        ]
    )
    return placed.groupBy("_group").cogroup(rows.groupBy("_group")).applyInArrow(_compared(radius, n), schema)


def tree_candidates(spots: DataFrame, right: DataFrame, radius: float, n: int) -> DataFrame:
    """Pairs of spots and right rows that hold the ``n`` nearest of every spot within the radius.

    Cells of both sides are halved level by level, where spots and right rows are. The home of a spot
    follows the cells that may hold one of its n nearest: the rows of cells whose farthest points are
    closest, n of them together, bound the distance of the n-th, and cells wholly beyond the least bound so
    far are dropped. Where few rows are left round a home, its spots are compared with them. So a spot meets
    rows in proportion to n, however many lie within the radius, and what is written are pairs of cells, not
    of spots. The sides of cells are powers of two, so the place of a cell is exact.
    """
    near_rows = max(LEAF_ROWS, 2 * n)
    size = 2.0 ** math.ceil(math.log2(2.0 * _slack(radius)))
    limit = _slack(radius) ** 2
    beside = F.explode(F.array(*[F.lit(k).cast("long") for k in (-1, 0, 1)]))
    open_cells = _with_home(spots, size).select(*HOME).distinct().withColumn("_bound", F.lit(limit))
    for cell, home in zip(CELL, HOME):
        open_cells = open_cells.select("*", beside.alias("_by")).withColumn(cell, F.col(home) + F.col("_by")).drop("_by")
    found = None
    while True:
        near, far = _box_distances(size)
        cells = with_cell(right, _RIGHT, size).groupBy(*CELL).agg(F.count(F.lit(1)).alias("_rows"))
        met = open_cells.withColumns({"_near": near, "_far": far}).where(F.col("_near") <= F.col("_bound"))
        met = met.join(cells, list(CELL))
        whole = Window.partitionBy(*HOME)
        closest = whole.orderBy("_far", *CELL).rowsBetween(Window.unboundedPreceding, 0)
        enough = met.withColumn("_sum", F.sum("_rows").over(closest))
        least = F.min(F.when(F.col("_sum") >= n, F.col("_far"))).over(whole)
        kept = enough.withColumn("_bound", F.least("_bound", least)).where(F.col("_near") <= F.col("_bound"))
        kept = kept.withColumn("_total", F.sum("_rows").over(whole)).select(*HOME, *CELL, "_rows", "_bound", "_total")
        placed = _with_home(spots, size)
        counted = placed.groupBy(*HOME).agg(F.count(F.lit(1)).alias("_spots"))
        kept = materialize(kept.join(counted, list(HOME)))
        is_leaf = (F.col("_total") <= near_rows) | F.lit(size <= _SMALLEST_CELL)
        leaves, rest = kept.where(is_leaf), kept.where(~is_leaf)
        some = kept.agg(F.count_if(is_leaf).alias("leaves"), F.count_if(~is_leaf).alias("rest")).first()
        if some["leaves"] or not some["rest"] and found is None:
            # Written level by level: one plan of all levels holds the broadcasts of all of them at once.
            pairs = materialize(_leaf_pairs(placed, leaves, with_cell(right, _RIGHT, size), radius, n))
            found = pairs if found is None else found.unionByName(pairs)
        if not some["rest"]:
            return found
        # Deeper levels see the spots and the rows of open cells only.
        opened = rest.select(*CELL).distinct()
        right = materialize(with_cell(right, _RIGHT, size).join(opened, list(CELL), "left_semi").select("_rid", "_rno", *_RIGHT))
        spots = materialize(placed.join(rest.select(*HOME).distinct(), list(HOME), "left_semi").select(*spots.columns))
        size /= 2.0
        parents = {f"_of{h}": F.shiftright(F.col(h), 1) for h in HOME}
        inner = _with_home(spots, size).select(*HOME).distinct().withColumns(parents)
        above = rest.select(*[F.col(h).alias(f"_of{h}") for h in HOME], *CELL, "_bound")
        halves = above.join(inner, list(parents)).drop(*parents)
        for c in CELL:
            halves = halves.withColumn(c, F.explode(F.array(F.col(c) * 2, F.col(c) * 2 + 1)))
        open_cells = halves


def _match_hot(left: DataFrame, right: DataFrame, radius: float, n: int) -> DataFrame:
    """Exact n nearest where cells are crowded.

    Equal positions have equal neighbours, so left rows are matched once per position; of right
    rows at one position only the n smallest ids can be among the n nearest. The candidates come from
    a tree of cells pruned by the n-th distance.
    """
    position = list(_LEFT)
    spots = materialize(left.select(*position).distinct())
    copies = Window.partitionBy(*_RIGHT).orderBy("_rid", "_rno")
    right = materialize(
        right.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= n).drop("_copy")
    )
    done = _nearest(tree_candidates(spots, right, radius, n), position, n).select(*position, "_rid", "_d2")
    return left.join(done, position).select("_lid", "_rid", "_d2")


def crossmatch(
    left: DataFrame,
    right: DataFrame,
    *,
    left_id: str,
    right_id: str,
    radius_arcsec: float,
    n_neighbors: int,
    suffix: str,
    left_position: tuple[str, str] = ("ra", "dec"),
    right_position: tuple[str, str] = ("ra", "dec"),
    hot_cell_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """For each left row its at most ``n_neighbors`` nearest right rows within the radius.

    Gives ``left_id, {right_id}{suffix}, _dist_arcsec``; left rows without neighbours are absent.
    Repeated rows are rows of their own on either side: each left row has its own neighbours, equal
    right rows are several of them. Positions that are null or NaN match nothing.
    """
    radius = chord(radius_arcsec)
    size = max(4.0 * radius, 1e-5)

    def points(df: DataFrame, row_id: str, position: tuple[str, str], out: str, number: str, vector) -> DataFrame:
        ra, dec = position
        known = ~(F.isnan(F.col(ra).cast("double")) | F.isnan(F.col(dec).cast("double")))
        valid = df.where(known).select(F.col(row_id).alias(out), ra, dec)
        numbered = valid.withColumn(number, F.monotonically_increasing_id())
        return with_unit_vector(numbered, ra, dec, vector).select(out, number, *vector)

    lefts = points(left, left_id, left_position, "_lid", "_lno", _LEFT)
    rights = points(right, right_id, right_position, "_rid", "_rno", _RIGHT)

    touched = with_touched_cells(rights, _RIGHT, size, radius)
    crowded = touched.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_cell_rows)
    crowded = materialize(crowded.drop("_n"))
    if crowded.isEmpty():
        matched = _nearest(_pairs(lefts, rights, radius, size), ["_lno"], n_neighbors)
    else:
        hot = broadcast_checked(crowded)
        celled = with_cell(lefts, _LEFT, size)
        cold_left = celled.join(hot, list(CELL), "left_anti")
        hot_left = celled.join(hot, list(CELL), "left_semi").drop(*CELL)
        # A right row goes to the hot side once, however many hot cells it touches.
        hot_right = touched.join(hot, list(CELL), "left_semi").drop(*CELL).dropDuplicates(["_rno"])
        cold_right = touched.join(hot, list(CELL), "left_anti")
        cold = _nearest(_cell_pairs(cold_left, cold_right, radius), ["_lno"], n_neighbors)
        matched = cold.select("_lid", "_rid", "_d2").unionByName(
            _match_hot(hot_left, hot_right, radius, n_neighbors)
        )
    return matched.select(
        F.col("_lid").alias(left_id),
        F.col("_rid").alias(f"{right_id}{suffix}"),
        separation_arcsec(F.col("_d2")).alias("_dist_arcsec"),
    )


def attach_matched_columns(
    pairs: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str, suffix: str
) -> DataFrame:
    """Matched pairs with all columns of both sides; those of the right carry the suffix."""
    renamed = right.withColumnsRenamed({c: f"{c}{suffix}" for c in right.columns})
    return pairs.join(left, left_id).join(renamed, f"{right_id}{suffix}").select(
        *left.columns, *renamed.columns, "_dist_arcsec"
    )


# ---------------------------------------------------------------------------------------------
# margins

# Steepest change of the position on a face, in faces per radian, over the whole sphere.
_FACE_SLOPE = 1.46


def _near_edges(x: Column, y: Column, z: Column, pixel: Column, order: Column, angle: float) -> Column:
    """Whether the outline of a pixel lies within an angle of a unit vector, in Arrow batches."""

    @F.pandas_udf("boolean")
    def measure(x: pd.Series, y: pd.Series, z: pd.Series, pixel: pd.Series, order: pd.Series) -> pd.Series:
        vectors = np.stack([x.to_numpy(), y.to_numpy(), z.to_numpy()], -1)
        pixels, orders, out = pixel.to_numpy(), order.to_numpy(), np.empty(len(x), bool)
        for at in range(0, len(out), 4096):
            part = slice(at, at + 4096)
            out[part] = near_edge(vectors[part], pixels[part], orders[part], angle)
        return pd.Series(out)

    return measure(x, y, z, pixel, order)


def _near_partitions(spots: DataFrame, partitions: DataFrame, angle: float) -> DataFrame | None:
    """``spots`` beside every partition whose pixel may lie within an angle of them; never misses one. None without partitions.

    For each order in use, centres are copied to the grid cells that a box of the angle and the reach
    of a pixel touches, and spots look up their own cell, so any angle costs one equi-join.
    """
    partitions = partitions.select("Norder", "Npix")
    orders = sorted(row["Norder"] for row in partitions.select("Norder").distinct().collect())
    radius = {o: chord(min(angle + REACH / (1 << o), math.pi) * ARCSEC_PER_RADIAN) for o in orders}
    n = F.expr("shiftleft(1L, cast(Norder as int))")
    centres = with_face_vector(with_face_position(partitions, "Npix", "Norder"), "_face", F.col("_ix") + 0.5, F.col("_iy") + 0.5, n, _RIGHT)
    centres = materialize(centres.select("Norder", "Npix", *_RIGHT))
    found = None
    for o in orders:
        size = 2.0 * _slack(radius[o])
        own = broadcast_checked(with_touched_cells(centres.where(F.col("Norder") == o), _RIGHT, size, radius[o]))
        near = with_cell(spots, _LEFT, size).join(own, list(CELL)).drop(*CELL)
        limit = _slack(radius[o])
        near = near.where(squared_chord(_LEFT, _RIGHT) <= limit * limit)
        found = near if found is None else found.unionByName(near)
    return None if found is None else found.drop(*_RIGHT)


def margin_rows(
    df: DataFrame,
    partitions: DataFrame,
    threshold_arcsec: float,
    ra: str = "ra",
    dec: str = "dec",
) -> DataFrame:
    """Copies of rows just outside each partition, keyed to that partition.

    ``df`` carries its own ``Norder, Npix`` (null for a row in no partition); ``partitions`` lists all
    partitions. The result carries the target's ``Norder, Dir, Npix``, once for each partition whose
    pixel lies within the threshold of the row, measured to its curved outline; the threshold may exceed
    the pixels. Equal rows have separate copies, rows without a position have none.
    """
    angle = threshold_arcsec / ARCSEC_PER_RADIAN
    columns = list(df.columns)
    located = with_pixel(df, ra, dec, out="_own", keep_face=True).where(F.col("_own").isNotNull())
    # Position inside the row's own partition, as a share of its width; rows farther from every
    # edge than the threshold can be left out before anything is copied.
    size = F.expr(f"shiftleft(1L, {FINEST_ORDER} - cast(Norder as int))")
    margin = _FACE_SLOPE * angle * 2.0**FINEST_ORDER + 1.0
    inside_x, inside_y = F.col("_ix") % size, F.col("_iy") % size
    edge = F.least(inside_x, inside_y, size - inside_x, size - inside_y)
    close = located.where(F.col("Norder").isNull() | (edge <= margin))
    # The rows near an edge are a thin strip; fixing their numbers lets the copies travel without
    # the rows, and keeps equal rows apart. Crowded pixels are dealt over all tasks: the distances
    # cost far more than the rows weigh.
    close = close.withColumn("_strip", F.monotonically_increasing_id())
    close = materialize(close.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_strip"))
    vector = [c.alias(v) for c, v in zip(unit_vector(F.col(ra), F.col(dec)), _LEFT)]
    spots = close.select("_strip", F.col("Norder").alias("_o"), F.col("Npix").alias("_p"), *vector)
    candidates = _near_partitions(spots, partitions, angle)
    own = [c for c in columns if c not in ("Norder", "Dir", "Npix")]
    if candidates is None:
        return df.select(*own, "Norder", directory_of(F.col("Npix")).alias("Dir"), "Npix").limit(0)
    itself = F.col("Norder").eqNullSafe(F.col("_o")) & F.col("Npix").eqNullSafe(F.col("_p"))
    # The numbers of the distant outlines pass through Python, a few for each row of the strip.
    near = _near_edges(*[F.col(v) for v in _LEFT], F.col("Npix"), F.col("Norder"), angle)
    targets = candidates.where(~itself).withColumn("_near", near).where("_near")
    targets = targets.select("_strip", "Norder", directory_of(F.col("Npix")).alias("Dir"), "Npix")
    return close.select("_strip", *own).join(targets, "_strip").select(*own, "Norder", "Dir", "Npix")
