"""Adaptive sky partitions: pixel counts, the partition map and its use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.functions.sky import FINEST_ORDER, PIXEL, directory_of, parent_pixel
from skyweave.runtime import broadcast_checked, fits_broadcast, materialize


def pixel_histogram(df: DataFrame, order: int) -> DataFrame:
    """Rows per occupied pixel of the given order: ``pixel, n_rows``."""
    pixel = parent_pixel(F.col(PIXEL), FINEST_ORDER, order).alias("pixel")
    return df.select(pixel).groupBy("pixel").agg(F.count(F.lit(1)).alias("n_rows"))


def density_map(histogram: DataFrame, order: int, orders: Sequence[int]) -> DataFrame:
    """Row counts at several coarser orders, rolled up from one histogram."""
    levels = [
        F.struct(F.lit(o).alias("map_order"), parent_pixel(F.col("pixel"), order, o).alias("map_pixel"))
        for o in orders
    ]
    rows = histogram.select(F.explode(F.array(*levels)).alias("_level"), "n_rows")
    return (
        rows.groupBy("_level.map_order", "_level.map_pixel")
        .agg(F.sum("n_rows").alias("n_rows"))
        .withColumnRenamed("map_pixel", "pixel")
    )


def partition_map(histogram: DataFrame, order: int, threshold: int) -> DataFrame:
    """Partitions that fit a histogram: ``Norder, Dir, Npix, n_rows``.

    A partition is the coarsest pixel that holds at most ``threshold`` rows; pixels above the
    threshold at the finest order stay as they are. Counts only fall with the order, so the
    partitions are disjoint and cover everything.
    """
    # Most rows settle far above the finest order: those of a middle pixel that fits are looked at no deeper.
    middle = order // 2
    fine = histogram.withColumn("_at", parent_pixel(F.col("pixel"), order, middle))
    coarse = materialize(fine.groupBy(F.col("_at").alias("pixel")).agg(F.sum("n_rows").alias("n_rows")))
    levels = _levels(coarse, middle, range(middle + 1))
    if order > middle:
        crowded = coarse.where((F.col("n_rows") > threshold) | F.col("pixel").isNull()).select(F.col("pixel").alias("_crowded"))
        deep = fine.join(broadcast_checked(crowded), F.col("_at").eqNullSafe(F.col("_crowded")), "left_semi")
        levels = levels.unionByName(_levels(deep, order, range(middle + 1, order + 1)))
    totals = levels.groupBy("o", "p").agg(F.sum("n_rows").alias("n_rows"))
    # A chosen pixel is one that fits while its parent does not; a parent's rows are those of its (four) children.
    child = F.struct("p", "n_rows").alias("child")
    families = totals.groupBy("o", F.shiftright("p", 2).alias("parent")).agg(
        F.sum("n_rows").alias("all"), F.collect_list(child).alias("children")
    )
    # What has no pixel has no parent either.
    split = (F.col("o") == 0) | (F.col("all") > threshold) | F.col("parent").isNull()
    children = families.where(split).select("o", F.explode("children").alias("c"))
    chosen = children.select("o", "c.p", "c.n_rows").where((F.col("n_rows") <= threshold) | (F.col("o") == order))
    return chosen.select(
        F.col("o").alias("Norder"), directory_of(F.col("p")).alias("Dir"), F.col("p").alias("Npix"), "n_rows"
    )


def _levels(histogram: DataFrame, order: int, orders: Sequence[int]) -> DataFrame:
    """Each pixel of a histogram as its ancestors of some orders: ``o, p, n_rows``."""
    ancestors = [
        F.struct(F.lit(o).alias("o"), parent_pixel(F.col("pixel"), order, o).alias("p")) for o in orders
    ]
    return histogram.select(F.explode(F.array(*ancestors)).alias("a"), "n_rows").select("a.o", "a.p", "n_rows")


def assign_partitions(df: DataFrame, partitions: DataFrame, outside: str = "error") -> DataFrame:
    """Add ``Norder, Dir, Npix`` to rows that carry a finest-order pixel.

    A row that lies in no partition is an error, or with ``outside="drop"`` is left out, for
    positions that need not have a partition.

    There are as many partitions as rows divided by the threshold, far fewer than pixels, so
    they are looked up order by order in small broadcast tables and the rows are not shuffled.
    Should the partitions be too many for that, the same lookups are joins by shuffle.
    """
    partitions = partitions.select("Norder", "Npix")
    small = fits_broadcast(partitions)
    orders = sorted(row["Norder"] for row in partitions.select("Norder").distinct().collect())
    found: list[Column] = []
    for o in orders:
        pixel = f"_at{o}"
        known = partitions.where(F.col("Norder") == o)
        known = known.select(F.col("Npix").alias(pixel), F.lit(True).alias(f"_in{o}"))
        df = df.withColumn(pixel, parent_pixel(F.col(PIXEL), FINEST_ORDER, o))
        df = df.join(F.broadcast(known) if small else known, pixel, "left")
        found.append(F.when(F.col(f"_in{o}"), F.struct(F.lit(o).alias("o"), F.col(pixel).alias("p"))))
    nowhere = F.lit(None).cast("struct<o:int,p:bigint>")
    placed = df.withColumn("_place", F.coalesce(*found, nowhere))
    if outside == "drop":
        placed = placed.where(F.col("_place").isNotNull())
    else:
        message = F.concat(F.lit("a row lies in no planned partition, its pixel is "), F.col(PIXEL).cast("string"))
        missing = F.raise_error(message).cast("struct<o:int,p:bigint>")
        placed = placed.withColumn("_place", F.when(F.col("_place").isNull(), missing).otherwise(F.col("_place")))
    helpers = ["_place", *[f"_at{o}" for o in orders], *[f"_in{o}" for o in orders]]
    npix = F.col("_place.p")
    return placed.withColumns(
        {"Norder": F.col("_place.o"), "Dir": directory_of(npix), "Npix": npix}
    ).drop(*helpers)


def first_partitions(df: DataFrame, partitions: DataFrame, n: int = 10) -> DataFrame:
    """Rows of the first ``n`` partitions in order along the sky curve."""
    start = F.expr(f"shiftleft(Npix, 2 * ({FINEST_ORDER} - cast(Norder as int)))")
    chosen = partitions.orderBy(start).limit(n).select("Norder", "Npix")
    return df.join(F.broadcast(chosen), ["Norder", "Npix"], "left_semi")
