"""Joins of sky-partitioned tables that follow the partitions they already have.

Two partition lists of different orders overlap where one pixel is an ancestor of the other; the finer
of the two is a piece of their common refinement. A table *aligned* to another one's partitions carries
``CELL``, the number of the partition that holds each row, and is stored in buckets of it. Tables in
equal buckets meet cell by cell in the task that reads them, so a join keyed by (cell, id) moves no
row; only rows near or beyond the border of their cell travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions.sky import FINEST_ORDER, PIXEL, parent_pixel
from skyweave.runtime import broadcast_checked, fits_broadcast, materialize

# Number of the partition of the reference table that holds a row; null where there is none.
CELL = "_cell"


def cell_number(order: Column | str, pixel: Column | str) -> Column:
    """One number for a pixel of any order: the pixel under a leading bit that tells the order."""
    order = F.col(order) if isinstance(order, str) else order
    pixel = F.col(pixel) if isinstance(pixel, str) else pixel
    return F.call_function("shiftleft", F.lit(1).cast("long"), (order.cast("int") * 2 + 4).cast("int")) + pixel


def _ancestors(partitions: DataFrame, own: str, above: str) -> DataFrame:
    """``partitions`` (``{own}_order, {own}_pixel``) beside each of its ancestors, itself included."""
    orders = F.sequence(F.lit(0), F.col(f"{own}_order"))
    opened = partitions.withColumn(f"{above}_order", F.explode(orders))
    shift = f"2 * ({own}_order - {above}_order)"
    return opened.withColumn(f"{above}_pixel", F.expr(f"shiftright({own}_pixel, {shift})"))


def refinement(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Common refinement of two partition lists (``Norder, Npix``).

    Gives ``left_order, left_pixel, right_order, right_pixel, order, pixel`` for every overlapping
    pair, ``order, pixel`` being the finer of both; ``how="left"`` adds left partitions that overlap
    nothing, with nulls on the right. Pixels contain each other or are apart, so overlaps are
    equi-joins on ancestors, at most ``FINEST_ORDER`` + 1 for each partition.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how={how!r} is neither 'inner' nor 'left'")
    lefts = left.select(F.col("Norder").cast("int").alias("left_order"), F.col("Npix").alias("left_pixel"))
    rights = right.select(F.col("Norder").cast("int").alias("right_order"), F.col("Npix").alias("right_pixel"))
    coarser = _ancestors(rights, "right", "left").join(lefts, ["left_order", "left_pixel"])
    finer = _ancestors(lefts, "left", "right").where("right_order < left_order").join(rights, ["right_order", "right_pixel"])
    columns = ["left_order", "left_pixel", "right_order", "right_pixel"]
    both = coarser.select(columns).unionByName(finer.select(columns))
    if how == "left":
        both = lefts.join(both, ["left_order", "left_pixel"], "left").select(columns)
    order = F.greatest("left_order", "right_order")
    pixel = F.when(F.col("right_order") >= F.col("left_order"), F.col("right_pixel")).otherwise(F.col("left_pixel"))
    return both.withColumns({"order": order, "pixel": pixel})


def with_cell_of(df: DataFrame, partitions: DataFrame, out: str = CELL) -> DataFrame:
    """Add the number of the partition that holds each row's finest-order pixel, null outside all.

    The partitions of one order are looked up in a broadcast table, as in ``assign_partitions``; too
    many for that, they are joined by shuffle, once, on the ancestors that exist.
    """
    partitions = partitions.select("Norder", "Npix")
    orders = sorted(row["Norder"] for row in partitions.select("Norder").distinct().collect())
    if not orders:
        return df.withColumn(out, F.lit(None).cast("long"))
    small = fits_broadcast(partitions)
    found = []
    for order in orders:
        at = f"_at{order}"
        known = partitions.where(F.col("Norder") == order).select(
            F.col("Npix").alias(at), cell_number(F.lit(order), F.col("Npix")).alias(f"_in{order}")
        )
        df = df.withColumn(at, parent_pixel(F.col(PIXEL), FINEST_ORDER, order))
        df = df.join(F.broadcast(known) if small else known, at, "left").drop(at)
        found.append(F.col(f"_in{order}"))
    return df.withColumn(out, F.coalesce(*found)).drop(*[f"_in{o}" for o in orders])


def stray_keys(rows: DataFrame, reference: DataFrame, on: str) -> DataFrame:
    """Keys with a row in another cell than the reference has them in: ``on``, distinct.

    Both tables are aligned to the same cells. What is missing in a row's own cell is found where the
    row lies; only the keys of those rows are then looked up in all cells.
    """
    known = F.col(CELL).isNotNull()
    inside = rows.where(known & F.col(on).isNotNull()).select(CELL, on)
    away = inside.join(reference.where(known).select(CELL, on), [CELL, on], "left_anti").select(on)
    outside = rows.where(F.col(CELL).isNull() & F.col(on).isNotNull()).select(on)
    lost = materialize(away.unionByName(outside).distinct())
    return reference.select(on).join(broadcast_checked(lost), on, "left_semi").distinct()


def crowded_keys(rows: DataFrame, on: str, most: int) -> DataFrame:
    """Keys with more than ``most`` rows in their cell; keys are counted only in cells that hold as many."""
    inside = rows.where(F.col(CELL).isNotNull() & F.col(on).isNotNull())
    cells = inside.groupBy(CELL).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(CELL)
    counted = inside.join(broadcast_checked(materialize(cells)), CELL, "left_semi").groupBy(CELL, on).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > most).select(on)


def allow_co_located_joins(spark: SparkSession) -> None:
    """Let the session join tables in equal buckets of the cell by (cell, id) as they lie."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
