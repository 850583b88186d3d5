"""Connected components by alternating stars, each step a join on small labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.rows import TASK_ROWS, written


def _both(df: DataFrame, one: tuple[str, str], other: tuple[str, str]) -> DataFrame:
    """Two edges (``a``, ``b``) for each row of ``df``."""
    edge = lambda ends: F.struct(F.col(ends[0]).alias("a"), F.col(ends[1]).alias("b"))
    return df.select(F.explode(F.array(edge(one), edge(other))).alias("edge")).select("edge.*")


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for all nodes of ``edges`` (long columns ``a``, ``b``); root is the component's smallest node.

    Large and small stars replace edges by edges to the smallest neighbour until every node has one
    root, itself or the one node it has an edge to; the number of edges never grows, and the rounds
    follow the logarithm of the longest path. The first round reads ``edges`` several times, every
    other what the last one wrote, without a shuffle if one task wrote it all. Loops and repeated
    edges do no harm.
    """
    n_edges = edges.count()
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        least = _both(current, ("a", "b"), ("b", "a")).groupBy("a").agg(F.min("b").alias("m"))
        large = current.join(least.select(F.col("a").alias("b"), F.least("a", "m").alias("m")), "b").select("a", F.col("m").alias("b"))
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _both(large.join(lower, "a"), ("a", "m"), ("b", "m")).where("a <> b").distinct()
        current = written(small, "edges", n_edges)
        if n_edges < TASK_ROWS:
            current = current.coalesce(1)
        rooted = _both(current, ("a", "b"), ("b", "b")).groupBy("a").agg(F.min("b").alias("root"), F.max("b").alias("other"))
        if rooted.where("root <> other").isEmpty():
            return rooted.select(F.col("a").alias("node"), "root")
