"""Merkle manifest of a dataset: a tree of digests over nested intervals of leaf ranks.

Rows are ranked once, by source and id. A node carries the interval [``lo``, ``hi``) of leaf ranks it
covers; its parent is the node one level up whose interval contains it. The parent's number, its place
among the nodes of its level and source, is the bucket of that containment join, so the join is an
equi-join that the intervals confirm. A parent's interval less a child's own gives the siblings on its
left and on its right, which is what a proof needs. Each level has a sixteenth of the rows of the one
below; nothing but the root's digest comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.rows import written
from skyweave.operators.numbering import number_rows
from skyweave.runtime import broadcast_checked, materialize

FANOUT = 16
# Nodes that a task writes at least: small levels of a tree make few files, whatever the shuffle partitions.
TASK_NODES = 1 << 15
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_STEP = "array<struct<left:string,right:string>>"


def digest_of(columns: Sequence[Column]) -> Column:
    """Hex digest of values, each as ``-`` if null, else as its length in bytes, a colon and itself."""
    parts = []
    for value in columns:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """Root that follows from a leaf and the siblings of its ancestors, lowest first."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def path_text(path: Column) -> Column:
    """All siblings of a path, level by level, from left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _next_level(nodes: DataFrame) -> DataFrame:
    """Parents of the nodes (``tree, start, size, place, lo, hi, digest``) that are not alone in their tree.

    ``place`` numbers the nodes of a level of one tree, ``size`` says how many there are. A parent
    keeps its children, sixteen at most, in order.
    """
    child = F.struct("lo", "hi", "digest")
    runs = nodes.where("size > 1").withColumn("place", F.expr(f"place div {FANOUT}"))
    grouped = runs.groupBy("tree", "place").agg(
        F.first("start").alias("start"),
        F.first("size").alias("size"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.array_sort(F.collect_list(child)).alias("children"),
    )
    return grouped.select(
        "tree", "start", F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("size"), "place", "lo", "hi",
        F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), ""), 256).alias("digest"), "children",
    )


def _few(df: DataFrame, n_rows: int) -> DataFrame:
    """``df``, made from or of so many rows, in no more tasks than they are worth."""
    return df.coalesce(1 + n_rows // TASK_NODES)


def _levels(nodes: DataFrame, n_most: int) -> list[DataFrame]:
    """All levels above the nodes, lowest first; a tree is absent from the levels above its top."""
    found = []
    while n_most > 1:
        nodes = written(_few(_next_level(nodes), nodes.count()), f"merkle-level-{len(found) + 1}")
        found.append(nodes)
        n_most = -(-n_most // FANOUT)
    return found


def _tops(lowest: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``tree, lo, hi, digest`` of the one node in which each tree ends."""
    columns = ["tree", "lo", "hi", "digest"]
    tops = lowest.where("size = 1").select(*columns)
    for level in levels:
        tops = tops.unionByName(level.where("size = 1").select(*columns))
    return tops


def _siblings(children: Column, lo: Column, hi: Column) -> Column:
    """What the parent's interval has besides the child's own, as digests on the left and on the right."""
    joined = lambda keep: F.array_join(F.transform(F.filter(children, keep), lambda c: c["digest"]), "")
    return F.struct(joined(lambda c: c["hi"] <= lo).alias("left"), joined(lambda c: c["lo"] >= hi).alias("right"))


def _descend(tops: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``tree, place, lo, hi, path, top`` of the nodes below the lowest of the levels, by containment joins downwards.

    ``tops`` has the ``path`` above the top of each tree (``tree``) and the digest there.
    """
    columns = ["tree", "place", "lo", "hi", "path", "top"]
    below = None
    for level in reversed(levels):
        # Trees whose top is on this level start here; others come from the level above.
        here = level.where("size = 1").select("tree", "place", "lo", "hi").join(tops.select("tree", "path", "top"), "tree")
        paths = here.select(*columns) if below is None else below.unionByName(here.select(*columns))
        own, up = level.alias("own"), paths.alias("up")
        inside = (F.col("up.lo") <= F.col("own.lo")) & (F.col("own.hi") <= F.col("up.hi"))
        bucket = (F.col("own.tree") == F.col("up.tree")) & (F.col("own.place") == F.col("up.place"))
        runs = own.join(up, bucket & inside).select("own.tree", "own.place", "own.children", "up.path", "up.top")
        opened = runs.select("tree", "place", "children", "path", "top", F.posexplode("children").alias("at", "child"))
        step = F.array(_siblings(F.col("children"), F.col("child.lo"), F.col("child.hi")))
        below = opened.select(
            "tree", (F.col("place") * FANOUT + F.col("at")).alias("place"), F.col("child.lo").alias("lo"),
            F.col("child.hi").alias("hi"), F.concat(step, F.col("path")).alias("path"), "top",
        )
        below = materialize(_few(below, FANOUT * level.count()))
    return below


@dataclass(frozen=True)
class Manifest:
    """A manifest: ``leaves`` (payload columns, ``tree``, ``place``, ``lo``, ``leaf``), levels of each source, and the tree over sources."""

    leaves: DataFrame
    levels: list[DataFrame]
    sources: DataFrame
    top_levels: list[DataFrame]
    root: str | None

    def nodes(self) -> DataFrame:
        """All nodes: ``part`` (source, root), ``level`` from 0, ``lo``, ``hi`` in ranks of leaves, ``digest``."""
        columns = ["lo", "hi", "digest"]
        own = self.leaves.select(F.lit("source").alias("part"), F.lit(0).alias("level"), "lo", (F.col("lo") + 1).alias("hi"), F.col("leaf").alias("digest"))
        for part, levels in (("source", self.levels), ("root", self.top_levels)):
            for n, level in enumerate(levels, start=1):
                own = own.unionByName(level.select(F.lit(part).alias("part"), F.lit(n).alias("level"), *columns))
        return own

    def proofs(self) -> DataFrame:
        """Leaves with their ``path`` to the root, lowest siblings first, and their ``subroot``."""
        paths = materialize(self._source_paths())
        single = self.leaves.where("size = 1").join(paths.select("tree", "path", F.col("top").alias("subroot")), "tree")
        single = single.select(*self.leaves.columns, "path", "subroot")
        if not self.levels:
            return single
        lowest, above = self.levels[0], self.levels[1:]
        runs = lowest.where("size = 1").select("tree", "place", "lo", "hi").join(paths.select("tree", "path", "top"), "tree")
        if above:
            runs = runs.unionByName(_descend(paths, above).select(*runs.columns))
        own, up = lowest.alias("own"), runs.alias("up")
        inside = (F.col("up.lo") <= F.col("own.lo")) & (F.col("own.hi") <= F.col("up.hi"))
        bucket = (F.col("own.tree") == F.col("up.tree")) & (F.col("own.place") == F.col("up.place"))
        runs = own.join(up, bucket & inside).select("own.lo", "own.hi", "own.children", "up.path", "up.top")
        # The number of a leaf's run is the bucket of the last join; the run's interval holds the leaf's rank.
        placed = self.leaves.where("size > 1").withColumn("_run", F.expr(f"start + place div {FANOUT} * {FANOUT}"))
        leaf, run = placed.alias("leaf"), runs.alias("run")
        held = (F.col("leaf.lo") >= F.col("run.lo")) & (F.col("leaf.lo") < F.col("run.hi"))
        joined = leaf.join(run, (F.col("leaf._run") == F.col("run.lo")) & held)
        step = F.array(_siblings(F.col("run.children"), F.col("leaf.lo"), F.col("leaf.lo") + 1))
        many = joined.select(
            *[f"leaf.{c}" for c in self.leaves.columns], F.concat(step, F.col("run.path")).alias("path"), F.col("run.top").alias("subroot")
        )
        return many.unionByName(single)

    def _source_paths(self) -> DataFrame:
        """``tree, path, top`` of each source: what stands above its subroot, and the subroot."""
        nothing = F.expr(f"cast(array() as {_STEP})")
        if not self.top_levels:
            return self.sources.select("tree", nothing.alias("path"), F.col("digest").alias("top"))
        crown = self.top_levels[-1].select("tree", nothing.alias("path"), F.col("digest").alias("top"))
        own, up = self.sources.alias("own"), _descend(crown, self.top_levels).alias("up")
        same = (F.col("own.lo") == F.col("up.lo")) & (F.col("own.hi") == F.col("up.hi"))
        return own.join(up, same).select("own.tree", "up.path", F.col("own.digest").alias("top"))


def build_manifest(docs: DataFrame, leaf: Column, key: str = "doc_id", source: str = "source", payload: dict[str, Column] | None = None) -> Manifest:
    """Manifest of all rows: trees of each source in order of ids, and a tree over their roots.

    ``leaf`` gives the digest of a row; ``payload`` columns stay with the leaves. Sources are ordered
    bytewise, null first; null ids come first within a source, and rows of one id are ordered by their
    digests. A source of one row has that leaf as its root, and one source alone has the whole root; no
    rows have no root (null).
    """
    payload = payload or {}
    own = [F.col(f"`{key}`").alias("_key"), F.col(f"`{source}`").cast("string").alias("_source"), leaf.alias("leaf")]
    rows = docs.select(*own, *[c.alias(f"_p_{name}") for name, c in payload.items()])
    order = ["_source", "_key", "leaf"]
    ranked = number_rows(rows, order, out="lo")
    n_rows = ranked.count()
    ranked = written(_few(ranked, n_rows), "merkle-leaves")
    # One row for each source and task; the ranks of a source follow one another.
    sources = ranked.groupBy("_source").agg(F.min("lo").alias("start"), F.count(F.lit(1)).alias("size"))
    sources = materialize(_few(sources.withColumn("tree", F.col("start")), n_rows))
    named = broadcast_checked(sources.withColumnRenamed("_source", "_s"))
    leaves = ranked.join(named, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s", "_source")
    leaves = leaves.select(
        F.col("_key").alias("key"), "leaf", *[F.col(f"_p_{name}").alias(name) for name in payload], "tree", "start", "size",
        (F.col("lo") - F.col("start")).alias("place"), "lo",
    )
    lowest = leaves.select("tree", "start", "size", "place", "lo", (F.col("lo") + 1).alias("hi"), F.col("leaf").alias("digest"))
    levels = _levels(lowest, sources.agg(F.max("size")).first()[0] or 0)
    tops = written(_few(_tops(lowest, levels), n_rows), "merkle-sources")
    ordered = number_rows(tops, ["lo"], out="place")
    n_sources = tops.count()
    ordered = ordered.select(
        F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("start"), F.lit(n_sources).cast("long").alias("size"), "place", "lo", "hi", "digest"
    )
    top_levels = _levels(materialize(ordered), n_sources)
    last = top_levels[-1] if top_levels else tops
    root = last.select("digest").first()
    return Manifest(leaves, levels, tops, top_levels, root["digest"] if root else None)


def write_manifest(manifest: Manifest, path: str) -> DataFrame:
    """The nodes as a table in ``path``, sorted by level and rank, and read back."""
    manifest.nodes().repartitionByRange("part", "level", "lo").sortWithinPartitions("part", "level", "lo").write.parquet(path)
    return manifest.leaves.sparkSession.read.parquet(path)


def check_rows(
    docs: DataFrame, seen: DataFrame, columns: Sequence[str], key: str = "doc_id", source: str = "source", text: str = "text",
    changed: Column | None = None,
) -> DataFrame:
    """Prove rows as they are ``seen`` against the manifest of ``docs``: one row for each of ``docs``.

    Gives ``key, leaf, subroot, root, proof_sha256, folded_root, verified``. ``seen`` is how the text
    reads now, an expression over ``docs``, used where ``changed`` holds; other rows are as they were.
    Null and empty values differ; repeated rows are leaves of their own; an empty table gives no rows.
    Columns besides the digested ones are not read.
    """
    fields = [F.col(f"`{c}`") for c in columns]
    now = [seen if c == text else F.col(f"`{c}`") for c in columns]
    other = F.when(F.coalesce(changed, F.lit(False)), digest_of(now))
    manifest = build_manifest(docs, digest_of(fields), key, source, {"changed": other})
    proofs = manifest.proofs()
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    shown = proofs.select(
        F.col("key").alias(key), "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"),
        F.sha2(path_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
