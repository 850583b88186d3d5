"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.rows import cumulate, words
from skyweave.operators.numbering import number_rows
from skyweave.runtime import materialize

SEED = 31
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_PASSES = 2

# Tokens of a block, at most, and slots of a schedule, at least while a block has a token.
BLOCK_TOKENS = 1024
LEAST_SLOTS = 1 << 16

# Schedule points that one row generates.
_POINTS = 4096


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_PASSES
) -> DataFrame:
    """``sizes`` (source, source_size) with ``place``, ``weight`` and ``target``.

    Sources in code-point order, null last, weigh ``weights``, repeating, and share ``share`` times
    all tokens; no target exceeds ``most`` times its source, what is over goes to the others by
    weight. All are targets min(most * size, level * weight) for one level, found by one aggregate
    for each set of full sources; the sets only grow. No source, or no token, gives targets of 0.
    """
    placed = number_rows(sizes, [F.col("source").asc_nulls_last()], out="place")
    # number_rows orders nulls as its keys say, and keeps all columns
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = materialize(
        placed.withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int")))
    )
    cap = F.col("source_size").cast("double") * most
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    level, full = 0.0, -1
    while total:
        is_full = cap <= F.col("weight") * F.lit(level)
        found = weighed.agg(
            F.sum(F.when(is_full, cap).otherwise(0.0)).alias("taken"),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(is_full, 1)).alias("full"),
        ).first()
        if found["full"] == full or not found["open"]:
            break
        full, level = found["full"], (share * total - found["taken"]) / found["open"]
    return weighed.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


@dataclass(frozen=True)
class Mixture:
    """``documents``: doc_id, source, size, source_size, target, taken, copies. ``schedule``: slot, source, block, pass_no."""

    documents: DataFrame
    schedule: DataFrame
    block_tokens: int


def mix(
    docs: DataFrame, size: Column, key: str = "doc_id", source: str = "source", weights: Sequence[float] = WEIGHTS,
    share: float = SHARE, most: int = MOST_PASSES, block_tokens: int = BLOCK_TOKENS, least_slots: int = LEAST_SLOTS,
    seed: int = SEED,
) -> Mixture:
    """Plan which tokens of which documents a mixture takes, in which order.

    The rows of a source, shuffled by a seeded hash, are one stream of tokens, cut into blocks of
    equal length (the last may be shorter). Slot i of the mixture belongs to the source whose share
    of the cumulative targets holds the van der Corput point of i; the n-th slot of a source takes
    its n-th block, from the start again after the last, at most ``most`` times. ``taken`` sums the
    tokens of a document in taken blocks, repeats counted; ``copies`` counts how often its first
    token is taken.

    A null source is a source of its own, null sizes are 0, and such documents are never taken.
    Repeated rows are documents each. Blocks shrink on small inputs so that there are
    ``least_slots`` slots, else rounding to whole blocks would show.
    """
    rows = materialize(
        docs.select(
            F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
            F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(cumulate(source_targets(sizes, weights, share, most), ["place"], "target", prefix="_target_"))
    wanted = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0)).alias("n")).first()["n"]
    tokens = max(1, min(block_tokens, int(wanted) // least_slots))
    n_slots = math.ceil(wanted / tokens)

    known = rows.alias("d").join(targets.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    known = known.select("d.*", "s.place", "s.source_size", "s.target")
    known = known.withColumn("_shuffled", F.xxhash64(F.lit(seed), "doc_id", "size"))
    stream = cumulate(known, ["_shuffled", "doc_id", "size"], "size", within=["place"]).drop("_shuffled")
    first, last = F.expr(f"_before div {tokens}"), F.expr(f"(_before + size - 1) div {tokens}")
    pieces = stream.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    start = F.greatest(F.col("_before"), F.col("block") * tokens)
    end = F.least(F.col("_before") + F.col("size"), (F.col("block") + 1) * tokens)
    pieces = pieces.withColumn("_tokens", end - start).withColumn("_opens", F.col("block") == first)

    slots = _schedule(targets, wanted, n_slots, tokens, most)
    times = slots.groupBy("place", "block").agg(F.count(F.lit(1)).alias("_times"))
    joined = pieces.join(times, ["place", "block"], "left")
    taken = joined.groupBy("place", "_rank", "doc_id", "source", "size", "source_size", "target").agg(
        F.coalesce(F.sum(F.col("_tokens") * F.col("_times")), F.lit(0)).alias("taken"),
        F.coalesce(F.sum(F.when(F.col("_opens"), F.col("_times"))), F.lit(0)).alias("copies"),
    )
    named = slots.join(targets.select("place", "source"), "place").select("slot", "source", "block", "pass_no")
    return Mixture(taken.drop("place", "_rank"), named, tokens)


def _schedule(targets: DataFrame, wanted: float, n_slots: int, tokens: int, most: int) -> DataFrame:
    """``slot``, ``place``, ``block``, ``pass_no`` of all slots that take a block.

    The points of slots 0 … 2^bits - 1 are all multiples of 2^-bits; those of one source are one
    range, which it generates in short runs; their slots are the reversed bits.
    """
    bits = max(1, math.ceil(math.log2(max(2, n_slots))))
    points = 1 << bits
    share = lambda x: F.ceil(x / F.lit(wanted or 1.0) * points)
    low = share(F.col("_target_before"))
    high = share(F.col("_target_before") + F.col("target"))
    owned = targets.where(F.col("target") > 0).select(
        "place", F.expr(f"(source_size + {tokens - 1}) div {tokens}").alias("_blocks"), low.alias("_low"),
        F.least(high, F.lit(points)).alias("_high"),
    ).where("_low < _high")
    runs = owned.withColumn("_run", F.explode(F.expr(f"sequence(_low div {_POINTS}, (_high - 1) div {_POINTS})")))
    inside = F.sequence(F.greatest("_low", F.col("_run") * _POINTS), F.least("_high", (F.col("_run") + 1) * _POINTS) - 1)
    dealt = runs.repartition(F.col("place"), F.col("_run")).withColumn("_point", F.explode(inside))
    reversed_bits = F.conv(F.reverse(F.lpad(F.bin("_point"), bits, "0")), 2, 10).cast("long")
    slots = dealt.select("place", "_blocks", reversed_bits.alias("slot")).where(F.col("slot") < n_slots)
    ranked = number_rows(slots, ["slot"], within=["place"], out="_nth").where(F.col("_nth") < F.col("_blocks") * most)
    return ranked.select(
        "slot", "place", F.expr("_nth % _blocks").alias("block"), F.expr("_nth div _blocks").alias("pass_no")
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **settings) -> DataFrame:
    """The rows of the mixture with their columns: each as often as the mixture takes its first token.

    ``key`` tells rows apart; rows that share key, source and size are taken alike.
    """
    size = word_count(F.col(f"`{text}`"))
    plan = mix(docs, size, key, source, **settings).documents
    counts = plan.groupBy("doc_id", "source", "size").agg(F.min("copies").alias("_least"), F.max("copies").alias("_copies"))
    rows = docs.alias("d").join(
        counts.where("_copies > 0").alias("m"),
        F.col(f"d.`{key}`").eqNullSafe(F.col("m.doc_id"))
        & F.col(f"d.`{source}`").eqNullSafe(F.col("m.source"))
        & (word_count(F.col(f"d.`{text}`")) == F.col("m.size")),
    )
    repeated = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("m._copies").cast("int"))))
    return repeated.select(*[F.col(f"d.`{c}`") for c in docs.columns])
