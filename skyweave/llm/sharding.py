"""Proportional stratified interleaving: shards of one size that all hold the mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.rows import cumulate, text_of
from skyweave.operators.numbering import number_rows
from skyweave.runtime import materialize

SEED = 2024


def shard_plan(
    docs: DataFrame, n_shards: int, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED
) -> DataFrame:
    """One narrow row per input row: ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Rows are shuffled within their source by a seeded hash, and the fractional rank
    (rank + phase) / rows of the source, the phase a hash of the source, interleaves all sources; the sorted sequence is cut into
    ``n_shards`` runs whose row counts differ by at most one, so each holds every source in
    proportion. ``size`` is UTF-8 bytes plus 8, ``text_crc32`` the unsigned checksum of the text.

    A null source is a source of its own, a null text is empty, a null key is a key. Rows equal in
    all of these are interchangeable and all of them stay. Other columns are not read. With fewer
    rows than shards the last shards stay empty. Only narrow rows are shuffled, by ranges, so a hot
    source is spread over many tasks.
    """
    text_column = text_of(F.col(f"`{text}`"))
    narrow = materialize(
        docs.select(
            F.col(f"`{key}`").alias("doc_id"),
            F.col(f"`{source}`").alias("_source"),
            (F.octet_length(text_column) + 8).cast("long").alias("size"),
            F.crc32(text_column).alias("text_crc32"),
            F.lit(1).alias("_one"),
        ).withColumn("_shuffled", F.xxhash64(F.lit(seed), "doc_id", "text_crc32"))
    )
    ranked = cumulate(narrow, ["_shuffled", "doc_id", "text_crc32"], "_one", within=["_source"])
    counts = narrow.groupBy("_source").agg(F.count(F.lit(1)).alias("_rows"))
    # A phase of its own for each source; with one phase for all, sources of one size would move in step.
    phase = F.pmod(F.xxhash64(F.lit(seed), "r._source"), F.lit(1 << 20)) / (1 << 20)
    fraction = ((F.col("_rank") + phase) / F.col("_rows")).alias("_fraction")
    placed = ranked.alias("r").join(counts.alias("c"), F.col("r._source").eqNullSafe(F.col("c._source"))).select(
        "r.doc_id", "r._source", "r.size", "r.text_crc32", "r._shuffled", fraction
    )
    order = ["_fraction", "_source", "_shuffled", "doc_id", "text_crc32"]
    ordered = number_rows(placed, order, out="_row")
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(1))).first()[0]
    # The first row of shard s is ceil(s * total / shards).
    shard = F.expr(f"_row * {n_shards} div {total}")
    first = F.expr(f"(_shard * {total} + {n_shards - 1}) div {n_shards}")
    return ordered.withColumn("_shard", shard).select(
        "doc_id", "size", "text_crc32", F.col("_shard").cast("int").alias("shard"), (F.col("_row") - first).alias("slot")
    )
