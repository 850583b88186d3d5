"""N-gram Jaccard join: rare-first prefix filtering over exact document frequencies.

Shingles are counted where they meet, in packed arrays: a task sends, for each bucket of shingles,
one row with the hashes of a chunk of documents. A bucket returns only shingles that stand in two
documents or more, with their frequency; one in a single document cannot be shared, comes first in
the rare-first order, and only its number matters. A document whose prefix holds nothing else has
no partner and drops out before any join. All other distinct texts meet at their prefix shingles,
and each pair that passes the filters is verified once. Components need fewer pairs: texts of a shingle
are first compared with one of them, and then only with texts of other components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm import texts
from skyweave.llm.components import components
from skyweave.llm.rows import TASK_ROWS, written
from skyweave.runtime import broadcast_checked, materialize

SHINGLE = 5
SIMILARITY = 75  # per cent

# Hashes that a task packs at a time, in bytes.
CHUNK_BYTES = 8 << 20

# Shared shingles in the sets that one task writes at least.
TASK_TOKENS = 1 << 19

# Parts of the hash space whose shared counts bound an overlap from above.
PARTS = 16

# A text with more than this share of all rows is hot.
MOST_HOT = 10_000

# Documents of one prefix shingle that meet in one group of rows.
BLOCK = 1024

_PACKED = "bucket int, chunk long, kind int, keys binary, owners binary, counts binary, ids binary, nodes binary, sizes binary"


def shingle_sets(column: pa.Array, length: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, owner, hash, node) of slices: distinct shingles of each text, owners ascending.

    ``node`` has two 64-bit hashes of each text's words; texts with equal words are one node. A text
    with fewer words than ``length`` has all of them as its one shingle.
    """
    for first, end, data, offsets in texts.slices(column):
        _, _, row, hashes = texts.word_hashes(data, offsets, texts.SPACED)
        n_rows = end - first
        n_words = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
        owners, found = [], []
        at, joined = texts.windows(hashes, row, length)
        owners.append(row[at])
        found.append(joined)
        for short in range(1, length):
            at, joined = texts.windows(hashes, row, short)
            whole = n_words[row[at]] == short
            owners.append(row[at][whole])
            found.append(texts.mixed(joined[whole] + np.uint64(short)))
        owner, shingle = np.concatenate(owners), np.concatenate(found)
        order = np.lexsort((shingle, owner))
        owner, shingle = owner[order], shingle[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
        sums = texts.prefix_sums(hashes)
        bounds = np.searchsorted(row, np.arange(n_rows + 1))
        one = texts.run_hashes(sums, bounds[:-1], bounds[1:])
        other = texts.run_hashes(texts.prefix_sums(texts.mixed(hashes + np.uint64(7))), bounds[:-1], bounds[1:])
        yield first, end, owner[new], shingle[new], np.stack([one, other], 1)


def _short(keys: np.ndarray) -> bytes:
    """The upper six bytes of each hash."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _owners(owners: np.ndarray) -> bytes:
    """Ascending numbers of documents, by their steps."""
    return texts.packed(np.diff(owners.astype(np.int64), prepend=0).astype("<u2"))


def _read_owners(data: bytes) -> np.ndarray:
    return np.cumsum(texts.unpacked(data, "<u2"), dtype=np.int64)


def _long(data: bytes) -> np.ndarray:
    """The hashes again; their low 16 bits are free for the bucket."""
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _pack(n_buckets: int, length: int, chunk_bytes: int):
    """Batches of (doc_id, text) to packed rows: kind 0 for each bucket, kind 1 for the chunk's documents."""

    def chunk_rows(parts, ids, valid) -> pa.RecordBatch:
        base = np.cumsum([0, *[len(p[2]) for p in parts]])
        owner = np.concatenate([p[0] + b for p, b in zip(parts, base)])
        shingle = np.concatenate([p[1] for p in parts])
        nodes = np.concatenate([p[2] for p in parts])
        sizes = np.bincount(owner, minlength=len(nodes)).astype("<i4")
        # Copies in the chunk send their shingles once.
        _, kept = np.unique(nodes, axis=0, return_index=True)
        is_first = np.zeros(len(nodes), bool)
        is_first[kept] = True
        sent = is_first[owner]
        owner, shingle = owner[sent].astype("<u2"), shingle[sent]
        # A chunk is named by its texts and ids, so that a task that runs again gives the same name.
        chunk = int.from_bytes(hashlib.blake2b(nodes.tobytes() + ids.tobytes(), digest_size=8).digest(), "little", signed=True)
        bucket = (shingle & np.uint64(0xFFFF)) % np.uint64(n_buckets)
        order = np.argsort(bucket.astype(np.uint16), kind="stable")
        bucket, owner, shingle = bucket[order], owner[order], shingle[order]
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
        rows = [
            (b, chunk, 0, _short(shingle[cuts[b] : cuts[b + 1]]), _owners(owner[cuts[b] : cuts[b + 1]]), None, None, None, None)
            for b in range(n_buckets)
            if cuts[b + 1] > cuts[b]
        ]
        ids_bytes = np.where(valid, ids, 0).astype("<i8").tobytes() + valid.astype(np.uint8).tobytes()
        rows.append((chunk % n_buckets, chunk, 1, None, None, None, ids_bytes, nodes.astype("<u8").tobytes(), sizes.tobytes()))
        columns = list(zip(*rows))
        kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 6]
        names = ["bucket", "chunk", "kind", "keys", "owners", "counts", "ids", "nodes", "sizes"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, ids, valid, size, n = [], [], [], 0, 0
        for batch in batches:
            doc_ids = batch.column("doc_id").cast(pa.int64())
            known = np.asarray(doc_ids.is_valid())
            filled = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
            for first, end, owner, shingle, nodes in shingle_sets(batch.column("text"), length):
                if parts and (size + len(shingle) * 8 > chunk_bytes or n + end - first > 0xFFFF):
                    yield chunk_rows(parts, np.concatenate(ids), np.concatenate(valid))
                    parts, ids, valid, size, n = [], [], [], 0, 0
                for at in range(0, end - first, 0xFFFF):  # owners are 16 bits
                    to = min(at + 0xFFFF, end - first)
                    mine = (owner >= at) & (owner < to)
                    if at:
                        yield chunk_rows(parts, np.concatenate(ids), np.concatenate(valid))
                        parts, ids, valid, size, n = [], [], [], 0, 0
                    parts.append((owner[mine] - at, shingle[mine], nodes[at:to]))
                    ids.append(filled[first + at : first + to])
                    valid.append(known[first + at : first + to])
                    size, n = size + len(shingle) * 8, n + to - at
        if parts:
            yield chunk_rows(parts, np.concatenate(ids), np.concatenate(valid))

    return pack


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: shingles of two documents or more, back by chunk with their frequency."""
    members = table.filter(pc.equal(table["kind"], 1))
    packed = table.filter(pc.equal(table["kind"], 0))
    keys = [_long(x.as_py()) for x in packed["keys"]]
    if not keys:
        return members
    all_keys = np.concatenate(keys)
    order = np.argsort(all_keys, kind="stable")
    ordered = all_keys[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    runs = np.diff(np.r_[starts, len(ordered)])
    count = np.empty(len(all_keys), "<u4")
    count[order] = np.repeat(runs, runs).astype("<u4")
    rows, at = [], 0
    for k, mine in enumerate(keys):
        counts = count[at : at + len(mine)]
        at += len(mine)
        often = counts > 1
        if often.any():
            owners = _owners(_read_owners(packed["owners"][k].as_py())[often])
            of = packed["bucket"][k].as_py(), packed["chunk"][k].as_py()
            rows.append((*of, 0, _short(mine[often]), owners, texts.packed(counts[often]), None, None, None))
    if not rows:
        return members
    found = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), table.schema)], schema=table.schema)
    return pa.concat_tables([members, found])


def prefix_length(n, similarity: int = SIMILARITY):
    """Two sets with this similarity share one of the first elements, in any common order."""
    return n - -(-n * similarity // 100) + 1


_SETS = "node binary, n int, alone int, tokens array<long>, parts array<int>"


def _assemble(similarity: int):
    """Of one chunk: the documents that may have a partner, their shared shingles rare first."""

    def assemble(table: pa.Table) -> pa.Table:
        names = pa.schema([("node", pa.binary()), ("n", pa.int32()), ("alone", pa.int32()), ("tokens", pa.list_(pa.int64())), ("parts", pa.list_(pa.int32()))])
        members = table.filter(pc.equal(table["kind"], 1))
        packed = table.filter(pc.equal(table["kind"], 0))
        if not len(packed) or not len(members):
            return pa.Table.from_pylist([], names)
        names_of = members["nodes"][0].as_py()
        sizes = np.frombuffer(members["sizes"][0].as_py(), "<i4")
        key = np.concatenate([_long(x.as_py()) | np.uint64(b.as_py()) for b, x in zip(packed["bucket"], packed["keys"])])
        owner = np.concatenate([_read_owners(x.as_py()) for x in packed["owners"]])
        count = np.concatenate([texts.unpacked(x.as_py(), "<u4") for x in packed["counts"]])
        order = np.lexsort((key, count, owner))
        owner, token = owner[order], key[order]
        once = np.r_[True, (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])]  # a chunk may have come twice
        owner, token = owner[once], token[once]
        cuts = np.searchsorted(owner, np.arange(len(sizes) + 1))
        rows = []
        for i, n in enumerate(sizes.tolist()):
            shared = int(cuts[i + 1] - cuts[i])
            if shared and n - shared < prefix_length(n, similarity):
                mine = token[cuts[i] : cuts[i + 1]]
                parts = np.bincount((mine >> np.uint64(60)).astype(np.int64), minlength=PARTS)
                rows.append((names_of[i * 16 : i * 16 + 16], n, n - shared, mine.astype(np.int64), parts.astype(np.int32)))
        if not rows:
            return pa.Table.from_pylist([], names)
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), names)], schema=names)

    return assemble


def _members(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in table:
        for ids, nodes, sizes in zip(batch["ids"], batch["nodes"], batch["sizes"]):
            sizes = np.frombuffer(sizes.as_py(), "<i4")
            n, raw, all_nodes = len(sizes), ids.as_py(), nodes.as_py()
            valid = np.frombuffer(raw[n * 8 :], np.uint8).astype(bool)
            numbers = pa.array(np.frombuffer(raw[: n * 8], "<i8"), mask=~valid)
            named = pa.array([all_nodes[i * 16 : i * 16 + 16] for i in range(n)], pa.binary())
            yield pa.RecordBatch.from_arrays([numbers, named, pa.array(sizes.astype(np.int64))], ["doc_id", "node", "n_shingles"])


def _similar(similarity: int, shared: Column, a: str, b: str) -> Column:
    return shared * 100 >= (F.col(a) + F.col(b) - shared) * similarity


def _judged(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Distinct pairs (``a``, ``b``) and whether they are ``similar`` enough, by their whole sets."""
    side = lambda x: sets.select(F.col("nid").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("t_a", "t_b"))
    return joined.select("a", "b", _similar(similarity, shared, "n_a", "n_b").alias("similar"))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Of distinct pairs (``a``, ``b``), the similar ones."""
    return _judged(pairs, sets, similarity).where("similar").select("a", "b")


def _far_enough(similarity: int) -> Column:
    """Length and positional filter of x and y, which share the shingle at their places."""
    least = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    return (
        (F.col("x.n") * 100 >= F.col("y.n") * similarity)
        & (F.col("y.n") * 100 >= F.col("x.n") * similarity)
        & (least * 100 >= (F.col("x.n") + F.col("y.n") - least) * similarity)
    )


def _bounded(met: DataFrame, parts: DataFrame, similarity: int) -> DataFrame:
    """Distinct pairs of x and y that pass the suffix filter."""
    pairs = met.select(F.least("x.nid", "y.nid").alias("a"), F.greatest("x.nid", "y.nid").alias("b")).distinct()
    side = lambda s: parts.select(F.col("nid").alias(s), F.col("n").alias(f"n_{s}"), F.col("parts").alias(f"p_{s}"))
    bounded = pairs.join(side("a"), "a").join(side("b"), "b")
    most = F.aggregate(F.zip_with("p_a", "p_b", lambda p, q: F.least(p, q)), F.lit(0), lambda s, p: s + p)
    return bounded.where(_similar(similarity, most, "n_a", "n_b")).select("a", "b")


def _shared_postings(postings: DataFrame) -> DataFrame:
    often = postings.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return postings.join(often, "token")


def _candidates(postings: DataFrame, parts: DataFrame, similarity: int, block: int) -> DataFrame:
    """Distinct pairs that share a prefix shingle and pass the length, positional and suffix filters.

    The documents of a frequent shingle are cut into blocks of about ``block``; each pair of blocks is
    a key of its own, so the pairs of one shingle are the work of many tasks.
    """
    n_blocks = F.ceil(F.col("m") / F.lit(block)).cast("int")
    placed = _shared_postings(postings).withColumn("k", n_blocks).withColumn("own", F.pmod(F.xxhash64("nid"), F.col("k")).cast("int"))
    narrow = ["token", "nid", "n", "place"]
    x = placed.select(*narrow, F.col("own").alias("i"), F.explode(F.expr("sequence(own, k - 1)")).alias("j")).alias("x")
    y = placed.select(*narrow, F.explode(F.expr("sequence(0, own)")).alias("i"), F.col("own").alias("j")).alias("y")
    met = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.i") == F.col("y.i"))
        & (F.col("x.j") == F.col("y.j"))
        & ((F.col("x.i") < F.col("x.j")) | (F.col("x.nid") < F.col("y.nid")))
        & _far_enough(similarity),
    )
    return _bounded(met, parts, similarity)


def _distinct_postings(postings: DataFrame) -> DataFrame:
    """Postings of the shingles of two texts or more, one shingle for each set of texts.

    Shingles with the same texts come in the same order in all of them; the earliest gives every pair
    that any of them gives, at the place that the positional filter needs. Equal sets of texts are
    told by their number and two combined hashes. The texts of a frequent shingle are dealt over ``slots``
    of about ``BLOCK`` texts.
    """
    hashes = [F.bit_xor(F.xxhash64("nid", F.lit(k))).alias(f"h{k}") for k in (1, 2)]
    lists = postings.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("nid").alias("nid"), F.min_by("place", "nid").alias("at"), *hashes)
    kept = lists.where("m > 1").groupBy("m", "h1", "h2", "nid").agg(F.min_by("token", "at").alias("token"))
    slots = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int").alias("slots")
    placed = postings.join(kept.select("token", slots), "token")
    return placed.withColumn("slot", F.pmod(F.xxhash64("nid"), F.col("slots")).cast("int"))


def _all_slots() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("slots") - 1))


def _met(x: DataFrame, y: DataFrame, similarity: int) -> DataFrame:
    """x and y of different components that share a shingle and may be similar; x stands in all slots of the shingle."""
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("token", "slot")]
    return x.alias("x").join(y.alias("y"), same[0] & same[1] & (F.col("x.root") != F.col("y.root")) & _far_enough(similarity))


def _joined_components(postings: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(``node``, ``root``) of the texts that have a link, from as few pairs as decide it.

    The texts of a prefix shingle are compared with one of them, the hub, and components are formed. The
    hub is the text with the fewest shingles of its own, the likeliest original of the others.
    Shingles whose texts lie in several components go on: a hub outside the largest of them is
    compared with all texts of other components, while a round links one text in a hundred. Then every
    pair that is left, of texts in different components, is compared. No pair is verified twice, and none is left
    out but those within a component, whose links cannot change it.
    """
    groups = written(_distinct_postings(postings), "postings")
    n_postings, n_texts = groups.count(), sets.count()
    hub = F.min(F.struct("alone", "nid", "n", "place", "root")).alias("hub")
    labels = tried = None

    def labelled(links: DataFrame) -> DataFrame:
        known = links if labels is None else links.union(labels.select(F.col("node").alias("a"), F.col("root").alias("b")))
        return written(components(known), "labels", n_texts)

    rest = groups.withColumns({"root": F.col("nid"), "top": F.lit(None).cast("long")})
    pays = True
    while pays:
        hubs = rest.where("top IS NULL OR root <> top").groupBy("token", "slots").agg(hub)
        pairs = _bounded(_met(hubs.select("token", "hub.*", _all_slots().alias("slot")), rest, similarity), sets, similarity)
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        judged = written(_judged(pairs, sets, similarity), "pairs")
        tried = judged.select("a", "b") if tried is None else tried.union(judged.select("a", "b"))
        links = judged.where("similar").select("a", "b")
        n_links = links.count()
        if labels is not None and not n_links:
            break
        labels = labelled(links)
        own = labels.select(F.col("node").alias("nid"), "root")
        rest = rest.select(*groups.columns).join(own, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
        counted = rest.groupBy("token", "slots", "root").agg(F.count(F.lit(1)).alias("c"))
        tops = counted.groupBy("token", "slots").agg(F.max(F.struct("c", "root"))["root"].alias("top"), F.count(F.lit(1)).alias("k"))
        tops = tops.where("k > 1").select("token", "top", _all_slots().alias("slot"))
        rest = written(rest.join(tops, ["token", "slot"]), "postings", n_postings)
        pays = n_links * 100 > n_texts
    # One side is the texts outside the largest component, so a large one costs no pairs of its own.
    x = rest.where("root <> top").withColumn("slot", _all_slots())
    once = (F.col("y.root") == F.col("y.top")) | (F.col("x.nid") < F.col("y.nid"))
    left = _bounded(_met(x, rest, similarity).where(once), sets, similarity)
    links = written(_verified(left.join(tried, ["a", "b"], "left_anti"), sets, similarity), "links")
    return labels if links.isEmpty() else labelled(links)


class _Prefixed(NamedTuple):
    n_rows: int
    members: DataFrame  # doc_id, node, n_shingles: every row
    sets: DataFrame  # nid, node, n, tokens, parts of the texts that may have a partner
    postings: DataFrame  # token, nid, n, alone, place: their prefix shingles


def _prefixed(docs: DataFrame, key: str, text: str, similarity: int, length: int, chunk_bytes: int, n_buckets: int | None) -> _Prefixed:
    spark = docs.sparkSession
    n_buckets = n_buckets or min(0xFFFF, int(spark.conf.get("spark.sql.shuffle.partitions")))
    narrow = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    packed = narrow.mapInArrow(_pack(n_buckets, length, chunk_bytes), _PACKED)
    shared = materialize(packed.groupBy("bucket").applyInArrow(_shared, _PACKED))
    total = lambda c: F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    size_bytes, key_bytes = shared.agg(total("sizes"), total("keys")).first()
    n_rows, n_tokens = size_bytes // 4, key_bytes // 6
    members = shared.where("kind = 1").select("ids", "nodes", "sizes").mapInArrow(_members, "doc_id long, node binary, n_shingles long")
    members = written(members.coalesce(1 + n_rows // TASK_ROWS + n_tokens // TASK_TOKENS), "members")
    sets = shared.groupBy("chunk").applyInArrow(_assemble(similarity), _SETS).dropDuplicates(["node"])
    sets = written(sets.withColumn("nid", F.monotonically_increasing_id()).coalesce(1 + n_tokens // TASK_TOKENS), "sets")
    prefix = F.slice("tokens", F.lit(1), F.greatest(_prefix(similarity) - F.col("alone"), F.lit(0)))
    postings = sets.select("nid", "n", "alone", F.posexplode(prefix).alias("at", "token"))
    return _Prefixed(n_rows, members, sets, postings.select("nid", "n", "alone", "token", (F.col("alone") + F.col("at")).alias("place")))


class SimilarPairs(NamedTuple):
    pairs: DataFrame
    members: DataFrame


def similar_pairs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY, length: int = SHINGLE,
    chunk_bytes: int = CHUNK_BYTES, n_buckets: int | None = None, block: int = BLOCK,
) -> SimilarPairs:
    """All similar pairs of distinct texts, and the rows that have each text.

    ``pairs`` (``a``, ``b``: names of texts, ``a`` < ``b``) has each link of ``similar_documents`` once.
    ``members`` (``doc_id``, ``node``, ``n_shingles``) names the text of every row; rows of one node
    have equal words and, unless these are none, are similar to each other and to the same others.
    """
    _, members, sets, postings = _prefixed(docs, key, text, similarity, length, chunk_bytes, n_buckets)
    links = materialize(_verified(_candidates(postings, sets, similarity, block), sets, similarity))
    side = lambda x: sets.select(F.col("nid").alias(x), F.col("node").alias(f"node_{x}"))
    named = links.join(side("a"), "a").join(side("b"), "b")
    return SimilarPairs(named.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")), members)


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY, length: int = SHINGLE,
    chunk_bytes: int = CHUNK_BYTES, n_buckets: int | None = None,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row: components of the similarity join.

    Two texts link when 100 * shared >= ``similarity`` * united distinct ``length``-word shingles,
    words being split at ASCII white space with A to Z lower-cased. Texts with fewer words are one
    shingle; empty and null texts have none and link with nothing. ``component_id`` is the smallest
    id reachable (nulls aside; null if there is no other). Equal texts are one node, whatever their
    number; repeated rows and ids are rows of their own. Other columns are not read.

    The components are those of all pairs that ``similar_pairs`` gives, found without making them all.
    """
    n_rows, members, sets, postings = _prefixed(docs, key, text, similarity, length, chunk_bytes, n_buckets)
    final = _joined_components(postings, sets, similarity)

    first = members.groupBy("node").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = written(first, "first", n_rows)
    rooted_nodes = sets.select("nid", "node").join(final.select(F.col("node").alias("nid"), "root"), "nid")
    lowest = rooted_nodes.join(first, "node").groupBy("root").agg(F.min("first").alias("lowest"))
    lowest = rooted_nodes.join(lowest, "root").select("node", "lowest")
    named = first.join(lowest, "node", "left").select("node", "copies", F.coalesce("lowest", "first").alias("named"))
    named = written(named, "named", n_rows)
    # The name of a text with many copies travels to its rows; there are at most MOST_HOT such texts.
    # Its rows are dealt by their numbers, under which no text stands.
    is_hot = F.col("copies") * MOST_HOT > n_rows
    hot = F.broadcast(named.where(is_hot).select("node", F.col("named").alias("hot_name"), F.lit(True).alias("hot")))
    number = F.monotonically_increasing_id().cast("string").cast("binary")
    marked = members.join(hot, "node", "left").withColumn("at", F.when(F.col("hot"), F.concat("node", number)).otherwise(F.col("node")))
    both = marked.join(named.where(~is_hot).select(F.col("node").alias("at"), "named"), "at", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("hot"), F.col("hot_name")).otherwise(F.col("named"))
    return both.select("doc_id", "n_shingles", component.alias("component_id"))


def _prefix(similarity: int) -> Column:
    """``prefix_length`` of column n."""
    return F.expr(f"CAST(n - (n * {similarity} + 99) div 100 + 1 AS INT)")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows with the smallest id of each component, with their columns as they came.

    Rows that share an id are one document and go only if all of them would; rows without an id stay.
    """
    found = similar_documents(docs, key, text, **settings)
    stays = F.max(F.col("doc_id") == F.col("component_id"))
    gone = found.groupBy("doc_id").agg(stays.alias("stays")).where("doc_id IS NOT NULL AND NOT stays").select("doc_id")
    gone = broadcast_checked(materialize(gone))
    return docs.join(gone, docs[f"`{key}`"] == gone["doc_id"], "left_anti")
