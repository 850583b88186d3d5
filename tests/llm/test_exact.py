"""The extendible-hash index and the groups of equal texts."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyweave.llm import exact

TEXTS = [None, "", " ", "a", "A", "a ", "é", "é", "x" * 300_000, "x" * 300_000 + "y", "hot"]


def rows_of(seed, n, first=0):
    rng = random.Random(seed)
    rows = [(first + i, "hot" if i % 3 == 0 else rng.choice(TEXTS) if i % 3 == 1 else f"text {rng.randrange(n)}") for i in range(n)]
    rng.shuffle(rows)
    return rows


def groups_of(rows):
    ids, sizes = defaultdict(list), defaultdict(int)
    for i, text in rows:
        sizes[text or ""] += 1
        ids[text or ""] += [] if i is None else [i]
    return {text: (max(ids[text], default=None), n) for text, n in sizes.items()}


def check(found, rows):
    expected = groups_of(rows)
    wanted = []
    for i, text in rows:
        keep, n = expected[text or ""]
        wanted.append((i, keep, n, i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("key_bits,bucket_bytes", [(64, 16 << 20), (64, 400), (5, 400), (1, 40)])
def test_groups(make_docs, key_bits, bucket_bytes):
    """All sizes of buckets and, with few bits, long chains of texts whose keys collide."""
    rows = [*rows_of(1, 240), (7, "a"), (7, "a"), (None, "a"), (None, "only null"), (None, "only null")]
    docs = make_docs(rows)
    check(exact.exact_groups(docs, key_bits=key_bits, bucket_bytes=bucket_bytes), rows)
    kept = exact.drop_copies(docs, key_bits=key_bits, bucket_bytes=bucket_bytes)
    assert kept.columns == docs.columns
    expected = groups_of(rows)
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted([(i, t) for i, t in rows if expected[t or ""][0] == i], key=repr)


def test_empty_table(make_docs):
    assert exact.exact_groups(make_docs([])).collect() == []
    assert exact.drop_copies(make_docs([])).collect() == []


@pytest.mark.parametrize("key_bits", [64, 6])
def test_batches_grow_the_index(spark, make_docs, tmp_path, key_bits):
    """Three batches give the entries of one; buckets split, the directory doubles, others keep their files."""
    batches = [rows_of(s, 90, 1000 * s) for s in (3, 4, 5)]
    index = exact.HashIndex(spark, str(tmp_path / "index"), bucket_bytes=8 * exact.ENTRY_BYTES, key_bits=key_bits)
    depths, before = [], []
    for n, batch in enumerate(batches):
        earlier = make_docs([r for b in batches[:n] for r in b]) if n else None
        entries = index.add(make_docs(batch).select("doc_id", "text"), earlier)
        before += batch
        expected = groups_of(before)
        assert sorted((r.keep_id, r.n_rows, r.n_bytes) for r in entries.collect()) == sorted(
            (keep, size, len(text.encode())) for text, (keep, size) in expected.items()
        )
        assert index.version() == n + 1
        slots = index.slots().collect()
        depths.append(slots[0].global_depth)
        assert sorted(r.slot for r in slots) == list(range(2 ** depths[-1]))  # every slot has one bucket
        wrong = entries.where((F.col("depth") > 0) & (F.expr("shiftrightunsigned(key, 64 - depth)") != F.col("prefix")))
        assert wrong.count() == 0
        for b in index.directory().collect():
            held = entries.where((F.col("depth") == b.depth) & (F.col("prefix") == b.prefix))
            assert held.count() == b.n_entries
            assert b.n_entries <= 8 or held.select("key").distinct().count() == 1
    assert depths == sorted(depths) and depths[0] > 1
    one = make_docs([(9999, "quite new")]).select("doc_id", "text")
    old = {(r.depth, r.prefix): r.version for r in index.directory().collect()}
    index.add(one, make_docs(before))
    new = {(r.depth, r.prefix): r.version for r in index.directory().collect()}
    assert sum(v != old.get(k) for k, v in new.items()) <= 4 < len(new)


def test_earlier_rows_are_needed(spark, make_docs, tmp_path):
    index = exact.HashIndex(spark, str(tmp_path / "index"))
    index.add(make_docs([(1, "a")]).select("doc_id", "text"))
    with pytest.raises(ValueError, match="earlier"):
        index.add(make_docs([(2, "a")]).select("doc_id", "text"))
