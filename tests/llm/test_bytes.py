"""Removal of repeated byte runs against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from skyweave.llm import suffixes


def brute(rows):
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        earlier = {
            (t or "").encode()[i : i + 50]
            for d, t in rows
            if d is not None and (doc is None or d < doc)
            for i in range(len((t or "").encode()) - 49)
        }
        for i in range(len(data) - 49):
            if data[i : i + 50] in earlier:
                gone[i : i + 50] = b"\x01" * 50
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(docs, **settings):
    rows = suffixes.remove_repeats(docs, **settings).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept.hex()) for r in rows), key=repr)


@pytest.fixture(scope="module")
def rows(vocabulary):
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, accents = prose(14), "é" * 40 + "ü" * 5
    base = prose(120)
    texts = [
        base, base, base[:300] + "X" + base[300:], prose(40) + passage + prose(9), passage[:50], passage[:49], passage[1:51] + "z",
        None, "", "short", prose(30) + accents, accents + prose(20), "a" * 400, "a" * 120, "b" + "a" * 49, prose(3000) + passage,
        base[100:160] + base[40:100],
    ]
    numbered = [(i * 3, t) for i, t in enumerate(texts)]
    return [*numbered, (3, base), (None, base), (None, passage), (1, passage)]


def test_brute_force(make_docs, rows):
    assert found(make_docs(rows)) == brute(rows)


def test_small_chunks_and_few_buckets(make_docs, rows):
    docs = make_docs(rows).repartition(3)
    assert found(docs, chunk_bytes=500, n_buckets=2) == brute(rows)


def test_rows_in_another_order_at_each_scan(make_docs, rows):
    def shuffled(batches):
        for row in random.SystemRandom().sample(whole := [r for b in batches for r in b.to_pylist()], len(whole)):
            yield pa.RecordBatch.from_pylist([row], pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))

    docs = make_docs(rows).coalesce(1).select("doc_id", "text").mapInArrow(shuffled, "doc_id long, text string")
    assert found(docs) == brute(rows)


@pytest.mark.parametrize("crowded", [0, 3, 12])
def test_crowded_seeds(make_docs, rows, crowded):
    assert found(make_docs(rows).repartition(3), chunk_bytes=3000, n_buckets=5, crowded=crowded) == brute(rows)


def string_rows(documents, n_buckets):
    """The rows that the chunks of some texts send to ``_cover``, step by step without Spark."""
    batch = lambda rows: pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    packed = [pa.Table.from_batches(suffixes._send_texts(1 << 20)(iter([batch(documents[i : i + 100])]))) for i in range(0, len(documents), 100)]
    seeds = pa.concat_tables(pa.Table.from_batches(suffixes._send_seeds(n_buckets)(iter(p.to_batches()))) for p in packed)
    mark = suffixes._mark(500)
    marks = pa.concat_tables(mark(seeds.filter(pc.equal(seeds["bucket"], b))) for b in range(n_buckets))
    sent = [suffixes._send_strings(n_buckets)(p, marks.filter(pc.equal(marks["chunk"], p["chunk"][0]))) for p in packed]
    return pa.concat_tables(sent), seeds


def test_a_passage_of_most_rows_is_spread_over_buckets(vocabulary):
    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = prose(8)[:30]  # one seed or few, in different surroundings everywhere
    sent, seeds = string_rows([(i, prose(8) + passage + prose(8)) for i in range(2000)], 64)
    load = [0] * 64
    for r in sent.to_pylist():
        if r["kind"] == 4:
            load[r["bucket"]] += len(r["a"]) // 16
        elif r["kind"] == 0:
            load[r["bucket"]] += int((suffixes._unzip(r["b"], "<u4").astype(int) - 49).sum())
    assert sum(load) > 2000 and max(load) < sum(load) / 8
    # The seeds of the passage come once from each chunk, not once from each row.
    twice = [r for r in seeds.to_pylist() if r["kind"] == 0]
    assert all(len({r["a"][i : i + 6] for i in range(0, len(r["a"]), 6)}) * 6 == len(r["a"]) for r in twice)


def test_a_chunk_without_replies_is_an_error():
    text = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a text"]})
    left = pa.Table.from_batches(suffixes._send_texts(1000)(iter([text])))
    for step in (suffixes._send_strings(2), suffixes._cut(False)):
        with pytest.raises(ValueError, match="do not meet"):
            step(left, left.slice(0, 0))


def test_kept_text(make_docs):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    docs = make_docs([(1, passage), (2, "start " + passage + " end")])
    kept = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(docs, keep_text=True).collect()}
    assert kept == {1: passage.encode(), 2: b"start  end"}


def test_no_rows(make_docs):
    assert found(make_docs([])) == []


def test_family_merges_like_sizes():
    family, keys = suffixes.Family(), np.arange(1, 1025, dtype=np.uint64)
    for k in range(64):
        family.add(keys[k * 16 : k * 16 + 16], np.arange(k * 16, k * 16 + 16))
        assert len(family.levels) <= 8
    hit, entries = family.scan(np.array([1, 500, 5000], np.uint64))
    assert hit.tolist() == [True, True, False]
    assert sorted(entries.tolist()) == [0, 499]
