"""Removal of byte runs that earlier documents hold, by a logarithmic family of suffix arrays.

The suffix arrays are sparse. Of every ``MATCH`` bytes, the position whose next ``SEED`` bytes hash
lowest is an anchor; equal strings of ``MATCH`` bytes have their anchor at the same place, so any
match is found through suffixes that start at anchors, about one position in fourteen.

1. Each chunk of documents sends the anchors' distinct suffixes, as sorted hashes of their first
   ``SEED`` bytes, to buckets. A bucket scans each chunk's suffixes against its family of sorted
   levels, adds them as a new level and merges levels of about equal size. It returns two bits for
   each suffix: whether another document has its seed, and whether the seed is crowded.
2. Only around such anchors are the strings themselves compared, again by bucket: each string whose
   equal starts in a document with a smaller id is covered. The strings of a crowded seed are first
   reduced to distinct ones in their chunk, and spread over all buckets by their own hashes.
3. The covered runs return to their chunk, which cuts them out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm import texts
from skyweave.runtime import materialize

MATCH = 50
SEED = 24

# Text that a task packs at a time, and that it hashes at a time.
CHUNK_BYTES = 16 << 20
SLICE_BYTES = 1 << 20

# A seed at more anchors than this is crowded: its strings do not meet in one task.
CROWDED = 1 << 15

_LAST = np.iinfo(np.int64).max

_ROWS = "bucket int, chunk long, kind int, a binary, b binary, c binary, d binary"
_NAMES = ["bucket", "chunk", "kind", "a", "b", "c", "d"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
_SCHEMA = pa.schema(list(zip(_NAMES, _TYPES)))


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in _NAMES]
    return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES)], schema=_SCHEMA)


def _zip(array: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(array).tobytes(), 3)


def _unzip(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


class Family:
    """Sorted levels of distinct seeds; a new array is scanned against all, then levels of like size merge."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def scan(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each sorted key is in some level, entries that the levels have under these keys)."""
        found, entries = np.zeros(len(keys), bool), []
        for level, of in self.levels:
            place = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            hit = level[place] == keys
            found |= hit
            entries.append(of[place[hit]])
        return found, np.concatenate(entries) if entries else np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, entries: np.ndarray) -> None:
        if not len(keys):
            return
        self.levels.append((keys, entries))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (k, e), (l, f) = self.levels.pop(), self.levels.pop()
            keys, entries = np.concatenate([l, k]), np.concatenate([f, e])
            order = np.argsort(keys, kind="stable")  # two sorted runs: a merge
            keys, entries = keys[order], entries[order]
            first = np.r_[True, keys[1:] != keys[:-1]]
            self.levels.append((keys[first], entries[first]))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, first string start, number of string starts) of the anchors of some texts, in order."""
    none = np.zeros(0, np.int64)
    if len(data) < MATCH:
        return none.astype(np.uint64), none, none, none
    sums = texts.prefix_sums(data.astype(np.uint64) + np.uint64(1))
    n = len(data) - SEED + 1
    seeds = texts.mixed((sums[SEED:] - sums[:-SEED]) * texts.powers(len(data) + 1, inverse=True)[:n])
    ranked = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    least = _sliding_least(ranked, MATCH - SEED + 1) & np.uint64(0xFFFFFFFF)
    lengths = np.diff(offsets)
    valid = np.ones(len(least), bool)  # strings within one text
    ends = np.zeros(len(data) + 1, np.int64)
    tails = np.minimum(lengths, MATCH - 1)
    np.add.at(ends, offsets[1:] - tails, 1)
    np.add.at(ends, offsets[1:], -1)
    valid &= np.cumsum(ends)[: len(least)] == 0
    starts = np.flatnonzero(valid)
    if not len(starts):
        return none.astype(np.uint64), none, none, none
    at = least[starts]
    new = np.r_[True, at[1:] != at[:-1]]
    first = np.flatnonzero(new)
    key = texts.mixed(seeds[at[first].astype(np.int64)] * np.uint64(0x9FB21C651E98DF25) + np.uint64(1))
    low = starts[first]
    return key, np.searchsorted(offsets, low, "right") - 1, low, np.diff(np.r_[first, len(starts)])


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(name, ids, bytes, offsets) of runs of texts of about ``chunk_bytes``; a null id counts as the last."""
    for batch in batches:
        ids = batch.column("doc_id").cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
        for first, end, data, offsets in texts.slices(batch.column("text"), chunk_bytes):
            mine = ids[first:end].astype("<i8")
            name = hashlib.blake2b(mine.tobytes() + offsets.tobytes(), digest_size=8)
            name.update(data)
            yield int.from_bytes(name.digest(), "little", signed=True), mine, data, offsets


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


_LOW = np.uint64((1 << 48) - 1)


def _chunk_anchors(data: np.ndarray, offsets: np.ndarray, n_buckets: int):
    """Anchors of a chunk, slice by slice, ordered by seed: (seed, row, start in the chunk, starts, first, cuts).

    A seed is its bucket and 48 bits of its hash. ``first`` has the first anchor of each distinct
    seed, ``cuts`` the first distinct seed of each bucket.
    """
    found, row = [], 0
    while row < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(len(offsets) - 1, max(row + 1, end))
        key, rows, low, count = anchors(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        found.append((key, rows + row, low + offsets[row], count))
        row = end
    key, rows, low, count = (np.concatenate(c) for c in zip(*found))
    seed = ((key & np.uint64(0xFFFF)) % np.uint64(n_buckets) << np.uint64(48)) | (key >> np.uint64(16))
    order = np.argsort(seed, kind="stable")
    seed = seed[order]
    first = _starts(seed)
    cuts = np.searchsorted(seed[first] >> np.uint64(48), np.arange(n_buckets + 1).astype(np.uint64))
    return seed, rows[order], low[order], count[order], first, cuts


def _digests(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:])]


def _send_seeds(n_buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text in (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(len(batch))):
            chunk, (data, offsets, ids) = text["chunk"], _read_text(text)
            seed, row, _, _, first, cuts = _chunk_anchors(data, offsets, n_buckets)
            rows = []
            if len(first):
                several = np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)
                often = np.diff(np.r_[first, len(seed)]).astype("<u4")
                short = np.ascontiguousarray((seed[first] & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                mine = slice(cuts[b], cuts[b + 1])
                rows.append((b, chunk, 0, short[mine].tobytes(), np.packbits(several[mine]).tobytes(), _zip(often[mine]), None))
            digests = _digests(data, offsets)
            where = np.array([int.from_bytes(d[:2], "little") % n_buckets for d in digests])
            for b in np.unique(where).tolist():
                own = np.flatnonzero(where == b)
                joined = b"".join(digests[i] for i in own)
                rows.append((b, chunk, 1, joined, own.astype("<u4").tobytes(), ids[own].tobytes(), None))
            yield from _table(rows).to_batches()

    return send


def _mark(crowded: int):
    return lambda table: _marks(table, crowded)


def _marks(table: pa.Table, crowded: int) -> pa.Table:
    """Of one bucket: for each chunk, which seeds another document has and which are crowded, and which texts are copies."""
    rows = table.to_pylist()
    family, marks, at, out = Family(), [], 0, []
    for r in rows:
        if r["kind"]:
            continue
        raw = np.frombuffer(r["a"], np.uint8).reshape(-1, 6)
        keys = np.zeros((len(raw), 8), np.uint8)
        keys[:, :6] = raw
        keys = keys.reshape(-1).view("<u8")
        found, entries = family.scan(keys)
        found |= np.unpackbits(np.frombuffer(r["b"], np.uint8), count=len(keys)).astype(bool)
        marks.append((r, at, found, entries, keys, _unzip(r["c"], "<u4")))
        family.add(keys, np.arange(at, at + len(keys)))
        at += len(keys)
    every = np.zeros(at, bool)
    for _, begin, found, entries, *_ in marks:
        every[begin : begin + len(found)] |= found
        every[entries] = True
    full = np.zeros(0, np.uint64)
    if marks and sum(int(m[5].sum()) for m in marks) > crowded:
        shared = np.concatenate([m[4] for m in marks])[every]
        often = np.concatenate([m[5] for m in marks])[every].astype(np.int64)
        if len(shared):
            order = np.argsort(shared, kind="stable")
            shared, often = shared[order], often[order]
            first_of = _starts(shared)
            full = shared[first_of][np.add.reduceat(often, first_of) > crowded]
    for r, begin, found, _, keys, _ in marks:
        marked = every[begin : begin + len(found)]
        at_full = np.isin(keys, full) if len(full) else np.zeros(len(keys), bool)
        out.append((r["bucket"], r["chunk"], 0, np.packbits(marked).tobytes(), np.packbits(at_full).tobytes(), None, None))
    first: dict[bytes, int] = {}
    copies = [r for r in rows if r["kind"]]
    for r in copies:
        for i, doc in enumerate(np.frombuffer(r["c"], "<i8").tolist()):
            digest = r["a"][i * 16 : i * 16 + 16]
            first[digest] = min(doc, first.get(digest, doc))
    for r in copies:
        docs, own = np.frombuffer(r["c"], "<i8"), np.frombuffer(r["b"], "<u4")
        later = [doc > first[r["a"][i * 16 : i * 16 + 16]] for i, doc in enumerate(docs.tolist())]
        out.append((r["bucket"], r["chunk"], 1, own[np.array(later, bool)].tobytes(), None, None, None))
    return _table(out)


def _send_texts(chunk_bytes: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, data, offsets in _chunks(batches, chunk_bytes):
            yield from _table([(0, chunk, 2, zstandard.compress(data, 3), _zip(offsets.astype("<i8")), ids.tobytes(), None)]).to_batches()

    return send


def _read_text(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _unzip(row["a"], np.uint8), _unzip(row["b"], "<i8"), np.frombuffer(row["c"], "<i8")


def _check_replies(texts_of: list[dict], replies: list[dict]) -> None:
    """Every chunk has documents, so their copies are answered; without an answer repeats would be lost."""
    if not texts_of or not any(r["kind"] == 1 for r in replies):
        raise ValueError("a chunk of texts and its replies do not meet")


def _send_strings(n_buckets: int):
    """Of one chunk: the bytes around marked anchors of texts that are not copies."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = right.to_pylist()
        bits = {r["bucket"]: (r["a"], r["b"]) for r in replies if r["kind"] == 0}
        copies = np.concatenate([np.zeros(0, "<u4"), *[np.frombuffer(r["a"], "<u4") for r in replies if r["kind"] == 1]])
        rows, mine_texts = [], left.to_pylist()
        _check_replies(mine_texts, replies)
        for text in mine_texts:
            data, offsets, ids = _read_text(text)
            seed, row, low, count, first, cuts = _chunk_anchors(data, offsets, n_buckets)
            ends_of = np.r_[first, len(seed)]
            is_copy = np.zeros(len(offsets) - 1, bool)
            is_copy[copies] = True
            spread = _Spread(text["chunk"], n_buckets)
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                if b not in bits:
                    raise ValueError("a chunk of texts and its replies do not meet")
                distinct = int(cuts[b + 1] - cuts[b])
                marked, full = (np.unpackbits(np.frombuffer(x, np.uint8), count=distinct).astype(bool) for x in bits[b])
                places = ends_of[cuts[b] : cuts[b + 1] + 1]
                mine = np.flatnonzero(np.repeat(marked, np.diff(places))) + places[0]
                mine = mine[~is_copy[row[mine]]]
                if full.any():
                    at_full = np.repeat(full, np.diff(places))[mine - places[0]]
                    spread.add(data, low[mine[at_full]], count[mine[at_full]], ids[row[mine[at_full]]])
                    mine = mine[~at_full]
                if not len(mine):
                    continue
                lengths = count[mine] + MATCH - 1
                ends = np.cumsum(lengths)
                index = np.arange(ends[-1]) + np.repeat(low[mine] - (ends - lengths), lengths)
                rows.append((
                    b, text["chunk"], 0, _zip(data[index]), _zip(lengths.astype("<u4")),
                    _zip(np.diff(ids[row[mine]], prepend=0).astype("<i8")), _zip(np.diff(low[mine], prepend=0).astype("<i4")),
                ))
            rows += spread.rows()
        return _table(rows)

    return send


class _Spread:
    """Distinct strings of crowded seeds of one chunk, on their way to the buckets of their hashes.

    A string goes once, with its smallest id and the places where this id has it. At its other places
    in the chunk it is covered already.
    """

    def __init__(self, chunk: int, n_buckets: int):
        self.chunk, self.n_buckets = chunk, n_buckets
        self.covered, self.parts, self.size, self.out = [], [], 0, []

    def add(self, data: np.ndarray, low: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        """All strings of some seeds; the equal strings of a chunk are in one call."""
        one, other, places, docs = [], [], [], []
        step = max(1, SLICE_BYTES // (2 * MATCH))
        for at in range(0, len(low), step):
            some = slice(at, at + step)
            lengths = count[some] + MATCH - 1
            ends, total = np.cumsum(lengths), np.cumsum(count[some])
            window = data[np.arange(ends[-1]) + np.repeat(low[some] - (ends - lengths), lengths)]
            inside = np.arange(total[-1]) - np.repeat(total - count[some], count[some])
            starts = inside + np.repeat(ends - lengths, count[some])
            one.append(_string_hashes(window.astype(np.uint64) + np.uint64(1), starts))
            other.append(_string_hashes(_second(window), starts))
            places.append(inside + np.repeat(low[some], count[some]))
            docs.append(np.repeat(ids[some], count[some]))
        if not one:
            return
        h, g, place, doc = (np.concatenate(c) for c in (one, other, places, docs))
        order = np.lexsort((place, doc, g, h))
        h, g, place, doc = h[order], g[order], place[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        first = np.flatnonzero(new)
        later = doc > np.repeat(doc[first], np.diff(np.r_[first, len(h)]))
        if later.any():
            self.covered.append(np.sort(place[later]).astype("<u4"))
        kept = np.add.reduceat((~later).astype(np.int64), first)
        self.parts.append((h[first], g[first], doc[first], kept.astype("<u4"), place[~later].astype("<u4")))
        self.size += len(first)
        if self.size > SLICE_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.parts:
            h, g, doc, kept, place = (np.concatenate(c) for c in zip(*self.parts))
            bucket = (h >> np.uint64(32)) % np.uint64(self.n_buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(self.n_buckets + 1).astype(np.uint64))
            ends = np.cumsum(kept, dtype=np.int64)
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                mine = order[cuts[b] : cuts[b + 1]]
                many = kept[mine].astype(np.int64)
                inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                at = place[inside + np.repeat(ends[mine] - many, many)]
                self.out.append((
                    b, self.chunk, 4, h[mine].astype("<u8").tobytes() + g[mine].astype("<u8").tobytes(),
                    _zip(doc[mine].astype("<i8")), _zip(kept[mine]), at.tobytes(),
                ))
        self.parts, self.size = [], 0

    def rows(self) -> list[tuple]:
        self._flush()
        if self.covered:
            self.out.append((0, *_run_row(self.chunk, np.concatenate(self.covered))))
        return self.out


def _run_row(chunk: int, places: np.ndarray) -> tuple:
    """The byte runs made of the strings that start at some places, for their chunk."""
    places = np.unique(places.astype(np.int64))
    new = np.ones(len(places), bool)
    new[1:] = np.diff(places) != 1
    begin = places[new]
    end = places[np.r_[new[1:], True]] + MATCH
    return chunk, 3, _zip(begin.astype("<u4")), _zip((end - begin).astype("<u4")), None, None


def _second(data: np.ndarray) -> np.ndarray:
    """Values of bytes for an independent hash."""
    return _OTHER[data]


_OTHER = texts.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _cover(table: pa.Table) -> pa.Table:
    """Of one bucket: byte runs of each chunk made of strings that a smaller id has too.

    The equal strings of a crowded seed come from all chunks as hashes (kind 4), all others as the
    bytes around their anchor (kind 0); runs that a chunk found itself (kind 3) pass.
    """
    every = table.to_pylist()
    out = [tuple(r[c] for c in _NAMES) for r in every if r["kind"] == 3]
    rows = [r for r in every if r["kind"] != 3]
    if not rows:
        return _table(out)
    one, other, doc, size = [], [], [], []
    for r in rows:
        if r["kind"] == 4:
            h, g = np.frombuffer(r["a"], "<u8").reshape(2, -1)
            one.append(h)
            other.append(g)
            doc.append(_unzip(r["b"], "<i8"))
            size.append(np.ones(len(h), np.int64))
            continue
        data, lengths = _unzip(r["a"], np.uint8), _unzip(r["b"], "<u4").astype(np.int64)
        ids = np.cumsum(_unzip(r["c"], "<i8"))
        ends = np.cumsum(lengths)
        counts = lengths - (MATCH - 1)
        total = np.cumsum(counts)
        starts = np.arange(total[-1]) + np.repeat(ends - lengths - (total - counts), counts)
        for values, hashes in ((data.astype(np.uint64) + np.uint64(1), one), (_second(data), other)):
            hashes.append(_string_hashes(values, starts))
        doc.append(np.repeat(ids, counts))
        size.append(counts)
    h, g, doc = np.concatenate(one), np.concatenate(other), np.concatenate(doc)
    order = np.argsort(h)
    if np.any((h[order][1:] == h[order][:-1]) & (g[order][1:] != g[order][:-1])):
        order = np.lexsort((g, h))
    h, g = h[order], g[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
    least = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.r_[first, len(h)]))
    covered = np.zeros(len(h), bool)
    covered[order] = doc[order] > least
    at = 0
    for r, counts in zip(rows, size):
        n = int(counts.sum())
        mine = covered[at : at + n]
        at += n
        if mine.any():
            if r["kind"] == 4:
                places = np.frombuffer(r["d"], "<u4")[np.repeat(mine, _unzip(r["c"], "<u4"))]
            else:
                low = np.repeat(np.cumsum(_unzip(r["d"], "<i4").astype(np.int64)), counts)
                inside = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
                places = (low + inside)[mine]  # where covered strings start in the chunk
            out.append((r["bucket"], *_run_row(r["chunk"], places)))
    return _table(out)


def _string_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of ``MATCH`` values from each start, over slices of bounded size."""
    out = np.empty(len(starts), np.uint64)
    step = SLICE_BYTES
    for begin in range(0, len(values), step):
        a, b = np.searchsorted(starts, [begin, begin + step])
        if a < b:
            part = values[begin : begin + step + MATCH]
            sums = texts.prefix_sums(part)
            at = starts[a:b] - begin
            out[a:b] = texts.mixed((sums[at + MATCH] - sums[at]) * texts.powers(len(sums), inverse=True)[at])
    return out


_RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _cut(keep_text: bool):
    """Of one chunk: the documents with their removed runs; ``kept`` is the rest or its SHA-256."""
    run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", run), ("kept", pa.binary())])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = right.to_pylist()
        begins = np.concatenate([np.zeros(0, "<u4"), *[_unzip(r["a"], "<u4") for r in replies if r["kind"] == 3]]).astype(np.int64)
        sizes = np.concatenate([np.zeros(0, "<u4"), *[_unzip(r["b"], "<u4") for r in replies if r["kind"] == 3]]).astype(np.int64)
        copies = np.concatenate([np.zeros(0, "<u4"), *[np.frombuffer(r["a"], "<u4") for r in replies if r["kind"] == 1]])
        out, mine_texts = [], left.to_pylist()
        _check_replies(mine_texts, replies)
        for text in mine_texts:
            data, offsets, ids = _read_text(text)
            whole = [c for c in copies.tolist() if offsets[c + 1] - offsets[c] >= MATCH]
            change = np.zeros(len(data) + 1, np.int32)
            np.add.at(change, np.r_[begins, offsets[whole]], 1)
            np.add.at(change, np.r_[begins + sizes, offsets[np.array(whole, np.int64) + 1] if whole else []].astype(np.int64), -1)
            gone = np.cumsum(change)[: len(data)] > 0
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                mine = gone[a:b]
                edges = np.flatnonzero(np.diff(np.r_[False, mine, False].astype(np.int8)))
                spans = [{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2])]
                rest = data[a:b][~mine].tobytes()
                doc = int(ids[i])
                out.append((
                    None if doc == _LAST else doc, b - a, int(mine.sum()), spans,
                    rest if keep_text else hashlib.sha256(rest).digest(),
                ))
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return cut


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False, chunk_bytes: int = CHUNK_BYTES,
    n_buckets: int | None = None, crowded: int = CROWDED,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``spans``, ``kept`` of every row.

    A byte of the UTF-8 text goes if some ``MATCH`` bytes around it also stand, from any place, in a
    row with a smaller id; strings are those of the input, whatever is removed elsewhere. ``spans``
    are the maximal removed byte runs. ``kept`` is the SHA-256 of the remaining bytes, or with
    ``keep_text`` the bytes themselves, which a cut may leave with parts of a character.

    Null texts are empty. Rows of one id do not count against each other; a null id is larger than
    all others. Copies are found by their whole text first, so a group of copies is compared once.
    The strings around a seed that stands at more than ``crowded`` anchors are spread over all buckets.
    Other columns are not read. The rows are read once: packed in named chunks they are written to
    the shared folder, and all steps read them there.
    """
    spark = docs.sparkSession
    n_buckets = n_buckets or min(0xFFFF, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    narrow = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Written once: a second scan could cut or order the rows in another way and name other chunks.
    packed = materialize(narrow.mapInArrow(_send_texts(chunk_bytes), _ROWS))
    seeds = packed.mapInArrow(_send_seeds(n_buckets), _ROWS)
    marks = materialize(seeds.groupBy("bucket").applyInArrow(_mark(crowded), _ROWS))
    strings = packed.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(_send_strings(n_buckets), _ROWS)
    covered = materialize(strings.groupBy("bucket").applyInArrow(_cover, _ROWS))
    replies = covered.union(marks.where("kind = 1"))
    return packed.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_cut(keep_text), _RESULT)
