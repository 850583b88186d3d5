"""Benchmark decontamination: normalised n-grams of the items, scanned for in every document."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.llm import texts
from skyweave.llm.rows import written

WINDOW = 10

# Item text that one pass holds; more items take further passes over the documents.
PART_BYTES = 32 << 20

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

RESULT = "struct<n_words:bigint,hits:array<struct<start:int,end:int>>,bytes:array<struct<start:int,end:int>>,items:array<bigint>>"


def normal_words(text: str | None) -> list[str]:
    """Words of letters and digits, A to Z lower-cased; null has none."""
    return WORD.findall((text or "").translate(_LOWER))


class Windows:
    """The windows of some items: sorted hashes for each length, and the words behind each hash."""

    def __init__(self, items: list[tuple[int | None, str | None]], length: int):
        found: dict[tuple[str, ...], set[int]] = defaultdict(set)
        for item, text in items:
            words = normal_words(text)
            for i in range(max(1, len(words) - length + 1) if words else 0):
                found[tuple(words[i : i + length])].update(() if item is None else (item,))
        self.hashes: dict[int, np.ndarray] = {}
        self.behind: dict[tuple[int, int], list[tuple[tuple[bytes, ...], list[int]]]] = defaultdict(list)
        by_length = defaultdict(list)
        for window, of in found.items():
            by_length[len(window)].append((window, sorted(of)))
        for n, all_windows in by_length.items():
            column = pa.array([" ".join(w) for w, _ in all_windows])
            data, offsets = texts.buffers(column)
            _, _, row, hashes = texts.word_hashes(data, offsets, texts.LETTERED)
            _, joined = texts.windows(hashes, row, n)
            self.hashes[n] = np.unique(joined)
            for h, (window, of) in zip(joined.tolist(), all_windows, strict=True):
                self.behind[n, h].append((tuple(w.encode() for w in window), of))

    def scan(self, column: pa.Array, earlier: list[dict] | None = None) -> Iterator[dict]:
        """Words, hit word runs, their byte runs and items of each text, with what ``earlier`` scans found there."""
        lowered, _ = texts.LETTERED
        for first_row, end_row, data, offsets in texts.slices(column):
            starts, ends, row, hashes = texts.word_hashes(data, offsets, texts.LETTERED)
            low = lowered[data].tobytes()
            bounds = np.searchsorted(row, np.arange(end_row - first_row + 1))
            hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
            items: dict[int, set[int]] = defaultdict(set)
            for n, known in self.hashes.items():
                at, joined = texts.windows(hashes, row, n)
                place = np.minimum(np.searchsorted(known, joined), len(known) - 1)
                for k in np.flatnonzero(known[place] == joined).tolist():
                    i = int(at[k])
                    run = tuple(low[starts[j] : ends[j]] for j in range(i, i + n))
                    for window, of in self.behind[n, int(joined[k])]:
                        if window == run:
                            hits[int(row[i])].append((i, i + n))
                            items[int(row[i])].update(of)
            for r in range(end_row - first_row):
                base = int(bounds[r])
                if earlier is not None:
                    before = earlier[first_row + r]
                    hits[r] += [(h["start"] + base, h["end"] + base) for h in before["hits"]]
                    items[r].update(before["items"])
                merged = union(hits.get(r, ()))
                yield {
                    "n_words": int(bounds[r + 1]) - base,
                    "hits": [{"start": a - base, "end": b - base} for a, b in merged],
                    "bytes": [{"start": int(starts[a] - offsets[r]), "end": int(ends[b - 1] - offsets[r])} for a, b in merged],
                    "items": sorted(items.get(r, ())),
                }


def union(spans) -> list[tuple[int, int]]:
    """Sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, out: str = "contamination", part_bytes: int = PART_BYTES, keep: list[str] | None = None,
) -> DataFrame:
    """Attach the struct ``out``: ``n_words``, word runs ``hits``, byte runs ``bytes`` and ``items``.

    A window is ``window`` consecutive words of an item, or all of a shorter one; a document's word
    in any occurrence of a window is hit. ``bytes`` counts UTF-8 bytes from the first to the last
    word of a run. Items are sent to all tasks in parts of at most ``part_bytes`` of text. Each part is
    one pass over the rows, without a shuffle; between two passes rows and hits are written to the shared
    folder, so the driver and the tasks hold the windows of one part at a time.

    Null and empty texts have no words and no hits, such items no windows; items with a null id mark
    words like all others, but ``items`` cannot name them. Equal items are all named. Rows stay as they are, repeated or not; a column
    named like ``out`` is replaced. ``keep`` names the columns to return, by default all.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != out]
    packed = docs.select(
        F.struct(F.lit(1).alias("_row"), *[F.col(f"`{c}`") for c in kept if c != text]).alias("_in"),
        F.col(f"`{text}`").alias("_text"),
    )
    windowed = benchmark.select(F.col(f"`{item}`").cast("long").alias("_item"), F.col(f"`{item_text}`").alias("_words"))
    parts = _parts(windowed.where(F.col("_words").isNotNull()), part_bytes)
    found, part = T.StructField("_found", T._parse_datatype_string(RESULT)), next(parts, [])
    while part is not None:
        following = next(parts, None)
        drop = following is None and text not in kept  # the last pass returns the text only if it is kept
        fields = [f for f in packed.schema.fields if f.name != "_found" and not (drop and f.name == "_text")]
        shared = docs.sparkSession.sparkContext.broadcast(part)
        packed = packed.mapInArrow(_scanner(shared, window, drop), T.StructType([*fields, found]))
        if following is not None:
            packed = written(packed, "contamination")
            shared.unpersist()
        part = following
    columns = [F.col("_text").alias(c) if c == text else F.col(f"_in.`{c}`") for c in kept]
    return packed.select(*columns, F.col("_found").alias(out))


def _parts(items: DataFrame, part_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """All items in lists of at most ``part_bytes`` of text (a longer item alone), read one by one."""
    part, size = [], 0
    for row in items.toLocalIterator():
        length = len(row[1].encode())
        if part and size + length > part_bytes:
            yield part
            part, size = [], 0
        part.append((row[0], row[1]))
        size += length
    if part:
        yield part


def _scanner(shared, window: int, drop_text: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Windows(shared.value, window)
        run = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        kind = pa.struct([("n_words", pa.int64()), ("hits", run), ("bytes", run), ("items", pa.list_(pa.int64()))])
        for batch in batches:
            earlier = batch.column("_found").to_pylist() if "_found" in batch.schema.names else None
            found = pa.array(list(known.scan(batch.column("_text"), earlier)), kind)
            gone = ("_found", "_text") if drop_text else ("_found",)
            rest = batch.select([n for n in batch.schema.names if n not in gone])
            yield pa.RecordBatch.from_arrays([*rest.columns, found], [*rest.schema.names, "_found"])

    return scan


def remove_spans(text: str | None, spans) -> str | None:
    """The text without these byte runs."""
    if text is None or len(spans) == 0:
        return text
    data, out, at = text.encode(), [], 0
    for span in spans:
        out.append(data[at : span["start"]])
        at = span["end"]
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "documents", **settings) -> DataFrame:
    """``docs`` without what the benchmark contains: whole ``documents``, or only the hit ``spans``."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    found = find_contamination(docs, benchmark, text, out="_contamination", **settings)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if remove == "documents":
        return found.where(F.size("_contamination.hits") == 0).select(*columns)
    cut = F.pandas_udf(lambda t, s: t.combine(s, remove_spans), "string")
    cleaned = F.when(F.size("_contamination.hits") > 0, cut(F.col(f"`{text}`"), F.col("_contamination.bytes")))
    return found.select(*[cleaned.otherwise(F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
