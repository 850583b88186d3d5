"""License scans: MinHash bands over overlapping windows find templates, shingle containment verifies them."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm import texts
from skyweave.llm.decontaminate import normal_words

SHINGLE = 5
CONTAINMENT = 75  # per cent

# A window that holds a template goes unseen at most this often.
MISS = 1e-6

# Notices of common licenses.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    (
        "mit-permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("reserved", "All rights reserved."),
)


def bands_for(shingles: int, containment: int = CONTAINMENT, miss: float = MISS) -> int:
    """Bands of one MinHash each, so that a window which holds the template collides but for ``miss``.

    A window has at most twice the template's shingles; of those the template has at least the
    share ``containment``, which bounds the Jaccard similarity, the chance of one band, from below.
    """
    held = -(-shingles * containment // 100)
    similarity = held / (2 * shingles + shingles - held)
    return max(1, math.ceil(math.log(miss) / math.log(1 - similarity)))


class Templates:
    """Templates by shingle length and number of shingles, with their MinHash bands."""

    def __init__(self, templates: Sequence[tuple[str, str]], length: int, containment: int, miss: float):
        self.containment = containment
        self.groups: dict[tuple[int, int], list[tuple[str, dict[int, tuple[bytes, ...]]]]] = defaultdict(list)
        for name, text in templates:
            words = normal_words(text)
            if not words:
                continue
            k = min(length, len(words))
            data, offsets = texts.buffers(pa.array([" ".join(words)]))
            _, _, row, hashes = texts.word_hashes(data, offsets, texts.LETTERED)
            _, joined = texts.windows(hashes, row, k)
            shingles = {h: tuple(w.encode() for w in words[i : i + k]) for i, h in enumerate(joined.tolist())}
            self.groups[k, len(shingles)].append((name, shingles))
        self.bands = {}
        for (k, n), group in self.groups.items():
            factors = texts.mixed(np.arange(1, bands_for(n, containment, miss) + 1, dtype=np.uint64)) | np.uint64(1)
            least = np.array([[int((np.array(list(s), np.uint64) * f).min()) for _, s in group] for f in factors], np.uint64)
            self.bands[k, n] = factors, least

    def scan(self, column: pa.Array) -> Iterator[tuple[int, str, int, int, int]]:
        """(row, template, shingles held, shingles, first word of the window) for each window that holds one."""
        lowered, _ = texts.LETTERED
        for first_row, _, data, offsets in texts.slices(column):
            starts, ends, row, hashes = texts.word_hashes(data, offsets, texts.LETTERED)
            for (k, n), group in self.groups.items():
                at, shingles = texts.windows(hashes, row, k)
                if not len(at):
                    continue
                owner = row[at]
                # Blocks of n shingles from each text's first; a window is two blocks in a row.
                head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                sizes = np.diff(np.r_[head, len(owner)])
                per = -(-sizes // n)
                block = np.repeat(head, per) + n * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))
                of = owner[block]
                follows = np.r_[of[1:] == of[:-1], False]
                factors, least = self.bands[k, n]
                met = np.zeros((len(block), len(group)), bool)
                for factor, wanted in zip(factors, least):
                    lows = np.minimum.reduceat(shingles * factor, block)
                    both = np.where(follows, np.minimum(lows, np.r_[lows[1:], lows[-1:]]), lows)
                    for t in range(len(group)):
                        met[:, t] |= both == wanted[t]
                low = None
                for w, t in np.argwhere(met).tolist():
                    low = low or lowered[data].tobytes()
                    name, needed = group[t]
                    a = int(block[w])
                    b = min(int(block[w]) + 2 * n, len(owner))
                    held = set()
                    for i in range(a, b):
                        if owner[i] == of[w] and int(shingles[i]) in needed:
                            j = int(at[i])
                            if tuple(low[starts[x] : ends[x]] for x in range(j, j + k)) == needed[int(shingles[i])]:
                                held.add(int(shingles[i]))
                    if 100 * len(held) >= self.containment * n:
                        base = int(np.searchsorted(row, of[w]))
                        yield first_row + int(of[w]), name, len(held), n, int(at[a]) - base


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, key: str = "doc_id", text: str = "text",
    length: int = SHINGLE, containment: int = CONTAINMENT, miss: float = MISS,
) -> DataFrame:
    """``doc_id``, ``license``, ``shingles_held``, ``shingles``, ``first_word``: one row per match of a row.

    A text holds a template if a window of it holds at least ``containment`` per cent of the
    template's distinct ``length``-word shingles (words of letters and digits, A to Z lower-cased; a
    shorter template is one shingle). Windows overlap by half: each is two blocks in a row, of as
    many shingles as the template has, so a whole template always lies in one. Of the windows that
    hold a template, the row names the one that holds most, the first of equals.

    The scan is one pass without a shuffle; templates travel with the tasks and should be few.
    Empty and null texts hold nothing, repeated rows are reported each, null ids are kept. Other
    columns are not read.
    """
    templates = [(n, t) for n, t in templates if t]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, length, containment, miss)
        for batch in batches:
            best: dict[tuple[int, str], tuple[int, int, int]] = {}
            for r, name, held, n, word in known.scan(batch.column("text")):
                best[r, name] = max(best.get((r, name), (0, 0, 0)), (held, -word, n))
            found = sorted(best.items())
            ids = batch.column("doc_id").take(pa.array([r for (r, _), _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()), pa.array([n for (_, n), _ in found], pa.string()),
                    *[pa.array(c, pa.int64()) for c in ([v[0] for _, v in found], [v[2] for _, v in found], [-v[1] for _, v in found])],
                ],
                ["doc_id", "license", "shingles_held", "shingles", "first_word"],
            )

    narrow = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.mapInArrow(scan, "doc_id long, license string, shingles_held long, shingles long, first_word long")
