"""Words and hashes of a column of texts, computed on the bytes of an Arrow column.

Texts stay one byte buffer with offsets; numpy marks word bytes, and polynomial prefix sums modulo
2^64 give the hash of any byte or word run by one subtraction. Work goes in slices of a MB, so
memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)


def byte_table(is_word) -> tuple[np.ndarray, np.ndarray]:
    """(bytes with A to Z lower-cased, whether a byte belongs to a word)."""
    lowered = np.arange(256, dtype=np.uint8)
    lowered[65:91] += 32
    return lowered, np.array([bool(is_word(int(b))) for b in lowered])


# Words between ASCII white space; words of ASCII letters, digits and all beyond ASCII.
SPACED = byte_table(lambda b: b not in (9, 10, 11, 12, 13, 32))
LETTERED = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about ``most`` bytes, one row at least."""
    data, offsets = buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(rows, max(row + 1, end))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def packed(array: np.ndarray) -> bytes:
    """The array's bytes, compressed."""
    return zstandard.compress(np.ascontiguousarray(array).tobytes(), 3)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(33))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX_2
    return h ^ (h >> np.uint64(32))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base or of its inverse."""
    name = "inverse" if inverse else "base"
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        factors = np.full(size, _INVERSE if inverse else _BASE, np.uint64)
        factors[0] = 1
        have = np.cumprod(factors, dtype=np.uint64)
        if size <= 2 * SLICE_BYTES:
            _POWERS[name] = have
    return have[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of the base; the run i … j has hash (sums[j] - sums[i]) / base^i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), dtype=np.uint64, out=out[1:])
    return out


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs [start, end), which do not depend on where the run stands."""
    lengths = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts] + lengths)


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of all words; a word never goes beyond its row."""
    inside = is_word[data]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row, hash) of all words, A to Z lower-cased."""
    lowered, is_word = table
    starts, ends, row = word_spans(data, offsets, is_word)
    sums = prefix_sums(lowered[data].astype(np.uint64) + np.uint64(1))
    return starts, ends, row, run_hashes(sums, starts, ends)


def windows(hashes: np.ndarray, row: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of all runs of ``length`` words within one row."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(row[:n] == row[length - 1 :])
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total *= _BASE
        total += hashes[k : k + n]
    return first, mixed(total[first])
