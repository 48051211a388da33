"""Words and word n-grams of Arrow text columns as numpy arrays of 64-bit hashes.

All texts of a slice lie in one byte buffer, so each step is one vectorised pass over
it. The character classes used here treat every byte above 0x7F alike, hence working
on UTF-8 bytes gives the words that working on code points would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 19
_STEP = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# words split at blanks: [^\x20\x09-\x0D]+
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 9, 10, 11, 12, 13]] = False
# words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span ``data[start:end]``, from one running sum over the buffer."""
    up, down = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, rows, bytes, offsets) of runs of rows of about ``most`` bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    buffers, n = column.buffers(), len(column)
    if not n:
        return
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to - at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    pa.default_memory_pool().release_unused()


class Words:
    """Word spans of the texts of a slice: start, end and row of each, in order."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.data, self.offsets = LOWER[data], offsets
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kind[self.data]
        text_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        before = inside[:-2].copy()
        before[text_starts] = False
        after = inside[2:].copy()
        after[text_starts[text_starts > 0] - 1] = False
        self.starts = np.flatnonzero(inside[1:-1] & ~before)
        self.ends = np.flatnonzero(inside[1:-1] & ~after) + 1
        # firsts[r] : firsts[r + 1] are the words of row r
        self.firsts = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.firsts)
        self.rows = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def gram_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k words from each position on; the last k - 1 positions have none."""
    n = max(0, len(words) - k + 1)
    total = np.full(n, seed + k, U64)
    for j in range(k):
        total = mix(total * U64(0xFF51AFD7ED558CCD) + words[j : j + n])
    return total


def within_rows(rows: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from each position on belong to one row."""
    n = max(0, len(rows) - k + 1)
    return rows[:n] == rows[k - 1 : k - 1 + n]


def whole_row_hashes(hashes: np.ndarray, words: Words, rows: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of all words of each of the given rows, of which each has few."""
    return np.array(
        [gram_hashes(hashes[words.firsts[r] : words.firsts[r + 1]], int(words.counts[r]), seed)[0] for r in rows], U64
    )
