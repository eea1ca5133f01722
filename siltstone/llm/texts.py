"""Texts as bytes in NumPy: flat buffers, words, hashes of byte ranges. Runs inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# The bytes that part words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Bytes worked on at a time; a word is never cut, so a longer one makes a longer block.
BLOCK_BYTES = 1 << 19

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and the n + 1 offsets between them; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches bounded, as rows with whole texts go to Python.

    A lower bound that the session has already is kept.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get(_BATCH_ROWS))
    conf.set(_BATCH_ROWS, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
    return df


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, in slices of a few blocks each."""
    offsets = flat(texts)[1]
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + 2 * BLOCK_BYTES, side="right")) - 1
        end = max(end, start + 1)
        yield texts[start:end]
        start = end


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return _LOWER[data]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of an odd base modulo 2^64, and of its inverse."""
    if "p" not in _POWERS or len(_POWERS["p"]) <= n:
        size = max(n + 1, BLOCK_BYTES + 4096)
        for key, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["p"][: n + 1], _POWERS["i"][: n + 1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``range_hash`` takes the hash of any byte range."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][:-1], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end); equal bytes give equal hashes wherever they stand."""
    inverse = powers(len(sums) - 1)[1]
    length = (end - start).astype(np.uint64)
    return mixed((sums[end] - sums[start]) * inverse[start] + length * np.uint64(0x2545F4914F6CDD1D))


def blocks(data: np.ndarray, offsets: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int]]:
    """Cuts of the bytes at which no word is cut, about ``size`` or ``BLOCK_BYTES`` apart."""
    size = size or BLOCK_BYTES
    start, n = 0, len(data)
    while start < n:
        end = min(start + size, n)
        while end < n:
            step = min(end + 65536, n)
            gap = np.flatnonzero(_IS_SPACE[data[end:step]])
            bound = offsets[np.searchsorted(offsets, end)]
            cut = end + int(gap[0]) if len(gap) else step
            end = min(cut, int(bound))
            if len(gap) or end == bound:
                break
        yield start, end
        start = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, start: int, end: int
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, within the block, of the words in data[start:end]."""
    gap = _IS_SPACE[data[start:end]]
    edge = np.zeros(end - start + 1, dtype=bool)
    lo, hi = np.searchsorted(offsets, [start, end + 1])
    edge[offsets[lo:hi] - start] = True
    edge[0] = edge[-1] = True
    before = edge[:-1].copy()
    before[1:] |= gap[:-1]
    after = edge[1:].copy()
    after[:-1] |= gap[1:]
    return np.flatnonzero(before & ~gap), np.flatnonzero(after & ~gap) + 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number and hash of every word of every text, in order, A-Z lower-cased."""
    data, offsets = flat(texts)
    rows, hashes = [], []
    for start, end in blocks(data, offsets):
        first, last = word_spans(data, offsets, start, end)
        sums = prefix_sums(lowered(data[start:end]))
        hashes.append(range_hash(sums, first, last))
        rows.append(np.searchsorted(offsets, first + start, side="right") - 1)
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)
