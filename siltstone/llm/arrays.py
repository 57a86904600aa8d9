"""Words of Arrow text columns as numpy arrays, without a Python object per word.

Words are maximal runs of bytes other than 0x20 and 0x09 to 0x0D. A word is known by a 64-bit hash of
its bytes: a polynomial over a table of random byte values, mixed at the end. Work is done in
segments of about SEGMENT bytes, so scratch memory does not depend on the length of a text (only a
single word or line longer than a segment needs room for itself).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SEGMENT = 1 << 20
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER_BYTES = _BYTES.copy()
_LOWER_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_kept: dict[str, np.ndarray] = {}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least `size` of each."""
    if len(_kept.get("up", ())) < size:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(size, SEGMENT + 1), base, np.uint64)
            steps[0] = 1
            _kept[name] = np.multiply.accumulate(steps)
    return _kept["up"], _kept["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xA0761D6478BD642F)
    values ^= values >> np.uint64(32)
    return values


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(mix(left) * np.uint64(0x9FB21C651E98DF25) + right)


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row begins and ends; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `size` bytes of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = raw(batch.column(batch.schema.get_field_index(text)))[1][1:]
        start = 0
        while start < batch.num_rows:
            reached = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, reached + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words, which hold no `blank` byte; a row's border always ends a word."""
    starts, ends = [], []
    for low in range(0, len(data), SEGMENT):
        high = min(low + SEGMENT, len(data))
        word = ~blank[data[low:high]]
        before = np.empty_like(word)
        before[0] = low > 0 and not blank[data[low - 1]]
        before[1:] = word[:-1]
        inside = offsets[(offsets >= low) & (offsets < high)] - low
        change = word != before
        start = change & word
        end = change & before
        start[inside] = word[inside]
        end[inside] = before[inside]
        starts.append(np.flatnonzero(start) + low)
        ends.append(np.flatnonzero(end) + low)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(data) and not blank[data[-1]]:
        ends.append(np.array([len(data)]))
    return np.concatenate(starts), np.concatenate(ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hashes of byte spans that follow each other without overlap."""
    table = _LOWER_BYTES if lower else _BYTES
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + SEGMENT, side="right")))
        high = ends[last - 1]
        up, down = powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[data[low:high]] * up[: high - low], out=sums[1:])
        here = starts[first:last] - low
        out[first:last] = (sums[ends[first:last] - low] - sums[here]) * down[here]
        first = last
    return mix(out)


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and bounds: words bounds[i] to bounds[i + 1] belong to row i."""
    data, offsets = raw(column)
    starts, ends = spans(data, offsets)
    return span_hashes(data, starts, ends, lower), np.searchsorted(starts, offsets)


def owners(bounds: np.ndarray) -> np.ndarray:
    """The row of every word, from bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between bounds."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def with_text(keep: list[str], text: str) -> list[str]:
    """The columns to hand to a worker: those to keep first, the text once."""
    return keep if text in keep else [*keep, text]


def out_schema(df: DataFrame, keep: list[str], added: str) -> str:
    """DDL of the columns kept and those added."""
    return ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), added])
