"""Vectorised views of Arrow text columns: byte slices, word spans, hashes.

Texts travel as Arrow batches; a batch is cut into slices of about ``limit`` bytes (a longer text is a slice of
its own), so that the arrays made from a slice stay small however many rows a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# An odd base with base % 8 == 3, so that differences of its powers have few even factors.
_BASE = 0x9E3779B97F4A7C13
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Slice:
    """Rows ``first`` to ``first + len(offsets) - 1`` of a batch: their bytes, one after the other."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and 64-bit offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    raw, at = text_buffers(column)
    first, rows = 0, len(column)
    while first < rows:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield Slice(first, raw[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span, from one running sum over the slice."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[:-1], out=sums[1:])
    spans = (sums[ends] - sums[starts]) * down[starts]
    return mixed(spans ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def spans_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``mask`` holds; no run crosses a row."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    inner = offsets[1:-1]
    before[inner[inner < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    after[inner[inner > 0] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def word_hashes(part: Slice, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without ASCII white space) and, per row, the bounds of its words."""
    data = LOWER[part.data] if lower else part.data
    starts, ends = spans_of(~SPACE[data], part.offsets)
    return span_hashes(data, starts, ends), np.searchsorted(starts, part.offsets)


def padded(part: Slice, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slice's bytes through a 256-entry ``table``, with two blanks around every row, and the rows' new bounds."""
    rows = np.repeat(np.arange(part.rows), np.diff(part.offsets))
    out = np.full(len(part.data) + 2 * (part.rows + 1), 0x20, np.uint8)
    out[np.arange(len(part.data)) + 2 * (rows + 1)] = table[part.data]
    return out, part.offsets + 2 * np.arange(1, part.rows + 2)


def grams(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All ``n``-byte windows (n from 2 to 8) as numbers, without those that hold two blanks in a row; bounds per row.

    data and bounds as from :func:`padded`; because of the blanks between rows no window crosses a row.
    """
    size = len(data) - n + 1
    blank = data == 0x20
    double = blank[:-1] & blank[1:]
    ok = np.ones(size, bool)
    codes = np.zeros(size, np.uint64)
    for k in range(n):
        codes |= data[k : k + size].astype(np.uint64) << np.uint64(8 * k)
        if k < n - 1:
            ok &= ~double[k : k + size]
    at = np.flatnonzero(ok)
    return codes[at], np.searchsorted(at, bounds - 1)


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of many spans, one after the other."""
    kind = np.int32 if len(data) < 1 << 31 and lengths.sum() < 1 << 31 else np.int64
    ends = np.cumsum(lengths)
    at = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    at += np.arange(len(at), dtype=kind)
    return data[at]


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 64-bit keys in the order they first appear: the place of the first of each distinct key, and the number of every key."""
    numbers = pa.array(keys.view(np.int64)).dictionary_encode().indices.to_numpy().astype(np.int64)
    return np.flatnonzero(np.diff(np.maximum.accumulate(numbers), prepend=-1)), numbers


def span_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers byte spans so that equal numbers mean equal bytes: the number of each span, a span per number, hashes per number.

    Spans are numbered by hash and then compared, byte by byte, with the span that stands for their number.
    """
    hashes = span_hashes(data, starts, ends)
    first, numbers = ranked(hashes)
    lengths, named = ends - starts, first[numbers]
    other = np.flatnonzero(named != np.arange(len(starts)))
    same = np.array_equal(lengths[other], lengths[named[other]]) and np.array_equal(
        gathered(data, starts[other], lengths[other]), gathered(data, starts[named[other]], lengths[other])
    )
    if same:
        return numbers, first, hashes[first]
    raw, known = data.tobytes(), {}
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    numbers = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    _, first = np.unique(numbers, return_index=True)
    return numbers, first, hashes[first]


def joined_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One string per group ``bounds[k]`` to ``bounds[k + 1]`` of consecutive spans: the spans, joined by one blank."""
    lengths = ends - starts + 1
    out = gathered(np.append(data, np.uint8(0x20)), starts, lengths)
    stops = np.concatenate(([0], np.cumsum(lengths)))
    out[stops[1:] - 1] = 0x20
    filled = bounds[1:] > bounds[:-1]
    keep = np.ones(len(out), bool)
    keep[stops[bounds[1:][filled]] - 1] = False
    offsets = np.concatenate(([0], np.cumsum(stops[bounds[1:]] - stops[bounds[:-1]] - filled)))
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[keep])]
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers)
