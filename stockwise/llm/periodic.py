"""Periodic runs of words: stretches that repeat with a smallest period, found on sparse diagonals.

A cell (word, lag) matches if the word equals the one ``lag`` words before it; consecutive matches of one lag are a
diagonal, whose match length grows by one per word, and a diagonal that ends long enough is a run.  All pairs of equal words
would be quadratic for frequent words, so the diagonals are kept sparse: lags from k / 2 + 1 to k (k = 1, 2, 4, ...) are
followed on units of k consecutive words, and of the earlier occurrences of a unit only the nearest counts.  That loses
nothing: inside a run of smallest period q <= k a unit of k words recurs at multiples of q only (periodicity lemma).  Units of 2k
words are pairs of units of k words, and only units that occur twice in their text go on to the next size, so
ordinary prose is left behind after a few words.  Work is n log n whatever the text; nothing but one slice is held.

Words are compared by numbers that stand for equal bytes, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockwise.llm.textbytes import SPACE, joined_spans, slices, span_numbers, spans_of
from stockwise.llm.workers import map_batches

LEAST_WORDS = 6
LEAST_TIMES = 4


def _ended(words: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray, lag: np.ndarray, unit: int, least: int, times: int):
    """The runs among diagonals of unit matches: cells ``at, lag``, ascending in ``at``."""
    opens = np.ones(len(at), bool)
    opens[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])
    head = np.flatnonzero(opens)
    matches = np.diff(np.append(head, len(at))) + unit - 1
    first, period = at[head], lag[head]
    start, length = first - period, matches + period
    long = length >= np.maximum(least, times * period)
    start, length, period, first = start[long], length[long], period[long], first[long]
    stop = start + length
    # A neighbour that keeps the period shows that another unit interrupted the diagonal: not a whole run.
    left = start > begin[first]
    left[left] = words[start[left] - 1] == words[start[left] - 1 + period[left]]
    right = stop < end[first]
    right[right] = words[stop[right]] == words[stop[right] - period[right]]
    whole = ~(left | right)
    return start[whole], length[whole], period[whole]


def runs_in(words: np.ndarray, bounds: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES):
    """``row, start, length, period`` of all runs, by row, start and period; start counts from the row's first word.

    words: a number per word, equal for equal words; bounds: the rows' bounds among the words.
    """
    n, sizes = len(words), np.diff(bounds)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    found = []
    name_of = np.full(n, -1, np.int64)
    # Units of one word that occur twice in their row.
    at = np.arange(n)
    keys = rows * (int(words.max()) + 1 if n else 1) + words
    unit = 1
    while True:
        _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = counts[names] > 1
        at, names = at[again], names[again]
        if not len(at):
            break
        order = np.argsort(names, kind="stable")
        same = names[order][1:] == names[order][:-1]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:][same]] = at[order[1:]][same] - at[order[:-1]][same]
        here = (lag > unit // 2) & (lag <= unit)
        if here.any():
            found.append(_ended(words, begin, end, at[here], lag[here], unit, least, times))
        # The next lags exceed ``unit``; a run of such a period needs ``times`` periods of words.
        if times * (unit + 1) > sizes.max():
            break
        name_of[:] = -1
        name_of[at] = names
        both = np.flatnonzero(at + 2 * unit <= end[at])
        both = both[name_of[at[both] + unit] >= 0]
        keys = names[both] * (int(names.max()) + 1) + name_of[at[both] + unit]
        at = at[both]
        unit *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = map(np.concatenate, zip(*found, strict=True))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return rows[start], start - bounds[rows[start]], length, period


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS, times: int = LEAST_TIMES
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, runs, collapsed``.

    Words are runs without ASCII white space, compared as they stand.  ``runs`` lists every stretch of words with
    smallest period q and at least ``max(least, times * q)`` words (times >= 2) that no neighbouring word extends, as (start, length,
    period) by start and period; ``collapsed`` is the text without the words that any run holds after its first period, joined
    by one blank.

    Defined cases: a null, empty or blank text has no words, no runs and an empty ``collapsed``; texts of any length are read
    whole.  Rows that repeat are answered each, null ids are passed on, an empty table gives no rows, other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                starts, ends = spans_of(~SPACE[part.data], part.offsets)
                bounds = np.searchsorted(starts, part.offsets)
                words = span_numbers(part.data, starts, ends)[0]
                row, start, length, period = runs_in(words, bounds, least, times)
                covered = np.zeros(len(words) + 1, np.int64)
                np.add.at(covered, bounds[row] + start + period, 1)
                np.add.at(covered, bounds[row] + start + length, -1)
                kept = np.cumsum(covered[:-1]) == 0
                kept_bounds = np.concatenate(([0], np.cumsum(kept)))[bounds]
                lists = pa.ListArray.from_arrays(
                    np.searchsorted(row, np.arange(part.rows + 1)).astype(np.int32),
                    pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]),
                )
                texts = joined_spans(part.data, starts[kept], ends[kept], kept_bounds)
                columns = [batch.column(0)[part.first : part.first + part.rows], pa.array(np.diff(bounds)), lists, texts.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    runs = "array<struct<start: long, length: long, period: long>>"
    return map_batches(rows, run, f"doc_id long, n_words long, runs {runs}, collapsed string")
