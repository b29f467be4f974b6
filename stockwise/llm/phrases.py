"""Phrase collocations: frequent phrases found by Toivonen's method, scored exactly.

A sample of the documents proposes words and two-word phrases, with a support lowered so that few are missed.  A full pass
then counts, in all documents: every word; the two-word phrases of proposed words; the three-word phrases whose two halves
are proposed.  That holds the proposals together with their negative border: the phrases that are not proposed though
all their parts are.  Where a counted phrase turns out frequent without having been proposed (a border failure), it is
proposed now and a further pass counts the phrases that this admits and no others; passes go on until none fails.  Then all
frequent phrases are known with exact counts, whatever the sample was.

Proposals travel as a bit map of bounded size over hashes of phrases (``2 ** bits`` bits at most, whatever the data): a phrase that shares a
bit is counted without need, and nothing else.  A pass numbers the distinct words of a slice of text exactly, counts phrases of
numbers with arrays and hands out each distinct phrase of the slice once; Spark adds up, first inside the task.

A phrase is a row of 64-bit word codes, so that counting moves numbers only.  A second hash per word tells whether two words share
a code, which would raise an error; the words of the phrases that are returned are looked up at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from stockwise.llm.skew import HOT_SHARE, looked_up
from stockwise.llm.textbytes import LOWER, Slice, gathered, joined_spans, mixed, ranked, slices, span_numbers, spans_of
from stockwise.llm.workers import map_batches
from stockwise.session import staged

SLICE = 1 << 19
SAMPLE_SHARE = 0.25
BITS = 26

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)

#: The codes of a phrase.  A pair has 0 as third code, a word 0 as second and another hash as third, and only words have a language; a
#: language's number of words stands under its code and this mark.
CODES = ["c1", "c2", "c3"]
TOTAL = -1
COUNTED = "c1 long, c2 long, c3 long, lang long, n long"


def language_codes(names: pa.Array) -> np.ndarray:
    return np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in names.to_pylist()], np.uint64)


def pair_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One code for two; a word alone has the second code 0."""
    return mixed(first * _GOLDEN + second)


class Proposed:
    """Words and pairs by their codes: a bit map that may hold more than was put in, never less."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.shift = np.uint64(64 - int(math.log2(len(words))))

    def holds(self, first: np.ndarray, second: np.ndarray | int = 0) -> np.ndarray:
        return self.marked(pair_codes(first, np.asarray(second, np.uint64)))

    def marked(self, codes: np.ndarray) -> np.ndarray:
        return (self.words[(codes >> self.shift).astype(np.int64)] >> (codes & np.uint64(63)) & np.uint64(1)).astype(bool)

    def joined(self, other: Proposed) -> Proposed:
        return Proposed(self.words | other.words)


def proposed(phrases: DataFrame, bits: int = BITS) -> Proposed:
    """The bit map of ``c1, c2``: at most ``2 ** (bits - 6)`` numbers come to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pair_codes(*(batch.column(k).to_numpy().view(np.uint64) for k in range(2)))
            words = (codes >> np.uint64(70 - bits)).astype(np.int64)
            marks = (np.uint64(1) << (codes & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(marks)], names=["place", "marks"])

    found = map_batches(phrases.select("c1", "c2"), run, "place long, marks long")
    found = found.groupBy("place").agg(F.bit_or("marks").alias("marks")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("place").to_numpy()] = found.column("marks").to_numpy().view(np.uint64)
    return Proposed(out)


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of the first of each distinct key, the number of every key, and the counts."""
    first, ranks = ranked(keys)
    return first, ranks, np.bincount(ranks, minlength=len(first))


def second_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A sum over the bytes of each span, weighted by their place: a hash that shares nothing with ``span_hashes``."""
    lengths = ends - starts
    weights = mixed(np.arange(1, lengths.max(initial=0) + 1, dtype=np.uint64))
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = mixed(gathered(data, starts, lengths).astype(np.uint64) + weights[place])
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    stops = np.cumsum(lengths)
    return sums[stops] - sums[stops - lengths]


class SlicePhrases:
    """Words of a slice, numbered by language and bytes; per distinct one ``codes``, ``languages`` and ``counts``, ``checks()`` and ``spell(at)``."""

    def __init__(self, part: Slice, languages: np.ndarray, language_codes: np.ndarray):
        data = LOWER[part.data]
        starts, ends = spans_of(_WORD[data], part.offsets)
        rows = np.searchsorted(part.offsets, starts, side="right") - 1
        languages = languages[rows]
        spelled, _, hashes = span_numbers(data, starts, ends)
        first, self.words, self.counts = _ranked(spelled * len(language_codes) + languages)
        codes = mixed(hashes[spelled[first]] ^ language_codes[languages[first]])
        self.codes = np.where(codes == 0, np.uint64(1), codes)
        self.checks = lambda: mixed(second_hashes(data, starts[first], ends[first])) | np.uint64(1)
        self.languages = languages[first]
        self.spell = lambda at: joined_spans(data, starts[first[at]], ends[first[at]], np.arange(len(at) + 1)).cast(pa.string())
        breaks = np.cumsum(_BREAK[data], dtype=np.int32)
        # follows[i]: word i + 1 stands in the same piece as word i.
        self.follows = np.zeros(len(starts), bool)
        if len(starts) > 1:
            self.follows[:-1] = (rows[1:] == rows[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1] - 1])

    def pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The number of each of the pairs that begin at the words ``at``, and per distinct pair its two words and count."""
        first, ranks, counts = _ranked(self.words[at] * np.int64(len(self.codes)) + self.words[at + 1])
        here = at[first]
        return ranks, self.words[here], self.words[here + 1], counts


def phrase_counts(docs: DataFrame, now: Broadcast | None, before: Broadcast | None) -> DataFrame:
    """Counts of the phrases that ``now`` admits and ``before`` did not: ``c1, c2, c3, lang, n``.

    docs: ``lang, text``; now and before: proposed words and pairs (:class:`Proposed`).  Without ``before`` the words are counted too, and all
    words of each language; without ``now`` every word and pair is.
    """
    newer, older = now, before

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = (None if x is None else x.value for x in (newer, older))

        def batch_of(counts: np.ndarray, *codes: np.ndarray, lang: np.ndarray | None = None) -> pa.RecordBatch:
            none = np.zeros(len(counts), np.uint64)
            columns = [*codes, *[none] * (3 - len(codes)), none if lang is None else lang, counts]
            return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=[*CODES, "lang", "n"])

        for batch in batches:
            dictionary = batch.column(0).dictionary_encode()
            codes, languages = language_codes(dictionary.dictionary), dictionary.indices.to_numpy()
            for part in slices(batch.column(1), SLICE):
                own = SlicePhrases(part, languages[part.first : part.first + part.rows], codes)
                if not len(own.words):
                    continue
                if before is None:
                    none = np.zeros(len(own.codes), np.uint64)
                    yield batch_of(own.counts, own.codes, none, own.checks(), lang=codes[own.languages])
                    held = np.unique(own.languages)
                    totals = np.bincount(own.languages, own.counts)[held].astype(np.int64)
                    yield batch_of(totals, codes[held], np.full(len(held), TOTAL))
                at = np.flatnonzero(own.follows)
                if now is not None:
                    # Only the positions of fresh phrases are numbered.
                    left, right = own.words[at], own.words[at + 1]
                    ok = now[0].holds(own.codes)
                    fresh = ok[left] & ok[right]
                    pairs = pair_codes(own.codes[left], own.codes[right])
                    pair_ok = now[1].marked(pairs)
                    # Triples: a pair at i and one at i + 1.
                    k = np.flatnonzero(at[1:] == at[:-1] + 1)
                    fresh3 = pair_ok[k] & pair_ok[k + 1]
                    if before is not None:
                        old = before[0].holds(own.codes)
                        fresh &= ~(old[left] & old[right])
                        pair_old = before[1].marked(pairs)
                        fresh3 &= ~(pair_old[k] & pair_old[k + 1])
                    at, at3 = at[fresh], at[k[fresh3]]
                    if len(at3):
                        ranks, left, right, _ = own.pairs(at3)
                        last = own.words[at3 + 2]
                        first, _, counts = _ranked(ranks * np.int64(len(own.codes)) + last)
                        pair = ranks[first]
                        yield batch_of(counts, own.codes[left[pair]], own.codes[right[pair]], own.codes[last[first]])
                if len(at):
                    _, left, right, counts = own.pairs(at)
                    yield batch_of(counts, own.codes[left], own.codes[right])

    return map_batches(docs, run, COUNTED).groupBy(*CODES, "lang").agg(F.sum("n").alias("n"))


def words_of(docs: DataFrame, wanted: Broadcast) -> DataFrame:
    """``code, word`` of the words whose code the bit map ``wanted`` holds, and some more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dictionary = batch.column(0).dictionary_encode()
            codes, languages = language_codes(dictionary.dictionary), dictionary.indices.to_numpy()
            for part in slices(batch.column(1), SLICE):
                own = SlicePhrases(part, languages[part.first : part.first + part.rows], codes)
                at = np.flatnonzero(wanted.value.holds(own.codes))
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(own.codes[at].view(np.int64)), own.spell(at)], names=["code", "word"])

    return map_batches(docs, run, "code long, word string").distinct()


def lowered(least: int, share: float, miss: float = 0.3) -> int:
    """The largest support in a sample of ``share`` that a phrase of support ``least`` misses with probability below ``miss``."""
    below, k = 0.0, 0
    while True:
        below += math.comb(least, k) * share**k * (1 - share) ** (least - k)
        if below >= miss:
            return max(1, k)
        k += 1


def sized(phrases: DataFrame, size: int) -> DataFrame:
    """The phrases of so many words."""
    return phrases.filter({1: "c2 = 0", 2: f"c2 != 0 AND c2 != {TOTAL} AND c3 = 0", 3: "c2 != 0 AND c3 != 0"}[size])


def frequent_phrases(docs: DataFrame, least: int, share: float = SAMPLE_SHARE, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """All words, pairs and triples that occur at least ``least`` times: ``c1, c2, c3, lang, n``; and the words of each language: ``lang, n``.

    docs: ``id, lang, text``.  Languages stand for their names as codes, words only know theirs.
    """
    chosen = F.pmod(F.xxhash64(F.lit("phrases"), "id"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = phrase_counts(docs.filter(chosen).select("lang", "text"), None, None)
    sample = staged(sample.filter((F.col("c2") != TOTAL) & (F.col("n") >= lowered(least, share))).select(*CODES), "proposals")
    # Eight to sixteen bits a proposal as far as ``bits`` allows; a fuller map only counts more in vain.
    bits = min(bits, max(16, (8 * sample.count()).bit_length()))
    now = tuple(proposed(sized(sample, k), bits) for k in (1, 2))
    share_out = docs.sparkSession.sparkContext.broadcast
    shared, older, passes = share_out(now), None, []
    while True:
        counted = phrase_counts(docs.select("lang", "text"), shared, older)
        # All words are kept, to see whether two of them share a code.
        kept = staged(counted.filter(F.col("c2").isin(TOTAL, 0) | (F.col("n") >= least)), "phrases")
        if older is None and not sized(kept, 1).groupBy("c1").count().filter("count > 1").isEmpty():
            raise RuntimeError("two words share a code")
        kept = kept.filter((F.col("c2") == TOTAL) | (F.col("n") >= least))
        passes.append(kept)
        failed = staged(failures(sized(kept, 1).unionByName(sized(kept, 2)), shared), "failures")
        more = tuple(proposed(sized(failed, k), bits) for k in (1, 2))
        if not any(m.words.any() for m in more):
            break
        now = tuple(a.joined(b) for a, b in zip(now, more, strict=True))
        if older is not None:
            older.destroy()
        shared, older = share_out(now), shared
    # What they were for is written.
    for done in (shared, older):
        if done is not None:
            done.destroy()
    totals = passes[0].filter(F.col("c2") == TOTAL).select(F.col("c1").alias("lang"), "n")
    return reduce(DataFrame.unionByName, passes).filter(F.col("c2") != TOTAL), totals


def failures(phrases: DataFrame, shared: Broadcast) -> DataFrame:
    """The words and pairs (``c1, c2, c3``) that were not proposed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c1, c2 = (batch.column(k).to_numpy() for k in range(2))
            known = [p.holds(c1.view(np.uint64), c2.view(np.uint64)) for p in shared.value]
            yield batch.filter(pa.array(~np.where(c2 == 0, *known)))

    return map_batches(phrases.select(*CODES), run, "c1 long, c2 long, c3 long")


def with_counts(rows: DataFrame, parts: Mapping[str, Sequence[str]], counts: DataFrame, hot_from: int) -> DataFrame:
    """Adds, under each name of ``parts``, the count of the phrase whose codes stand in the given columns.

    counts: ``codes, n``; hot_from: the count from which a phrase may meet many rows, a thousandth of all words, so that the
    phrases above it are few.
    """
    for name, columns in parts.items():
        named = [F.col(c).alias(x) for c, x in zip(CODES, columns, strict=False)]
        table = sized(counts, len(columns)).select(*named, F.col("n").alias(name))
        # Written, since the next look-up reads the rows twice.
        rows = staged(looked_up(rows, table, list(columns), table.filter(F.col(name) >= hot_from)), "counted")
    return rows


def cut_score(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)) as SQL over longs, exact up to 10^15 occurrences."""
    wide = [f"CAST({c} AS DECIMAL(15, 0))" for c in (a, a, left, right)]
    return f"(({wide[0]} * {wide[1]} * CAST(1000000 AS DECIMAL(7, 0))) div ({wide[2]} * {wide[3]}))"


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 10,
    inside_percent: int = 50,
    first: int = 2000,
    share: float = SAMPLE_SHARE,
    bits: int = BITS,
) -> DataFrame:
    """The best phrases of two and three words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and the pieces into words at blanks and tabs.  A
    phrase with a >= ``least`` occurrences inside pieces is a candidate; cut after its first k words it has l and r
    occurrences of both parts and score floor(1000000 a a / (l r)), the lowest cut counts, of equal ones the first.  A candidate
    inside a longer one that occurs in at least ``inside_percent`` of its places is dropped.  n: all words of the language.  Order:
    score, a, both descending, then phrase by UTF-8 bytes.

    Defined cases: a null language is ``und`` (and one with ``und``); null, empty and wordless texts add nothing; rows that
    repeat count each; null ids take part.  A sample of no rows proposes nothing and the passes find all by themselves.  An empty table gives no
    rows.  Other columns are not read.
    """
    rows = docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[lang_col], F.lit("und")).alias("lang"), docs[text_col].alias("text")
    )
    counts, totals = frequent_phrases(rows, least, share, bits)
    total = totals.agg(F.sum("n")).first()[0] or 0
    hot_from = max(least, total // HOT_SHARE)
    score = cut_score("a", "l", "r")
    found = sized(counts, 3).select(*CODES, F.col("n").alias("a"))
    parts = {"f1": ["c1"], "f23": ["c2", "c3"], "f12": ["c1", "c2"], "f3": ["c3"]}
    three = with_counts(found, parts, counts, hot_from)
    one, two = F.expr(cut_score("a", "f1", "f23")), F.expr(cut_score("a", "f12", "f3"))
    three = three.withColumns({"s1": one, "s2": two})
    scored3 = three.select(
        *CODES, "a", F.expr("IF(s1 <= s2, f1, f12)").alias("l"), F.expr("IF(s1 <= s2, f23, f3)").alias("r"), F.least("s1", "s2").alias("score")
    )
    # The greatest count of a triple that holds the pair.
    inner = three.select("a", F.explode(F.array(F.struct("c1", "c2"), F.struct(F.col("c2").alias("c1"), F.col("c3").alias("c2")))).alias("p"))
    inner = inner.groupBy("p.c1", "p.c2").agg(F.max("a").alias("longer"))
    pairs = sized(counts, 2).select("c1", "c2", F.lit(0).cast("long").alias("c3"), F.col("n").alias("a"))
    pairs = pairs.join(inner, ["c1", "c2"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {inside_percent} * a")).drop("longer")
    scored2 = with_counts(staged(pairs, "pairs"), {"l": ["c1"], "r": ["c2"]}, counts, hot_from).select(*CODES, "a", "l", "r", F.expr(score).alias("score"))

    # The language is that of the first word.  Ties stay until the words are known.
    spoken = sized(counts, 1).select("c1", "lang", "n")
    named = looked_up(scored2.unionByName(scored3), spoken.drop("n"), ["c1"], spoken.filter(F.col("n") >= hot_from).drop("n"))
    near = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = staged(named.withColumn("near", F.rank().over(near)).filter(F.col("near") <= first).drop("near"), "best")

    used = best.select(F.explode(F.array(*CODES)).alias("c1"), F.lit(0).cast("long").alias("c2")).filter("c1 != 0").distinct()
    wanted = docs.sparkSession.sparkContext.broadcast(proposed(used, min(bits, max(16, (16 * used.count()).bit_length()))))
    texts = rows.select("lang", "text")
    spelled = words_of(texts, wanted).join(used.select(F.col("c1").alias("code")), "code", "left_semi")
    spelled = staged(spelled, "words")
    wanted.destroy()
    for code in CODES:
        best = best.join(spelled.select(F.col("code").alias(code), F.col("word").alias(f"w{code}")), code, "left")
    best = best.withColumn("phrase", F.concat_ws(" ", *(f"w{c}" for c in CODES)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    languages = rows.select("lang").distinct()
    coded = map_batches(languages, _coded, "name string, lang long")
    best = best.join(totals, "lang").join(coded, "lang")
    return best.select(F.col("name").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(language_codes(batch.column(0)).view(np.int64))], names=["name", "lang"])
