"""Language identification by bit-sliced Bloom filters over character n-grams.

One slot array serves all languages: bit l of a slot says that some n-gram of language l was hashed there, so that
the AND over an n-gram's slots is the set of all languages that contain it.  A text's n-grams are
counted per language bit; the counts are corrected for each language's false-positive rate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockwise.llm.textbytes import LOWER, Slice, grams, mixed, padded, slices
from stockwise.llm.workers import map_batches

UNDETERMINED = "und"
GRAM = 4
HASHES = 3
SLOT_BITS = 20
#: Texts with fewer n-grams are too short to tell gibberish from a rare word.
SHORT = 12

# Letters keep their (lower-case) byte, bytes above 127 are parts of letters, all others are blanks.
_LETTERS = LOWER.copy()
_LETTERS[:128][[not chr(b).isalpha() for b in range(128)]] = 0x20


@dataclass
class LanguageFilter:
    """languages, by name; slots: (words of 64 languages or fewer, slot) bit masks; rates: false positives.

    floor: the share of its n-grams that a text of a learned language has in its filter, nearly always.
    """

    languages: list[str]
    slots: np.ndarray
    rates: np.ndarray
    default: int
    floor: float = 0.0

    @classmethod
    def build(cls, languages: list[str], by_language: list[np.ndarray], default: int = 0, slot_bits: int = SLOT_BITS):
        wide = len(languages) > 8
        kind = np.uint64 if wide else np.uint8
        per_word = 64 if wide else 8
        slots = np.zeros((max(1, -(-len(languages) // per_word)), 1 << slot_bits), dtype=kind)
        rates = np.zeros(len(languages))
        for k, codes in enumerate(by_language):
            word, bit = divmod(k, per_word)
            for at in cls.places(codes, slot_bits):
                slots[word, at] |= kind(1 << bit)
            filled = ((slots[word] >> kind(bit)) & kind(1)).mean()
            rates[k] = filled**HASHES
        return cls(languages, slots, rates, default)

    @staticmethod
    def places(codes: np.ndarray, slot_bits: int) -> list[np.ndarray]:
        h = mixed(codes)
        mask = np.uint64((1 << slot_bits) - 1)
        return [((h >> np.uint64(21 * k)) & mask).astype(np.int64) for k in range(HASHES)]

    def hits(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(row, language) counts of the n-grams that a language's filter contains."""
        rows = len(bounds) - 1
        out = np.zeros((rows, len(self.languages)))
        places = self.places(codes, int(self.slots.shape[1]).bit_length() - 1)
        kind, per_word = self.slots.dtype.type, self.slots.dtype.itemsize * 8
        for word, table in enumerate(self.slots):
            found = table[places[0]]
            for at in places[1:]:
                found = found & table[at]
            for bit in range(min(per_word, len(self.languages) - word * per_word)):
                sums = np.zeros(len(codes) + 1, np.int64)
                np.cumsum((found >> kind(bit)) & kind(1), out=sums[1:])
                out[:, word * per_word + bit] = sums[bounds[1:]] - sums[bounds[:-1]]
        return out

    def shares(self, hits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The estimated share of each row's n-grams that a language really contains."""
        seen = hits / np.maximum(sizes, 1)[:, None]
        return np.maximum(0.0, (seen - self.rates) / np.maximum(1e-9, 1 - self.rates))


def row_grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    return grams(*padded(part, _LETTERS), GRAM)


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32(id as text) leaves ``fold``; a null id is not held out (nor learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def hashed_share(id_col: str) -> Column:
    """A number from 0 to 1 that the id fixes."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def learn_filter(
    docs: DataFrame, per_language: int = 1000, least_docs: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> LanguageFilter:
    """Fits the filters on a bounded sample: per language the documents whose hashed id falls below the share that
    gives ``per_language`` of them on average (all, if there are fewer).

    An n-gram belongs to a language if at least ``least_docs`` of its sampled documents hold it; what is collected is bounded by
    the n-grams of the sample.  The floor of the model is half the share of known n-grams that all but one in a hundred sampled
    documents exceed, texts too short to tell left out.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))  # one row per language
    sample = known.join(F.broadcast(sizes), "lang").filter(hashed_share("doc_id") * F.col("size") < per_language)
    sample = sample.select("lang", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            gathered: dict[str, list[np.ndarray]] = {}
            for part in slices(batch.column(1)):
                codes, bounds = row_grams(part)
                for k in range(part.rows):
                    own = np.unique(codes[bounds[k] : bounds[k + 1]])
                    gathered.setdefault(names[part.first + k], []).append(own)
            for lang, lists in gathered.items():
                codes, counts = np.unique(np.concatenate(lists), return_counts=True)
                columns = [pa.array([lang] * (len(codes) + 1)), pa.array(np.append(codes.view(np.int64), -1)), pa.array(np.append(counts, len(lists)))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "docs"])

    # The gram -1 (no n-gram has that code) counts the documents themselves.
    counted = map_batches(sample, run, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    frequent = counted.filter((F.col("docs") >= least_docs) | (F.col("gram") == -1))
    rows = frequent.select("lang", "gram", "docs").toPandas()
    size = rows[rows.gram == -1].set_index("lang").docs
    languages = sorted(size.index)
    by_language = [rows.gram[(rows.lang == k) & (rows.gram != -1)].to_numpy().view(np.uint64) for k in languages]
    default = languages.index(max(languages, key=lambda k: (size[k], k))) if languages else 0
    model = LanguageFilter.build(languages, by_language, default)
    if languages:
        model.floor = learned_floor(sample, model)
    return model


def learned_floor(sample: DataFrame, model: LanguageFilter) -> float:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_languages(shared.value, batch.column(0))
            long = found.grams >= SHORT
            yield pa.RecordBatch.from_arrays([pa.array(found.covered[long])], names=["covered"])

    covered = map_batches(sample.select("text"), run, "covered double").toArrow().column("covered").to_numpy()
    return float(np.quantile(covered, 0.01)) / 2 if len(covered) else 0.0


def has_letter(part: Slice) -> np.ndarray:
    """Which rows hold a Unicode letter."""
    ascii_letters = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum((_LETTERS[part.data] != 0x20) & (part.data < 128), out=ascii_letters[1:])
    found = ascii_letters[part.offsets[1:]] > ascii_letters[part.offsets[:-1]]
    for k in np.flatnonzero(~found & (np.diff(part.offsets) > 0)):
        found[k] = any(map(str.isalpha, part.data[part.offsets[k] : part.offsets[k + 1]].tobytes().decode()))
    return found


@dataclass
class Found:
    """Per text: the number of its language (the one after the last: undetermined), its score, whether it has a letter, how
    many n-grams, and the share of them that its language's filter holds."""

    chosen: np.ndarray
    scores: np.ndarray
    letters: np.ndarray
    grams: np.ndarray
    covered: np.ndarray


def text_languages(model: LanguageFilter, texts: pa.Array) -> Found:
    chosen, scores = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
    lettered, sizes, covered = np.zeros(len(texts), bool), np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for part in slices(texts) if model.languages else ():
        codes, bounds = row_grams(part)
        shares = model.shares(model.hits(codes, bounds), np.diff(bounds))
        best, total = shares.argmax(axis=1), shares.sum(axis=1)
        at = slice(part.first, part.first + part.rows)
        letters = has_letter(part)
        best[total == 0] = model.default
        chosen[at] = np.where(letters, best, len(model.languages))
        scores[at] = np.where(letters, shares.max(axis=1) / np.where(total > 0, total, 1), 0.0)
        lettered[at], sizes[at], covered[at] = letters, np.diff(bounds), shares.max(axis=1)
    return Found(chosen, scores, lettered, sizes, covered)


def identify(docs: DataFrame, model: LanguageFilter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; the whole text is read.

    score: the share of the chosen language in the sum of all languages' corrected counts.

    Defined cases: null, empty and letterless texts, and any text where no language was learned, are ``und`` with score 0.
    A text whose n-grams no language contains gets the largest training language with score 0; of equal
    languages the first by name wins.  Null ids are passed on, rows that repeat are scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            found = text_languages(shared.value, batch.column(1))
            columns = [batch.column(0), pa.array(names[found.chosen], pa.string()), pa.array(found.scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_batches(rows, run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageFilter, text_col: str = "text", floor: float | None = None) -> DataFrame:
    """The rows of ``docs`` in a learned language, with all their columns.

    A text stays if its language's filter holds at least ``floor`` (by default the model's) of its n-grams; texts with a letter but
    fewer than ``SHORT`` n-grams stay, as too short to tell.

    Defined cases: null, empty and letterless texts go, and every text if no language was learned.  Texts are read whole.  Null ids
    and rows that repeat are judged each; an empty table gives no rows; columns of any name are passed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    least = model.floor if floor is None else floor
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_languages(shared.value, batch.column(at))
            yield batch.filter(pa.array(found.letters & ((found.grams < SHORT) | (found.covered >= least))))

    return map_batches(docs, run, docs.schema)
