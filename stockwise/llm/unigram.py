"""Token counts under a unigram vocabulary, without building tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; a forward pass keeps, per
position, the best score, the number of tokens on the best path and whether its last token is unknown.  Rules are those
of the tokenizers library: a later candidate must be strictly better, so that of equal paths the longest last piece wins;
a character that no single-character piece covers may be unknown at ten below the lowest score; neighbouring unknown
characters are one token.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from stockwise.llm.bpe import blocks
from stockwise.llm.workers import map_batches

BLANK = chr(0x2581)
UNKNOWN_PENALTY = 10.0
#: Counted words a Python worker remembers between blocks.
KNOWN_WORDS = 400_000


def zipf_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file with log probabilities by Zipf's law over their rank; the unknown piece is first.

    The public file ranks its pieces but holds no probabilities; control and byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]
    norm = math.log(sum(1 / (k + 2.7) for k in range(len(plain))))
    return [("<unk>", 0.0), *((p, -math.log(k + 2.7) - norm) for k, p in enumerate(plain))]


class UnigramCounter:
    """vocabulary: (piece, score) pairs, the first of them unknown."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.unknown_score = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, i == 0))
        self.automaton.make_automaton()
        self.known: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        n = len(word)
        lowest = -math.inf
        best, count, unknown = [lowest] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0

        def complete(end: int, single: bool) -> None:
            # The unknown candidate starts last of all that end here, so it is compared last.
            if not single and best[end - 1] + self.unknown_score > best[end]:
                best[end] = best[end - 1] + self.unknown_score
                count[end] = count[end - 1] + (not unknown[end - 1])
                unknown[end] = True

        at, single = 1, False
        for last, (length, score, is_unknown) in self.automaton.iter(word):
            end = last + 1
            while at < end:
                complete(at, single)
                at, single = at + 1, False
            start = end - length
            if length == 1:
                single = True
            candidate = best[start] + score
            if candidate > best[end]:
                best[end] = candidate
                count[end] = count[start] + (not (is_unknown and unknown[start]))
                unknown[end] = is_unknown
        while at <= n:
            complete(at, single)
            at, single = at + 1, False
        return count[n]

    def count(self, text: str) -> int:
        total, known = 0, self.known
        for word in words(text):
            n = known.get(word)
            if n is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                n = known[word] = self.count_word(BLANK + word)
            total += n
        return total


def words(text: str) -> list[str]:
    """The words between blanks; each stands for itself with a blank mark before it."""
    if not text:
        return []
    text = text.replace(" ", BLANK)
    return (text if text[0] == BLANK else BLANK + text).split(BLANK)[1:]


@lru_cache(maxsize=2)
def _counter(path: str) -> UnigramCounter:
    return UnigramCounter(zipf_vocabulary(path))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` for every text; path: a sentencepiece file, see :func:`zipf_vocabulary`.

    Defined cases: null and empty texts have 0 tokens; white space other than the blank is ordinary text.
    Null ids are passed on, rows that repeat are counted each, other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for keys, texts in blocks(batches):
            counts = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"]
            )

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return map_batches(rows, run, "doc_id long, n_tokens long")
