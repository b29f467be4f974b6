"""A supervised text classifier on subword embeddings.

Words and character n-grams are hashed into buckets, each with a learned vector; a document is the average of its
vectors, and a softmax layer turns that into class probabilities.  Vectors and layer are trained by stochastic
gradient descent in numpy on a bounded sample.  For scoring, bucket vectors and layer multiply out to one number per bucket and
class, so a text costs one table look-up per feature.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockwise.llm.langid import hashed_share
from stockwise.llm.textbytes import SPACE, Slice, grams, mixed, padded, slices, word_hashes
from stockwise.llm.workers import map_batches

BUCKET_BITS = 17
GRAMS = (3, 4)
#: Stand for a word that equals the word before it, and for one that does not: word bigrams without the words.
AGAIN, OTHER = 1, 2

_BLANKED = np.arange(256, dtype=np.uint8)
_BLANKED[SPACE] = 0x20


def features(part: Slice, bucket_bits: int = BUCKET_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature buckets of all rows as (buckets, row bounds): words, their bigram marks, then n-grams of each size."""
    shift = np.uint64(64 - bucket_bits)
    words, bounds = word_hashes(part, lower=False)
    out = [((words * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64), bounds)]
    marks = np.full(len(words), OTHER, np.int64)
    marks[1:][words[1:] == words[:-1]] = AGAIN
    marks[bounds[:-1][bounds[:-1] < len(words)]] = OTHER
    out.append((marks, bounds))
    data, rows = padded(part, _BLANKED)
    for n in GRAMS:
        codes, bounds = grams(data, rows, n)
        out.append(((mixed(codes + np.uint64(n)) >> shift).astype(np.int64), bounds))
    return out


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


@dataclass
class SubwordModel:
    """weights: (bucket, class) sums; bias: per class."""

    classes: list[int]
    weights: np.ndarray
    bias: np.ndarray

    def probabilities(self, part: Slice) -> np.ndarray:
        total, n = np.zeros((part.rows, len(self.classes))), np.zeros(part.rows)
        bits = int(len(self.weights)).bit_length() - 1
        for buckets, bounds in features(part, bits):
            for c in range(len(self.classes)):
                total[:, c] += row_sums(self.weights[buckets, c], bounds)
            n += np.diff(bounds)
        logits = total / np.maximum(n, 1)[:, None] + self.bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: list[int],
    bucket_bits: int = BUCKET_BITS,
    dim: int = 8,
    steps: int = 400,
    batch: int = 64,
    rate: float = 0.3,
    seed: int = 11,
) -> SubwordModel:
    """Minibatch gradient descent with a step size per parameter that falls with the gradients seen (AdaGrad).

    rows: (buckets, counts, class).  Buckets that only one of the rows holds keep a zero vector, but count in the averages.
    """
    rng = np.random.default_rng(seed)
    place = {c: k for k, c in enumerate(classes)}
    targets = np.array([place[r[2]] for r in rows], dtype=np.int64)
    share = np.bincount(targets, minlength=len(classes)) / max(1, len(rows))
    bias = np.log(np.maximum(share, 1e-6))
    docs = np.zeros(1 << bucket_bits, np.int64)
    for buckets, _, _ in rows:
        docs[buckets] += 1
    used = docs >= 2
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << bucket_bits, dim)).astype(np.float32) * used[:, None]
    layer = rng.uniform(-1, 1, (dim, len(classes))).astype(np.float32)
    kept = []
    for buckets, counts, _ in rows:
        own = used[buckets]
        kept.append((buckets[own], (counts[own] / max(1, counts.sum())).astype(np.float32)))
    usable = np.array([k for k, r in enumerate(kept) if len(r[0])], dtype=np.int64)
    seen_vectors = np.full(1 << bucket_bits, 1e-12, np.float32)
    seen_layer, seen_bias = np.full(layer.shape, 1e-8), np.full(len(classes), 1e-8)
    order = np.zeros(0, np.int64)
    for _ in range(steps if len(classes) > 1 and len(usable) else 0):
        if len(order) < batch:
            order = np.concatenate((order, rng.permutation(usable)))
        own, order = order[:batch], order[batch:]
        sizes = np.array([len(kept[k][0]) for k in own])
        buckets = np.concatenate([kept[k][0] for k in own])
        weights = np.concatenate([kept[k][1] for k in own])
        starts = np.cumsum(sizes) - sizes
        hidden = np.add.reduceat(vectors[buckets] * weights[:, None], starts)
        logits = hidden @ layer + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(own)), targets[own]] -= 1.0
        p /= len(own)
        back = p @ layer.T
        # A document's gradient goes to its vectors in proportion to their counts.
        by_bucket = np.argsort(buckets, kind="stable")
        found, first = np.unique(buckets[by_bucket], return_index=True)
        pull = back[np.repeat(np.arange(len(own)), sizes)] * weights[:, None]
        pull = np.add.reduceat(pull[by_bucket], first)
        seen_vectors[found] += (pull**2).mean(axis=1)
        vectors[found] -= rate * pull / np.sqrt(seen_vectors[found])[:, None]
        pull = hidden.T @ p
        seen_layer += pull**2
        layer -= rate * pull / np.sqrt(seen_layer)
        pull = p.sum(axis=0)
        seen_bias += pull**2
        bias -= rate * pull / np.sqrt(seen_bias)
    return SubwordModel(classes, (vectors @ layer).astype(np.float32), bias.astype(np.float64))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    sample_rows: int = 5000,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bits: int = BUCKET_BITS,
) -> SubwordModel:
    """Fits on a bounded sample: the labelled documents whose hashed id falls below the share that gives ``sample_rows``
    of them on average (all, if there are fewer).

    Each sampled document is read whole; what is gathered are its distinct feature buckets, at most
    ``2 ** bucket_bits`` of them.  Null labels, ids and texts are not learned from.
    """
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna().distinct()
    chosen = marked.filter(hashed_share("doc_id") < sample_rows / max(1, labels.count()))
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).dropna()
    sample = texts.join(F.broadcast(chosen), "doc_id").select("label", "text", "doc_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                found = features(part, bucket_bits)
                at = slice(part.first, part.first + part.rows)
                lists = [np.unique(np.concatenate([b[r[k] : r[k + 1]] for b, r in found]), return_counts=True) for k in range(part.rows)]
                columns = [
                    batch.column(0)[at],
                    batch.column(2)[at],
                    pa.array([x.astype(np.int32).tobytes() for x, _ in lists], pa.binary()),
                    pa.array([n.astype(np.int32).tobytes() for _, n in lists], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "doc_id", "buckets", "counts"])

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            label, key, buckets, counts = (batch.column(k).to_pylist() for k in range(4))
            rows += zip(key, label, buckets, counts, strict=True)
        rows.sort()
        own = [(np.frombuffer(b, np.int32), np.frombuffer(n, np.int32), c) for _, c, b, n in rows]
        model = train(own, sorted({r[2] for r in own}), bucket_bits)
        columns = [[model.classes], [model.weights.tobytes()], [model.bias.tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["classes", "weights", "bias"])

    # The bounded sample is gathered in one task, so that neither its features nor the training weigh on the driver.
    kinds = (pa.list_(pa.int64()), pa.binary(), pa.binary())
    gathered = map_batches(sample, run, "label int, doc_id long, buckets binary, counts binary").repartition(1)
    found = map_batches(gathered, fit, "classes array<long>, weights binary, bias binary").first()
    if found is None:
        return train([], [], bucket_bits)
    weights = np.frombuffer(bytes(found.weights), np.float32).reshape(1 << bucket_bits, len(found.classes))
    return SubwordModel(list(found.classes), weights, np.frombuffer(bytes(found.bias), np.float64))


def text_scores(model: SubwordModel, texts: pa.Array, positive: int) -> np.ndarray:
    """The probability of class ``positive`` for every text of an Arrow column."""
    out = np.full(len(texts), 0.5)
    for part in slices(texts) if model.classes else ():
        p = model.probabilities(part)
        known = positive in model.classes
        out[part.first : part.first + part.rows] = p[:, model.classes.index(positive)] if known else 0.0
    return out


def score(docs: DataFrame, model: SubwordModel, positive: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``: the probability of class ``positive`` for the whole text of every row.

    Defined cases: null, empty and blank texts have no features and get the class's share in the training
    sample; without any training row the score is 0.5, and it is 0 or 1 if only one class was seen.  Null ids are passed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = text_scores(shared.value, batch.column(1), positive)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_batches(rows, run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: SubwordModel, least: float = 0.7, positive: int = 1, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their columns.

    Defined cases as in :func:`score`: texts without features get the class's share in the training sample; null ids and rows that repeat
    are judged each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(text_scores(shared.value, batch.column(at), positive) >= least))

    return map_batches(docs, run, docs.schema)
