from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from stockwise.llm import langid, quality
from stockwise.llm.queries import op6_quality, op8_language, table
from stockwise.llm.textbytes import slices

SF_DIR = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


def sample(n, seed=1):
    r = np.random.default_rng(seed)
    good = [" ".join(r.choice(["river", "stone", "green", "walks", "under", "morning"], 30)) for _ in range(n)]
    bad = [" ".join(x + "$$$" for x in r.choice(["buy", "now", "cheap", "win"], 30)) for _ in range(n)]
    return good, bad


def test_quality_separates_and_handles_odd_rows(docs_of, spark, odd_rows):
    good, bad = sample(60)
    rows = [(1000 + k, t) for k, t in enumerate(good)] + [(2000 + k, t) for k, t in enumerate(bad)]
    labels = [(1000 + k, 1) for k in range(40)] + [(2000 + k, 0) for k in range(40)] + [(None, 1), (1041, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = docs_of(rows + odd_rows)
    model = quality.learn(docs, labels, "quality")
    found = quality.score(docs, model).collect()
    assert len(found) == len(rows) + len(odd_rows)
    assert all(0 <= r.score <= 1 for r in found)
    scores = {r.doc_id: r.score for r in found}
    assert all(scores[1000 + k] >= 0.7 for k in range(60)) and all(scores[2000 + k] < 0.3 for k in range(60))
    empty = {r.score for r in found if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    kept = quality.keep_good(docs, model, 0.7)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r.score >= 0.7}


def test_quality_without_rows(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.learn(docs_of([(1, "text")]), none, "quality")
    assert [r.score for r in quality.score(docs_of([(1, "text"), (2, None)]), model).collect()] == [0.5, 0.5]
    assert quality.score(docs_of([]), model).collect() == []
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    model = quality.learn(docs_of([(1, "text")]), one, "quality")
    assert [r.score for r in quality.score(docs_of([(1, "text")]), model).collect()] == [1.0]


def test_model_ignores_order_of_slices():
    good, bad = sample(10)
    column = pa.array(good + bad + [None, ""])
    rows = [r for part in slices(column) for r in _feature_rows(part)]
    parts = [r for part in slices(column, 64) for r in _feature_rows(part)]
    assert rows == parts


def test_rare_class_is_learned_from_its_own_words():
    """One document in a hundred is bad; what tells it apart is in no other class, which has chance words in its place."""
    r = np.random.default_rng(3)
    common = np.array(["river", "stone", "green", "walks", "under", "morning", "seven", "lamps"])
    own = np.array(["buy$$$", "now$$$", "cheap$$$", "win$$$"])

    def texts(n, bad):
        chance = lambda: own if bad else np.array([f"{x:06x}" for x in r.integers(0, 1 << 24, 30)])
        return [" ".join(np.where(r.random(30) < 0.3, r.choice(chance(), 30), r.choice(common, 30))) for _ in range(n)]

    learned = texts(1980, False) + texts(20, True)
    rows = []
    for k, part in ((k, part) for k, t in enumerate(learned) for part in slices(pa.array([t]))):
        found, counts = np.unique(np.concatenate([b for b, _ in quality.features(part)]), return_counts=True)
        rows.append((found, counts, int(k < 1980)))
    model = quality.train(rows, [0, 1])
    assert (quality.text_scores(model, pa.array(texts(200, True)), 1) < 0.5).mean() > 0.97
    assert (quality.text_scores(model, pa.array(texts(100, False)), 1) >= 0.7).all()


def _feature_rows(part):
    found = quality.features(part)
    return [tuple(tuple(sorted(b[r[k] : r[k + 1]].tolist())) for b, r in found) for k in range(part.rows)]


@tables
def test_held_out_quality(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    found = [r for r in op6_quality(spark, SF_DIR).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in found]) > 0.95
    assert np.mean([r.predicted for r in found if labels[r.doc_id] == 1]) > 0.98


@tables
def test_held_out_language(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SF_DIR, "documents").collect()}
    found = [r for r in op8_language(spark, SF_DIR).collect() if r.held_out]
    assert found and np.mean([r.lang_pred == lang[r.doc_id] for r in found]) > 0.99


def test_languages(docs_of, odd_rows):
    rows = [(k, "the river and the stone are under the morning sky", "en") for k in range(20)]
    rows += [(100 + k, "der Fluss und der Stein liegen unter dem Himmel", "de") for k in range(20)]
    model = langid.learn_filter(docs_of(rows + odd_rows))
    assert model.languages == ["de", "en"]
    asked = docs_of([(1, "the stone under the sky"), (2, "Der Stein und der Himmel"), (3, None), (4, ""), (5, "123 !!"), (6, chr(0x30AB)), (7, "xqzjv")])
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(asked, model).collect()}
    assert found[1][0] == "en" and found[2][0] == "de" and found[1][1] > 0.6
    assert found[3] == found[4] == found[5] == ("und", 0.0)
    assert found[6] == found[7] == (model.languages[model.default], 0.0)
    kept = langid.keep_identified(asked, model)
    # Texts of one word are too short to tell and stay.
    assert kept.columns == asked.columns and {r.doc_id for r in kept.collect()} == {1, 2, 6, 7}
    odd = docs_of([(1, "qzxv jkwq " * 9), (2, "the " + "xqzjv wvkkq " * 12), (3, "ok"), (4, "the river is under the sky and the stone is under the hill")])
    assert {r.doc_id for r in langid.keep_identified(odd, model).collect()} == {3, 4}
    assert langid.identify(docs_of([]), model).collect() == []
    nothing = langid.learn_filter(docs_of([]))
    assert [r.lang_pred for r in langid.identify(docs_of([(1, "text")]), nothing).collect()] == ["und"]


@pytest.mark.parametrize("languages", [3, 70])
def test_filters_return_all_languages_of_a_gram(languages):
    r = np.random.default_rng(2)
    own = [r.integers(0, 1 << 32, 50, dtype=np.uint64) for _ in range(languages)]
    model = langid.LanguageFilter.build([f"l{k:02}" for k in range(languages)], own)
    hits = model.hits(np.concatenate(own), np.arange(0, 50 * languages + 1, 50))
    assert (np.diag(hits) == 50).all()  # no false negatives
    assert hits.sum() < 50 * languages * 1.05
