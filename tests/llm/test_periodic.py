import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stockwise.llm.periodic import periodic_runs, runs_in
from stockwise.llm.queries import op12_periodic_runs, with_planted_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_runs(words, least=6, times=4):
    """Every maximal stretch of each lag; of equal stretches the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(least, times * q):
                best.setdefault((start, length), q)
            i = j
    return sorted((s, ln, q) for (s, ln), q in best.items())


def slow_collapsed(words, runs):
    dropped = {i for s, ln, q in runs for i in range(s + q, s + ln)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def found_in(texts):
    bounds = np.cumsum([0] + [len(t) for t in texts])
    flat = np.array([x for t in texts for x in t], np.int64)
    out = [[] for _ in texts]
    for row, *run in zip(*runs_in(flat, bounds), strict=True):
        out[row].append(tuple(int(x) for x in run))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5))
def test_runs_of_few_letters(texts):
    assert found_in(texts) == [slow_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=5))
def test_nested_powers(parts):
    text = [x for word, k in parts for x in word * k]
    text = text * 5 + text[: len(text) // 2]
    assert found_in([text, text[1:]]) == [slow_runs(text), slow_runs(text[1:])]


def test_one_word_repeated_many_times_is_cheap():
    text = np.zeros(300_000, np.int64)
    row, start, length, period = runs_in(text, np.array([0, len(text)]))
    assert [row.tolist(), start.tolist(), length.tolist(), period.tolist()] == [[0], [0], [300_000], [1]]


def test_operator(docs_of, odd_rows):
    rows = [r[:2] for r in odd_rows] + [(20, "a " * 7 + "\tb"), (21, "ä B\n" * 4 + "ä"), (22, "Ä b " * 3), (23, "x" + " y z" * 9 + " y y y y y y")]
    found = periodic_runs(docs_of(rows)).collect()
    assert len(found) == len(rows)
    want = []
    for key, text in rows:
        words = WORD.findall(text or "")
        runs = slow_runs(words) if len(words) < 1000 else []
        want.append((key, len(words), runs, slow_collapsed(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic_runs(docs_of([])).collect() == []


def test_planted(docs_of):
    rows = [(k, " ".join(f"w{j}" for j in range(k % 40))) for k in range(300)] + [(None, "a b"), (1, None)]
    for r in with_planted_runs(docs_of(rows)).collect():
        old = dict(rows).get(r.doc_id) if r.doc_id != 1 else None
        if r.doc_id is None or r.doc_id == 1 or zlib.crc32(str(r.doc_id).encode()) % 10:
            continue
        assert WORD.findall(r.text) == planted(r.doc_id, WORD.findall(old))


def planted(key, words):
    g, n = zlib.crc32(str(key).encode()) // 10, len(words)
    if not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for key, text in docs:
        words = WORD.findall(text or "")
        if zlib.crc32(str(key).encode()) % 10 == 0:
            words = planted(key, words)
        if len(words) > 4000:
            continue
        runs = slow_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        listed = "".join(f"{s},{ln},{q}\n" for s, ln, q in runs)
        digests = [sha256(x.encode()).hexdigest() for x in (listed, slow_collapsed(words, runs))]
        want.append((key, len(runs), *best, milli, *digests))
    ids = {w[0] for w in want}
    found = [tuple(r) for r in op12_periodic_runs(spark, sf).collect()]
    assert len(found) == len(docs)
    assert sorted(r for r in found if r[0] in ids) == sorted(want)
    assert sum(r[1] > 0 for r in want) > 5
