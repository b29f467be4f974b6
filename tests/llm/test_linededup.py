import random
from collections import defaultdict

import numpy as np
import pytest

from stockwise.llm.cuckoo import CuckooFilter
from stockwise.llm.linededup import BLANK, LineIndex

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(BLANK).translate(UPPER)


def expected(index_rows, rows, least_docs=3, least_length=20):
    holders = defaultdict(list)
    for key, text, *_ in index_rows:
        for line in {key_of(x) for x in (text or "").split("\n")}:
            if len(line) >= least_length:
                holders[line].append(key)
    out = []
    for doc_id, text, *_ in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            held = holders.get(key_of(line), [])
            newest = max((h for h in held if h is not None), default=None)
            if len(held) < least_docs or newest is None or doc_id == newest:
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def corpus(n, seed=3, first=100):
    r = random.Random(seed)
    common = [f"  A common line with number {k} in it \r" for k in range(40)] + ["short line", "ÄÖÜ äöü éèê ñ and so on ÄÖ", "", "\t", "x" * 19, "y" * 20]
    rows = []
    for k in range(n):
        lines = [r.choice(common) if r.random() < 0.7 else f"own line {r.random()} of the text" for _ in range(r.randrange(8))]
        rows.append((first + k, "\n".join(lines) if lines else None))
    return rows


def answer(index, docs, **more):
    return sorted((tuple(r) for r in index.deduplicated(docs, **more).collect()), key=repr)


def test_whole_table(spark, docs_of, odd_rows):
    hot = "This line is in a third of all documents, or more."
    rows = [r[:2] for r in odd_rows] + [(k, (t or "") + (f"\n{hot}\n{hot.upper()} " if k % 2 else "")) for k, t in corpus(300)]
    index, docs = LineIndex(spark, shards=5), docs_of(rows)
    postings = index.insert(docs)
    want = expected(rows, rows)
    assert answer(index, docs, postings=postings) == want
    assert answer(index, docs) == want
    assert sum(w[3] for w in want) > 300


def test_documents_come_and_go(spark, docs_of, tmp_path):
    one, two, three = corpus(120, 1, 0), corpus(90, 2, 500), corpus(60, 4, 900)
    folder = str(tmp_path / "index")
    index = LineIndex(spark, folder, shards=3)
    index.insert(docs_of(one))
    before = [sorted(map(tuple, index.counts().collect())), answer(index, docs_of(one))]
    index.insert(docs_of(two))
    assert answer(index, docs_of(one + two)) == expected(one + two, one + two)
    # Taking the second batch out again leaves the counts and results of the first.
    index = LineIndex(spark, folder)
    assert index.shards == 3 and index.step == 2
    index.delete(docs_of(two))
    assert [sorted(map(tuple, index.counts().collect())), answer(index, docs_of(one))] == before
    gone = [r for r in one if r[0] % 3]
    index.delete(docs_of(gone))
    left = [r for r in one if not r[0] % 3]
    assert answer(index, docs_of(one)) == expected(left, one)
    index.insert(docs_of(three + gone[:10]))
    assert answer(index, docs_of(one + three)) == expected(left + three + gone[:10], one + three)
    # No false negatives, and what became rare has left the filters.
    frequent = {r.digest for r in index.counts().filter("n >= 3").collect()}
    codes = np.array([r.c for r in index.counts().filter("n >= 3").selectExpr("xxhash64(digest) AS c").collect()], np.int64).view(np.uint64)
    filters = {r.shard: CuckooFilter.from_bytes(bytes(r["filter"])) for r in index.filters().collect()}
    assert sum(int(np.count_nonzero(f.table)) + len(f.beside) for f in filters.values()) == len(frequent)
    assert all(filters[int(np.int64(c.view(np.int64)) % 3)].contains(np.array([c]))[0] for c in codes)


def test_empty(spark, docs_of):
    index = LineIndex(spark)
    index.insert(docs_of([]))
    index.delete(docs_of([]))
    assert answer(index, docs_of([])) == []
    assert answer(index, docs_of([(1, None), (2, "a\n")])) == [(1, "", 1, 0), (2, "a\n", 2, 0)]


@pytest.mark.parametrize("room", [10, 5000, 20_000])
def test_cuckoo_filter(room):
    r = np.random.default_rng(5)
    codes = r.integers(0, 1 << 64, 8000, dtype=np.uint64)
    f = CuckooFilter(CuckooFilter.buckets_for(room))
    own = codes[: min(room, 5000)]
    f.insert(own[::2])
    f.insert(own[1::2])
    f = CuckooFilter.from_bytes(f.to_bytes())
    assert f.contains(own).all()
    assert f.contains(codes[5000:]).mean() < 0.01
    f.delete(own[: len(own) // 2])
    assert f.contains(own[len(own) // 2 :]).all()
    f.delete(own[len(own) // 2 :])
    assert not f.table.any() and not f.beside
    # Too many codes for the table: still none is lost.
    small = CuckooFilter(4)
    small.insert(codes[:60])
    assert small.contains(codes[:60]).all() and len(small.beside) >= 44
    small.delete(codes[:60])
    assert not small.table.any() and not small.beside
