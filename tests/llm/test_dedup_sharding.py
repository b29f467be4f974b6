from collections import defaultdict
from hashlib import sha256

import pytest
import zlib

from stockwise.llm.dedup import exact_groups, without_copies
from stockwise.llm.sharding import pack_into_shards

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_share, salts", [(1000, 32), (2, 3)])
def test_exact_groups(docs_of, odd_rows, hot_share, salts):
    rows = odd_rows + [(100 + k, "Copy Of All", "en") for k in range(40)]
    found = exact_groups(docs_of(rows), hot_share=hot_share, salts=salts)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected_groups(rows)


def test_non_ascii_letters_keep_their_case(docs_of):
    rows = [(1, "ÄB"), (2, "äb"), (3, "Äb")]
    assert sorted(map(tuple, exact_groups(docs_of(rows)).collect()), key=repr) == expected_groups(rows)


def test_no_python_in_the_plan(docs_of):
    plan = exact_groups(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty_table(docs_of):
    assert exact_groups(docs_of([])).collect() == []
    assert pack_into_shards(docs_of([]), 4).collect() == []


def test_without_copies_keeps_all_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    texts = [(r.text or "").translate(LOWER) for r in kept.select("text", "doc_id").distinct().collect()]
    assert len(texts) == len(set(texts)) == len({(r[1] or "").translate(LOWER) for r in odd_rows})


def test_shards_are_whole_and_gapless(docs_of, odd_rows):
    rows = odd_rows + [(1000 + k, f"text number {k % 700} " + "x" * (k % 97)) for k in range(3000)]
    found = pack_into_shards(docs_of(rows), 4, blocks=16, cell_rows=50).collect()
    assert len(found) == len(rows)
    expected = sorted((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows if r[0] is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in found if r.doc_id is not None) == expected
    slots, sums = defaultdict(list), defaultdict(int)
    for r in found:
        slots[r.shard].append(r.slot)
        sums[r.shard] += r["size"]
    assert set(slots) == set(range(4))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_balance_and_keep_groups(docs_of):
    rows = [(k, f"group {k % 500} " + "word " * (k % 500 % 37)) for k in range(2000)]
    rows += [(5000 + k, "one hot text, a third of all rows") for k in range(1000)]
    found = pack_into_shards(docs_of(rows), 8).collect()
    sums, counts, where = defaultdict(int), defaultdict(int), defaultdict(set)
    text = dict(rows)
    for r in found:
        sums[r.shard] += r["size"]
        counts[r.shard] += 1
        where[text[r.doc_id]].add(r.shard)
    mean = sum(sums.values()) / 8
    assert max(sums.values()) < 1.03 * mean and min(sums.values()) > 0.97 * mean
    assert max(counts.values()) < 1.2 * len(rows) / 8
    assert all(len(s) == 1 for t, s in where.items() if not t.startswith("one hot"))
    assert len(where["one hot text, a third of all rows"]) > 1


def test_shards_balance_bytes_tokens_and_rows(docs_of):
    """A third of the rows have no text, so the hot group is small in bytes and large in rows."""
    rows = [(k, f"text {k} " + "word " * (200 + k * 7919 % 200)) for k in range(4000)]
    rows += [(10_000 + k, "" if k % 2 else None) for k in range(2000)]
    found = pack_into_shards(docs_of(rows), 8, cell_rows=100).collect()
    assert len(found) == len(rows)
    text = dict(rows)
    sums = {n: [0] * 8 for n in ("bytes", "tokens", "rows")}
    for r in found:
        sums["bytes"][r.shard] += r["size"]
        sums["tokens"][r.shard] += (text[r.doc_id] or "").count(" ") + 1
        sums["rows"][r.shard] += 1
    for name, limit in (("bytes", 0.03), ("tokens", 0.05), ("rows", 0.05)):
        mean = sum(sums[name]) / 8
        assert max(abs(x - mean) for x in sums[name]) < limit * mean, (name, sums[name])
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_an_id_keeps_only_the_text_that_stays(docs_of):
    rows = [(5, "alpha"), (5, "beta"), (9, "beta"), (9, "beta"), (None, "gamma"), (None, None), (7, "")]
    kept = sorted(((r.doc_id, r.text) for r in without_copies(docs_of(rows)).collect()), key=repr)
    assert kept == sorted([(5, "alpha"), (9, "beta"), (9, "beta"), (None, "gamma"), (7, "")], key=repr)
