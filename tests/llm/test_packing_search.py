import random
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockwise.llm.packing import best_fit, byte_lengths, joint_plan, pack, sequence_cost, sized_runs
from stockwise.llm.topk import top_k


def one_by_one(lengths, capacities, opening):
    """Best fit by descending length, a document at a time; the contents of all bins."""
    bins, order, left = [], [], sum(lengths)
    for length in sorted(lengths, reverse=True):
        at = bisect_left(order, (length,))
        if at < len(order):
            room, k = order.pop(at)
        else:
            fits = [c for c in capacities if c >= max(length, opening or 0)] or [capacities[-1]]
            room, k = min(fits, key=lambda c: (sequence_cost(c) / min(c, left), c)), len(bins)
            bins.append([])
        bins[k].append(length)
        insort(order, (room - length, k))
        left -= length
    return bins


def test_histogram_plan_equals_one_by_one():
    r = random.Random(3)
    for capacities in ([64], [16, 32, 64]):
        for _ in range(30):
            lengths = [r.randint(1, capacities[-1]) for _ in range(r.randint(1, 200))]
            plan = best_fit(Counter(lengths), capacities, sequence_cost, capacities[-1])
            contents = defaultdict(list)
            for length, a, b, first, per, used, size in sized_runs(plan):
                for rank in range(a, b):
                    contents[first + (rank - a) // per].append((used + (rank - a) % per * length, length, size))
            packed = Counter(x[1] for c in contents.values() for x in c)
            assert packed == Counter(lengths)
            for c in contents.values():
                c.sort()
                assert [x[0] for x in c] == list(np.cumsum([0] + [x[1] for x in c])[:-1])
                used, (size,) = sum(x[1] for x in c), {x[2] for x in c}
                assert size == min(s for s in capacities if s >= used)  # downsized to the contents
            assert len(contents) == plan.n_bins
            assert plan.n_bins <= len(one_by_one(lengths, capacities, capacities[-1])) + 1


def test_joint_plan_is_the_cheapest():
    counts = Counter(random.Random(1).choices(range(1, 60), k=500))
    best = joint_plan(counts, [16, 32, 64], sequence_cost)
    assert all(best.cost <= best_fit(counts, [16, 32, 64], sequence_cost, o).cost for o in (None, 16, 32, 64))


def test_pack(spark, docs_of, odd_rows):
    rows = odd_rows + [(100 + k, "x" * (k * 37 % 500)) for k in range(600)] + [(900 + k, "same") for k in range(300)]
    found = pack(byte_lengths(docs_of(rows)), (256, 1024, 4096), cell_rows=20).collect()
    assert sum(r.n_tokens for r in found) == sum(len((r[1] or "").encode()) + 1 for r in rows)
    by_doc = Counter()
    for r in found:
        by_doc[r.doc_id] += r.n_tokens
    expected = Counter()
    for r in rows:
        expected[r[0]] += len((r[1] or "").encode()) + 1
    assert by_doc == expected
    bins = defaultdict(list)
    for r in found:
        bins[r.bin_id].append((r.bin_offset, r.n_tokens, r.capacity))
    for b in bins.values():
        b.sort()
        assert [x[0] for x in b] == list(np.cumsum([0] + [x[1] for x in b])[:-1])
        used = sum(x[1] for x in b)
        assert {x[2] for x in b} == {min(c for c in (256, 1024, 4096) if c >= used)}


def test_pack_nothing(spark):
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens long")).collect() == []
    assert pack(spark.createDataFrame([(1, None), (2, 0), (3, -4)], "doc_id long, n_tokens long")).collect() == []


def brute(rows, k, every):
    good = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = np.floor(256 * np.array(v, np.float64)).astype(np.int64)
        if key not in good or x.astype("<i4").tobytes() < good[key].astype("<i4").tobytes():
            good[key] = x
    out = []
    for q in good:
        if q % every == 0:
            scored = sorted((-int(good[q] @ x), i) for i, x in good.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(size=12) * r.choice([0.1, 1, 5])]) for i in range(700)]
    rows += [(1000 + i, rows[50][1]) for i in range(300)]  # a hot vector
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 10), (2050, [float("nan")] * 12), (None, rows[0][1]), rows[3], (2100, [0.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS band", "2 AS rank", "'x' AS values")
    found = sorted(map(tuple, top_k(df, 5, 50, band_rows=128, head=4).select("query_id", "rank", "vec_id", "score").collect()))
    assert found == brute(rows, 5, 50)


def test_top_k_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k(spark.createDataFrame([], schema)).collect() == []
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [-1.0, 3.0])]
    assert sorted(map(tuple, top_k(spark.createDataFrame(few, schema)).collect())) == brute(few, 5, 50)


def wide_rows():
    r = np.random.default_rng(8)
    rows = [(i, [float(x) for x in r.normal(size=6)] + [0.0, 0.0]) for i in range(300)]
    rows += [(400 + i, [float(x) for x in r.normal(size=6) * 10.0 ** (4 + i % 3)] + [0.0, 0.0]) for i in range(60)]
    # Products beyond 64 bits that cancel: the score itself fits.
    return rows + [(500, [1.0] + [0.0] * 5 + [1e12, 1e12]), (501, [2.0] + [0.0] * 5 + [1e12, -1e12])]


def exact_brute(rows, k, every):
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    out = []
    for q in (i for i in whole if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_keeps_large_components(spark):
    rows = wide_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, top_k(df, 5, 50, band_rows=64, head=3).select("query_id", "rank", "vec_id", "score").collect()))
    expected = exact_brute(rows, 5, 50)
    assert all(abs(r[3]) < 2**63 for r in expected) and any(r[0] == 500 for r in expected)
    assert found == expected


def test_top_k_scores_beyond_long(spark):
    schema = "vec_id long, embedding array<double>"
    # Far below the longs, but not among the best.
    rows = [(0, [1e15, 1.0]), (1, [-1e15, 0.0]), (2, [0.0, 2.0])]
    assert sorted(map(tuple, top_k(spark.createDataFrame(rows, schema), 1).collect())) == exact_brute(rows, 1, 50)
    for bad in ([(0, [1e15, 1.0]), (1, [1e15, 0.0])], [(0, [1e15, 1.0]), (1, [-1e15, 0.0])], [(0, [1e200, 0.0]), (1, [1.0, 0.0])]):
        with pytest.raises(Exception, match="does not fit a long|too large"):
            top_k(spark.createDataFrame(bad, schema), 1).collect()
