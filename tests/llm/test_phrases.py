import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stockwise.llm.phrases import SlicePhrases, collocations, cut_score, lowered
from stockwise.llm.textbytes import ranked, slices

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, least, first=2000, inside=50):
    counts, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    out = []
    for (lang, words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        longer = max(
            (n for (other, w), n in counts.items() if other == lang and len(w) == 3 and n >= least and words in (w[:2], w[1:])), default=0
        ) if len(words) == 2 else 0
        if longer and 100 * longer >= inside * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            ln, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (ln * r), k, ln, r))
        score, _, ln, r = min(cuts)
        out.append((lang, " ".join(words), a, ln, r, total[lang], score))
    ranked = []
    for lang in total:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(lang, k + 1, *o[1:]) for k, o in enumerate(own[:first])]
    return sorted(ranked)


def corpus(n=400):
    r = random.Random(11)
    vocabulary = [f"w{k}" for k in range(25)] + ["Äpfel", "über", "　x", "a b", "NEW", "york", "city"]
    rows = []
    for k in range(n):
        words = [r.choice(vocabulary[: r.choice((5, 32))]) + r.choice(["", "", "", ",", ".", "\n", "\x0b"]) for _ in range(r.randrange(30))]
        rows.append((k, r.choice([" ", "\t", "  "]).join(words) + " New York city", r.choice(["en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("options", [{}, {"share": 0.0}, {"share": 1.0}, {"bits": 10}, {"first": 7}, {"share": 0.1, "least": 30}])
def test_equals_counting_everything(docs_of, odd_rows, options):
    rows = corpus() + [(*r, None)[:3] for r in odd_rows]
    found = collocations(docs_of(rows), **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    options.pop("share", None), options.pop("bits", None)
    assert sorted(map(tuple, found.collect())) == slow(rows, **{"least": 10} | options)


def test_empty(docs_of):
    assert collocations(docs_of([])).collect() == []
    assert collocations(docs_of([(1, None, None), (2, " ,. ", "en")])).collect() == []


def test_wide_products(spark):
    a, left, right = 999_999_999_999_937, 999_999_999_999_961, 999_999_999_999_989
    found = spark.sql(f"SELECT {cut_score('a', 'l', 'r')} AS s FROM VALUES ({a}L, {left}L, {right}L) t(a, l, r)").first().s
    assert found == 1_000_000 * a * a // (left * right)


def test_lowered_support():
    assert lowered(10, 1.0) == 10
    assert lowered(10, 0.25) == 2
    assert lowered(10, 0.0) == 1


def test_keys_are_numbered_as_they_appear():
    r = np.random.default_rng(1)
    for keys in (r.integers(0, 50, 999), r.integers(0, 1 << 63, 99).astype(np.uint64) * np.uint64(2), np.zeros(0, np.int64)):
        first, numbers = ranked(keys)
        assert np.array_equal(keys[first][numbers], keys) and len(first) == len(set(keys.tolist()))
        assert all(keys[p] not in keys[:p] for p in first) and np.array_equal(np.sort(first), first)


def test_only_the_pairs_asked_for_are_numbered():
    (part,) = slices(pa.array(["A b a b, a b c", "b c a b"]))
    own = SlicePhrases(part, np.zeros(2, np.int64), np.ones(1, np.uint64))
    spelled = own.spell(np.arange(len(own.codes))).to_pylist()
    at = np.flatnonzero(own.follows)
    for places in (at, at[1::2], at[:0]):
        ranks, left, right, counts = own.pairs(places)
        want = [(spelled[own.words[i]], spelled[own.words[i + 1]]) for i in places]
        pairs = [(spelled[a], spelled[b]) for a, b in zip(left, right, strict=True)]
        assert [pairs[k] for k in ranks] == want and dict(zip(pairs, counts.tolist(), strict=True)) == Counter(want)
