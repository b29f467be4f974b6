import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stockwise.llm import neardup
from stockwise.llm.queries import op7_near_dedup, table, vocabulary

SF_DIR = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute(rows):
    """(n_shingles, component) per id, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    index, common = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    for ids in index.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                common[a, b] += 1
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def made_rows(seed=7):
    """Clusters of near copies, chains, a shared passage, a hot group, short and odd texts."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(2000)]
    fresh = lambda n: [r.choice(words) for _ in range(n)]
    passage, rows, i = fresh(60), [], 0
    for _ in range(25):
        base = fresh(r.randint(5, 150))
        for _ in range(r.randint(1, 6)):
            own = list(base)
            for _ in range(r.randint(0, 1 + len(own) // 25)):
                own[r.randrange(len(own))] = r.choice(words)
            rows.append((i := i + 1, " ".join(own)))
    chain = fresh(120)
    for k in range(15):  # each like the next, the ends unlike
        rows.append((i := i + 1, " ".join(chain[k * 6 :] + [f"c{j}" for j in range(k * 6)])))
    for _ in range(60):  # only a passage in common
        rows.append((i := i + 1, " ".join(fresh(50) + passage + fresh(50))))
    hot = fresh(100)
    for k in range(120):
        own = list(hot)
        own[r.randrange(100)] = f"h{k}"
        rows.append((i := i + 1, " ".join(own)))
    r.shuffle(rows)
    return rows + [(9001, "Three short words"), (9002, "three SHORT words"), (9003, ""), (9004, None), (9005, " \t")]


@pytest.mark.parametrize("block, block_bytes", [(128, 4 << 20), (10, 4 << 20), (1000, 3000)])
def test_components_equal_brute_force(docs_of, block, block_bytes):
    rows = made_rows()
    found = neardup.near_components(docs_of(rows), block=block, block_bytes=block_bytes).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)
    assert len(found) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_odd_rows(docs_of, odd_rows):
    found = neardup.near_components(docs_of(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by[1].component_id == by[2].component_id == 1 and by[3].component_id == 3 and by[4].n_shingles == 0
    assert by[6].component_id == by[7].component_id == 6
    nulls = [r for r in found if r.doc_id is None]
    assert len(nulls) == 2 and all(r.component_id is None and r.kept for r in nulls)
    assert neardup.near_components(docs_of([])).collect() == []
    docs = docs_of(odd_rows)
    kept = neardup.without_near_copies(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 8, 9, 10, None}


def test_an_id_with_two_texts_links_both(docs_of):
    a, b = "one two three four five six seven", "red blue green black white pink grey"
    found = neardup.near_components(docs_of([(5, a), (5, b), (3, a), (4, b), (9, "x y z x y z")])).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 3), (3, 3), (4, 3), (9, 9)}


def test_links_grow_with_the_cluster_not_its_square(spark):
    """Near copies of one text over many blocks: about one link per text and block."""
    r = random.Random(8)
    base = [r.choice([f"w{k}" for k in range(500)]) for _ in range(80)]
    for n in (256, 1024):
        rows = [(k, " ".join(base[:40] + [f"own{k}"] + base[40:])) for k in range(n)]
        texts = spark.createDataFrame(rows, "doc_id long, text string")
        units = texts.select(F.lit(1).cast("long").alias("unit"), F.col("doc_id").alias("rep"), F.lit(n // 32).cast("long").alias("blocks"))
        links = neardup.cluster_links(units, texts, 75)
        assert n - 1 <= links.count() < 1.1 * n
        assert {x.component for x in neardup.components(links).collect()} == {0}


def test_strays_in_a_cluster_are_compared_with_all(spark):
    """Copies, and texts that are linked with each other only, wherever the blocks put them."""
    r = random.Random(9)
    words = [f"w{k}" for k in range(500)]
    base = [r.choice(words) for _ in range(60)]
    rows = [(k, " ".join(base[:30] + [f"own{k}"] + base[30:])) for k in range(200)]
    for k in range(1000, 1060, 2):
        own = [r.choice(words) for _ in range(60)]
        rows += [(k, " ".join(own)), (k + 1, " ".join(own[:50] + ["x"] + own[51:]))]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    units = texts.select(F.lit(1).cast("long").alias("unit"), F.col("doc_id").alias("rep"), F.lit(13).cast("long").alias("blocks"))
    found = {x.node: x.component for x in neardup.components(neardup.cluster_links(units, texts, 75)).collect()}
    assert found == {i: c for i, (_, c) in brute(rows).items()}


def test_an_id_with_many_texts_loses_no_link(docs_of):
    """Every text of a repeated id is compared, whichever stands first."""
    r = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    own = [[r.choice(words) for _ in range(50)] for _ in range(4)]
    near = [x[:25] + ["new"] + x[26:] for x in own]
    rows = [(5, " ".join(x)) for x in own] + [(10 + k, " ".join(x)) for k, x in enumerate(near)] + [(99, "alone " * 9)]
    found = {r.doc_id: r.component_id for r in neardup.near_components(docs_of(rows)).collect()}
    assert found == {5: 5, 10: 5, 11: 5, 12: 5, 13: 5, 99: 99}


def test_sketch_coordinates_estimate_the_similarity():
    r = np.random.default_rng(1)
    for size in (3, 40, 2000):
        pool = r.integers(0, 1 << 63, size * 2, dtype=np.uint64)
        a, b = np.sort(pool[:size]), np.sort(pool[size // 3 : size // 3 + size])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = neardup.sketches(np.concatenate((a, b)), np.array([0, size, 2 * size]), 1024)
        assert (s < np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        assert abs((s[0] == s[1]).mean() - true) < 0.08


def test_components_of_a_long_chain(spark):
    r = random.Random(2)
    names = list(range(300))
    r.shuffle(names)
    edges = [(names[k], names[k + 1]) for k in range(199)] + [(names[k], names[k + 1]) for k in range(200, 299)]
    found = {r.node: r.component for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: min(names[:200]) for n in names[:200]} | {n: min(names[200:]) for n in names[200:]}


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    found = op7_near_dedup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)


def test_pipeline_stages(spark, docs_of, tmp_path):
    """Each stage against its own rule on what its predecessor kept."""
    r = random.Random(3)
    english, german = "the river and stone are under morning sky green hill".split(), "der Fluss und Stein liegen unter dem Himmel am Berg".split()
    rows = []
    for k in range(120):
        words, lang = (english, "en") if k % 2 else (german, "de")
        rows.append((k, " ".join(r.choice(words) for _ in range(40)), lang))
    rows += [(200 + k, " ".join(r.choice(["buy", "win"]) + "$$$" for _ in range(40)), "en") for k in range(40)]
    rows += [(400 + k, " ".join("".join(r.choice("qxzjvkw") for _ in range(6)) for _ in range(30)), None) for k in range(5)]
    rows += [(500, "sky", "en"), (501, "ok", "en"), (502, "Berg", None)]
    rows += [(300, rows[3][1].upper(), "en"), (301, rows[3][1], "en"), (302, rows[5][1] + " sky", "en"), (303, None, None), (304, "12 34", None)]
    docs_of(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 1, 0) for k in range(100)] + [(200 + k, 0, 0) for k in range(35)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs = table(spark, str(tmp_path), "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        kept.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {x.doc_id: x.text for x in docs.collect()}
    assert not any(200 <= i < 240 for i in seen["quality"]) and set(range(120)) <= set(seen["quality"])
    gibberish = set(range(400, 405))
    assert gibberish & set(seen["quality"]) and {500, 501, 502} <= set(seen["language"])
    assert set(seen["language"]) == {i for i, t in seen["quality"].items() if t and re.search("[A-Za-z]", t)} - gibberish
    largest = {}
    for i, t in seen["language"].items():
        largest[t.lower()] = max(i, largest.get(t.lower(), i))
    assert set(seen["exact_dedup"]) == set(largest.values())
    expected = brute(list(seen["exact_dedup"].items()))
    assert set(seen["near_dedup"]) == {i for i, (_, c) in expected.items() if i == c}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in packed} == set(seen["near_dedup"])
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    assert sum(x.n_tokens for x in packed) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in seen["near_dedup"].values())


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_pipeline_on_odd_tables(spark, docs_of, odd_rows, tmp_path, rows):
    """Nulls, empty and long texts, repeated ids, clashing columns, no labels; and no rows at all."""
    given = odd_rows + [(11, "alpha beta gamma"), (11, "delta epsilon"), (12, "delta epsilon")] if rows == "odd" else []
    docs_of(given).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")
    # Without labels nothing reaches the bar, so the later stages get the whole table here.
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).collect() == []
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
    kept = corpus_pipeline.exact_dedup(spark, docs, str(tmp_path)).collect()
    assert {(r.doc_id, r.text) for r in kept if r.doc_id in (11, 12)} == ({(11, "alpha beta gamma"), (12, "delta epsilon")} if given else set())
    packed = corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()
    assert len({x.doc_id for x in packed}) == len({r[0] for r in given})
