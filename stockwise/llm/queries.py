"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

_JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        _JOBS[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_JOBS)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_exact_dedup",
    f"""
    WITH body AS (SELECT doc_id, {FOLDED} AS body FROM documents),
    best AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM body GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(b.body) AS text_sha256
    FROM body b JOIN best USING (body)
    """,
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


@query("op2_vector_shards")
def op2_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.sharding import pack_into_shards

    dealt = pack_into_shards(table(spark, sf_dir, "documents"), 40)
    return dealt.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.binary import token_lengths
    from stockwise.llm.packing import pack

    return pack(token_lengths(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")))


def vocabulary(name: str) -> str:
    """Where the public tokenizer files are on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_bpe_round_trip")
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.bpe import round_trip_digests

    return round_trip_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op4_unigram_counts")
def op4_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.unigram import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.binary import read_documents, write_ids

    manifest = write_ids(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)
    return read_documents(manifest)


def learned_quality(docs: DataFrame, labels: DataFrame):
    """The quality model, learned from labelled rows whose crc32(doc_id) mod 4 is not 2."""
    from stockwise.llm.langid import held_out
    from stockwise.llm.quality import learn

    return learn(docs, labels.filter(~held_out("doc_id", 4, 2)), "quality")


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.langid import held_out
    from stockwise.llm.quality import score

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learned_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def learned_languages(docs: DataFrame):
    """The language filters, learned from documents whose crc32(doc_id) mod 3 is not 1."""
    from stockwise.llm.langid import held_out, learn_filter

    return learn_filter(docs.filter(~held_out("doc_id", 3, 1)))


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.langid import held_out, identify

    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learned_languages(docs))
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


@query("op7_near_dedup")
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.neardup import near_components

    return near_components(table(spark, sf_dir, "documents"))


@query("op5_exact_top_k")
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), 5, 50)


#: A word of a text, as the run queries see it.
BLANKS = r"[\x20\x09-\x0D]+"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the documents, chosen by their id, repeat some of their words to the end.

    With h = crc32(decimal id) and g = h div 10, documents with h % 10 = 0 get word a + (i - a) % p for each of their n words
    i >= a, where a = g % n and p = 1 + (n - a) div (3 + g % 8); all others, and null ids, stay as they are.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), BLANKS), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumns(
        {"n": F.size("words").cast("long"), "g": F.expr("h div 10")}
    )
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("transform(words, (w, i) -> IF(i < a, w, words[int(a + (i - a) % p)]))")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.periodic import periodic_runs

    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # The list is ordered by start and period, so the first of equal exponents stays.
    best = "reduce(runs, CAST(NULL AS struct<start: long, length: long, period: long>), (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", F.expr(best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


PHRASES = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    grams AS (
        SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
        UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
        UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
    counts AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
    cuts AS (
        SELECT c.lang, c.size, c.phrase, c.n AS a, k.k, x.n AS l, y.n AS r,
               CAST(1000000::HUGEINT * c.n * c.n // (x.n::HUGEINT * y.n) AS BIGINT) AS score
        FROM (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2 AND n >= 10) c
        JOIN (VALUES (1), (2)) k(k) ON k.k < c.size
        JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k.k], ' ')
        JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k.k + 1:c.size], ' ')),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_phrases AS (
        SELECT lang, phrase, max(a) AS longer
        FROM (SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase
              FROM best WHERE size = 3)
        GROUP BY ALL)
    SELECT b.lang, CAST(row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS INTEGER) AS rank,
           b.phrase, b.a, b.l, b.r, t.n, b.score
    FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN inner_phrases i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE b.size = 3 OR i.longer IS NULL OR 100 * i.longer < 50 * b.a
    QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) <= 2000
    """


@query("op13_phrase_collocations", PHRASES)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


@query(
    "op11_line_dedup",
    r"""
    WITH split AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
        FROM documents),
    keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM split),
    frequent AS (
        SELECT line_key, max(doc_id) AS newest FROM keyed WHERE length(line_key) >= 20
        GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
    marked AS (SELECT k.*, f.newest IS NOT NULL AND k.doc_id <> f.newest AS dropped FROM keyed k LEFT JOIN frequent f USING (line_key))
    SELECT doc_id, count(*) AS n_lines, CAST(count_if(dropped) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stockwise.llm.linededup import LineIndex

    docs = table(spark, sf_dir, "documents")
    index = LineIndex(spark)
    postings = index.insert(docs)
    return index.deduplicated(docs, postings=postings).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
