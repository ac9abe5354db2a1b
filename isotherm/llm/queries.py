"""The registered query of each operator: production parameters over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm import quality_rules
from isotherm.llm.common import materialise, small_batches, table, text_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def tokenizer_path() -> str:
    """The vocabulary file: ``ISOTHERM_TOKENIZER``, or the one in the public tokenizers package."""
    if path := os.environ.get("ISOTHERM_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm.bpe import Bpe

    bpe = Bpe(spark, tokenizer_path())
    coded = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(F.col("text")).alias("r"))
    return coded.select(
        "doc_id",
        Bpe.count(F.col("r.ids")).alias("n_tokens"),
        F.sha2("r.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("r.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import pii

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    detect = pii.detector(docs, pii.fit(docs))
    return docs.select("doc_id", detect(F.col("text")).alias("r")).select(
        "doc_id", "r.n_email", "r.n_ip", "r.n_card", "r.n_phone", F.sha2("r.base", 256).alias("base_sha256"), "r.spans"
    )


@query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import secret_scan

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scan = secret_scan.scanner(docs, secret_scan.fit(docs))
    return docs.select("doc_id", scan(F.col("text")).alias("r")).select(
        "doc_id", "r.n_assign", "r.n_access", "r.n_hex", F.sha2("r.base", 256).alias("base_sha256"), "r.spans", "r.n_candidates"
    )


_RULE_CUTS = ", ".join(f"({i}, {c})" for i, c in enumerate(quality_rules.CUTOFFS))
#: The counts by plain string and window functions; the cutoffs by the same exact binomial tests.
OP6_SQL = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
tri AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM tri QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (SELECT r, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
  length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [floor(1000 * n_symbols / greatest(word_chars, 1)),
  floor(1000 * n_dup_lines / greatest(n_lines, 1)), floor(1000 * n_repeat_words / greatest(n_words, 1)),
  floor(1000 * n_capitals / greatest(word_chars, 1))] AS rates FROM c),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT lang, rates FROM f JOIN good USING (doc_id) WHERE NOT base_failed),
strata AS (SELECT count(*) AS s FROM (SELECT DISTINCT lang FROM held)),
cells AS (SELECT lang, rule, i, cut, count(*) AS n, count(*) FILTER (rates[rule] > cut) AS k
  FROM held, (VALUES (1), (2), (3), (4)) a(rule), (VALUES {_RULE_CUTS}) b(i, cut) GROUP BY ALL),
tests AS (SELECT *, k <= 0.01 * n AND list_sum(list_transform(range(0, CASE WHEN k <= 0.01 * n THEN k + 1 ELSE 1 END),
  lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.01) + (n - j) * ln(0.99)))) <= 0.05 / (4 * s) AS passed FROM cells, strata),
ends AS (SELECT lang, rule, coalesce(min(i) FILTER (NOT passed), {len(quality_rules.CUTOFFS)}) AS stop FROM tests GROUP BY lang, rule),
cuts AS (SELECT e.lang, e.rule, t.cut FROM ends e JOIN tests t ON e.lang IS NOT DISTINCT FROM t.lang AND e.rule = t.rule AND t.i = e.stop - 1),
over AS (SELECT DISTINCT r FROM f JOIN cuts ON f.lang IS NOT DISTINCT FROM cuts.lang WHERE rates[rule] > cut)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND over.r IS NULL AS kept FROM f LEFT JOIN over USING (r)
"""


@query(OP6_SQL)
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import quality_rules as qr

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # the counts are taken once and read twice, by the thresholds and by the verdicts
    featured = materialise(qr.with_features(docs).drop("text"), "quality")
    rows = qr.judged(featured, qr.cutoffs(featured, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", *[F.col("features")[c].alias(c) for c in (*qr.COUNTS, "base_failed", "kept")])


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=fold != 0)
    score = toxicity.scorer(docs, model)
    rows = docs.select("doc_id", (fold == 0).alias("held_out"), score(F.col("text")).alias("r"))
    return rows.select(
        "doc_id", "held_out", "r.score", F.when(F.col("r.score") >= 0.5, 1).otherwise(0).alias("predicted"), "r.neighbours", "r.cosines"
    )


@query()
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import warc

    archives = warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import sharding

    rows = sharding.placed(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n
"""


@query(OP10_SQL)
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import minhash

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, shingle=4, percent=80)


@query()
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import suffix_dedup

    return suffix_dedup.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)


#: Every window that shares a shingle with an item of its size, compared exactly: no fingerprints.
OP2_SQL = r"""
WITH i AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
it AS (SELECT item_id, len(w) AS n, least(len(w), 5) AS k, array_to_string(w[p + 1:p + least(len(w), 5)], ' ') AS s, count(*) AS c
  FROM (SELECT item_id, w, unnest(range(0, len(w) - least(len(w), 5) + 1)) AS p FROM i WHERE len(w) > 0) GROUP BY ALL),
ds AS (SELECT doc_id, len(w) AS n_words, k, p, array_to_string(w[p + 1:p + k], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(0, greatest(len(w) - k + 1, 0))) AS p FROM d, (SELECT DISTINCT k FROM it))),
starts AS (SELECT DISTINCT doc_id, item_id, n, least(n_words, n) AS m, k, unnest(range(greatest(p - n + k, 0), least(p, greatest(n_words - n, 0)) + 1)) AS p0
  FROM ds JOIN it USING (k, s)),
inside AS (SELECT st.doc_id, st.item_id, st.n, st.m, st.k, st.p0, ds.s, count(*) AS c FROM starts st
  JOIN ds ON ds.doc_id = st.doc_id AND ds.k = st.k AND ds.p BETWEEN st.p0 AND st.p0 + st.n - st.k GROUP BY ALL),
common AS (SELECT doc_id, item_id, p0, inside.m + inside.n - 2 * inside.k + 2 AS size, sum(least(inside.c, it.c)) AS c FROM inside JOIN it USING (item_id, s) GROUP BY doc_id, item_id, p0, inside.m, inside.n, inside.k),
found AS (SELECT doc_id, item_id, p0, CAST(c AS DOUBLE) / (size - c) AS similarity FROM common WHERE 100 * c >= 80 * (size - c))
SELECT doc_id, item_id, similarity, p0 AS start_word FROM found QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, p0) = 1
"""


@query(OP2_SQL)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import decontaminate

    return decontaminate.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


#: The rows that take part as integers, every anchor scored against every row. Sums of products stay exact as doubles.
OP11_SQL = r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
  list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
p AS (SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score, b FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 3
"""


@query(OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import hard_negatives

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.col("label").cast("long")
    shifted = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(shifted)


@query()
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import language_id

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language_id.fit(docs, learn=~held_out)
    predict = language_id.scorer(docs, model)
    return docs.select("doc_id", held_out.alias("held_out"), predict(F.col("text")).alias("r")).select("doc_id", "held_out", "r.lang_pred", "r.score")


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isotherm.llm import whitening

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.apply(vectors, whitening.fit(vectors, key="vec_id"), key="vec_id").withColumnRenamed("key", "vec_id")
