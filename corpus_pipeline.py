"""Documents to training tokens: quality rules, near-duplicates, benchmark leaks, personal data, tokens.

Each stage works on what its predecessor kept and returns the columns of documents, the last one
tokens. Rows are told apart by document id and text together, so a repeated id does no harm; of rows equal in both,
the near-duplicate stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm import decontaminate, minhash, pii, quality_rules
from isotherm.llm.bpe import Bpe
from isotherm.llm.common import fresh, materialise, small_batches, table
from isotherm.llm.queries import tokenizer_path
from isotherm.session import ship_package


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    small_batches(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that a quality rule rejects."""
    _ready(spark)
    name = fresh(docs, "features")
    judged = quality_rules.verdicts(docs, table(spark, sf_dir, "labels"), out=name)
    return judged.filter(F.col(name)["kept"]).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group linked by 5-word shingles at 0.8."""
    _ready(spark)
    mark = fresh(docs, "mark")
    kept = minhash.near_duplicates(docs, shingle=5, percent=80, mark=mark).filter("kept")
    name, its_mark = fresh(docs, "kept_id"), fresh(docs, "kept_mark")
    kept = kept.select(F.col("doc_id").alias(name), F.col(mark).alias(its_mark))
    marked = docs.withColumn(mark, F.xxhash64("text"))
    left = marked.join(kept, F.col("doc_id").eqNullSafe(F.col(name)) & (F.col(mark) == F.col(its_mark)), "left_semi")
    return left.dropDuplicates(["doc_id", mark]).select(*docs.columns)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a benchmark passage."""
    _ready(spark)
    row = fresh(docs, "row")
    named = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = decontaminate.leaks(named, table(spark, sf_dir, "benchmark"), key=row).select(row).distinct()
    return named.join(found, row, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind."""
    _ready(spark)
    redact = pii.redactor(docs, pii.fit(docs))
    out = docs.withColumn("text", redact(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, four little-endian bytes each, with checksums of ids and decoded text."""
    _ready(spark)
    coded = docs.select("doc_id", "lang", "source", Bpe(spark, tokenizer_path()).round_trip(F.col("text")).alias("r"))
    return coded.select(
        "doc_id", "lang", "source", Bpe.count(F.col("r.ids")).alias("n_tokens"), "r.ids",
        F.sha2("r.ids", 256).alias("ids_sha256"), F.sha2(F.col("r.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark leaks", leaks),
    ("personal data", personal_data),
    ("tokens", tokens),
]

#: SQL can express neither the character-level model nor the tokenizer; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
