"""Every registered query: columns, types, rows, and what a plain reading of the table says about them."""

import hashlib
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from isotherm.llm import queries

SF = "/root/testdata/sf0.001"
LONG, INT, TEXT, BOOL, REAL = "bigint", "int", "string", "boolean", "double"
COLUMNS = {
    "op1_toxicity": {"doc_id": LONG, "held_out": BOOL, "score": REAL, "predicted": INT},
    "op3_secrets": {"doc_id": LONG, "n_assign": LONG, "n_access": LONG, "n_hex": LONG, "base_sha256": TEXT, "spans": TEXT},
    "op4_bpe": {"doc_id": LONG, "n_tokens": LONG, "ids_sha256": TEXT, "decoded_sha256": TEXT},
    "op5_shards": {"doc_id": LONG, "size": LONG, "text_crc32": LONG, "law": TEXT, "shard": INT, "slot": LONG, "grown_shard": INT},
    "op6_quality": {"doc_id": LONG, "n_words": LONG, "word_chars": LONG, "n_symbols": LONG, "n_dup_lines": LONG, "n_repeat_words": LONG, "base_failed": BOOL, "kept": BOOL},
    "op7_warc": {"page_id": LONG, "payload_bytes": LONG, "payload_digest": TEXT, "record_type": TEXT, "refers_to": LONG},
    "op8_pii": {"doc_id": LONG, "n_email": LONG, "n_ip": LONG, "n_card": LONG, "n_phone": LONG, "base_sha256": TEXT, "spans": TEXT},
    "op9_suffix_dedup": {"doc_id": LONG, "n_bytes": LONG, "n_removed": LONG, "n_spans": LONG, "kept_sha256": TEXT},
    "op10_minhash": {"doc_id": LONG, "n_shingles": LONG, "component_id": LONG, "kept": BOOL},
    "op11_hard_negatives": {"anchor_id": LONG, "positive_id": LONG, "rank": INT, "negative_id": LONG, "positive_score": LONG, "negative_score": LONG},
    "op12_language": {"doc_id": LONG, "held_out": BOOL, "lang_pred": TEXT, "score": REAL},
    "op13_whitening": {"vec_id": LONG, "component": INT, "n": LONG, "deviation": LONG, "whitened": REAL, "explained": REAL, "identity_error": REAL},
}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def _sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, texts, name):
    rows = queries.QUERIES[name](spark, SF)
    assert COLUMNS[name].items() <= dict(rows.dtypes).items()
    got = rows.collect()
    if "doc_id" in rows.columns:
        assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        text = texts.get(r["doc_id"], "") if "doc_id" in rows.columns else ""
        if name == "op1_toxicity":
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if name in ("op3_secrets", "op8_pii"):
            base = ",".join(s for s in r.spans.split(",") if s and (name == "op8_pii" or not s.startswith("model")))
            assert name == "op8_pii" or r.base_sha256 == _sha(base)
            assert all(0 <= int(s.split(":")[1]) < int(s.split(":")[2]) <= len(text) for s in r.spans.split(",") if s)
        if name == "op5_shards":
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text.encode()) + 1, zlib.crc32(text.encode()), "bytes", None)
        if name == "op9_suffix_dedup":
            assert r.n_bytes == len(text.encode()) and 0 <= r.n_removed <= r.n_bytes and (r.n_removed > 0 or r.kept_sha256 == _sha(text))
        if name == "op10_minhash":
            assert r.kept == (r.doc_id == r.component_id) and r.component_id <= r.doc_id
        if name == "op12_language":
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_ids_of_the_tokenizers_library(spark, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    plain.no_truncation()
    plain.no_padding()
    for r in queries.QUERIES["op4_bpe"](spark, SF).collect():
        ids = plain.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == _sha(plain.decode(ids, skip_special_tokens=False))


def test_inner_names_as_columns_of_documents(spark):
    """Columns that happen to be called as inner ones are neither read nor in the way."""
    from isotherm.llm import language_id, minhash, pii, secret_scan, sharding, suffix_dedup, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for name in ("_k", "_part", "key", "mark", "t", "t1", "set", "n", "sig", "bucket", "root", "part", "r", "row", "size", "shard", "hash"):
        docs = docs.withColumn(name, F.lit("clash"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    n = docs.count()
    assert docs.select(toxicity.scorer(docs, toxicity.fit(docs, labels))(F.col("text"))).count() == n
    assert docs.select(secret_scan.scanner(docs, secret_scan.fit(docs, train_docs=20))(F.col("text"))).count() == n
    assert docs.select(pii.detector(docs, pii.fit(docs))(F.col("text"))).count() == n
    assert minhash.near_duplicates(docs).count() == n and suffix_dedup.repeats(docs).count() == n
    assert sharding.placed(docs, shards=2).count() == n
    assert docs.select(language_id.scorer(docs, language_id.fit(docs))(F.col("text"))).count() == n
