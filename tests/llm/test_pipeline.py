"""Every stage takes effect on what the one before kept."""

import random

import numpy as np
import pytest

import corpus_pipeline
from isotherm.llm import pii
from isotherm.llm.bpe import Vocabulary, decode_ids
from isotherm.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tables(spark, docs_of, tmp_path_factory):
    rnd = random.Random(12)
    some = lambda n: " ".join(f"word{rnd.randrange(5000)}" for _ in range(n))
    item = some(30)
    clean = [(i, some(80)) for i in range(20)]
    rows = [
        *clean, (100, clean[3][1]), (101, clean[4][1] + " more"), (102, some(40) + " " + item + " " + some(40)), (103, "too short"),
        (104, some(60) + " write to ann.lee@example.com " + some(5)), (105, None), (105, ""), (106, "same words " * 60), (7, clean[7][1]),
    ]
    folder = tmp_path_factory.mktemp("tables")
    docs_of(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), dict(rows)


def test_stages(spark, tables):
    folder, texts = tables
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), "test")
        kept.append(sorted(r.doc_id for r in docs.collect()))
        assert n == 4 or docs.columns == columns, name
    assert kept[0] == sorted([*range(20), 7, 100, 101, 102, 104])
    assert kept[1] == [*range(20), 102, 104]
    assert kept[2] == kept[3] == kept[4] == [*range(20), 104]
    with open(tokenizer_path(), encoding="utf-8") as file:
        vocabulary = Vocabulary(file.read())
    for r in docs.collect():
        text = texts[r.doc_id].replace("ann.lee@example.com", "[EMAIL]")
        assert not pii.base_spans(text)
        decoded = decode_ids(vocabulary, bytes(r.ids)).replace(" ", "").replace("</w>", "")
        assert decoded == text.lower().replace(" ", "")
        assert r.n_tokens == len(np.frombuffer(bytes(r.ids), "<u4"))
