import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isotherm.llm.bpe import Bpe, Vocabulary, decode_ids
from isotherm.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def _texts():
    rnd = random.Random(4)
    pool = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x310), *range(0x391, 0x3C9)]]
    pool += ["\t", "\n", "\x1c", "\x85", " ", "　", "<|endoftext|>", "<|startoftext|>", "'LL", "don't ", "the ", "é", "½", "😀", "한"]
    made = ["".join(rnd.choices(pool, k=rnd.randrange(40))) for _ in range(300)]
    return [None, "", " ", "a" * 4000, "ΟΔΟΣ Σας", "ab" * 300 + "!" * 200, *made]


def test_ids_and_round_trip_equal_the_library(spark, docs_of, library):
    texts = _texts()
    bpe = Bpe(spark, tokenizer_path())
    rows = docs_of(list(enumerate(texts))).select("doc_id", bpe.round_trip(F.col("text")).alias("r"), bpe.encode(F.col("text")).alias("e"))
    got = {r.doc_id: r for r in rows.collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(got[i].r.ids), "<u4").tolist() == ids
        assert bytes(got[i].e) == bytes(got[i].r.ids)
        assert got[i].r.decoded == library.decode(ids, skip_special_tokens=False)


def test_scan_and_heap_merge_alike():
    with open(tokenizer_path(), encoding="utf-8") as file:
        v = Vocabulary(file.read())
    rnd = random.Random(1)
    for _ in range(50):
        word = "".join(rnd.choice("abcdeorth") for _ in range(rnd.randrange(1, 60))).encode()
        parts = [v.inner[b] for b in word[:-1]] + [v.final[word[-1]]]
        assert v.merge_short(list(parts)) == v.merge_long(list(parts))


def test_decode_skips_unknown_ids(spark):
    with open(tokenizer_path(), encoding="utf-8") as file:
        v = Vocabulary(file.read())
    assert decode_ids(v, np.array([320, 10**6], "<u4").tobytes()) == v.tokens[320]
    one = spark.range(1).select(Bpe(spark, tokenizer_path()).decode(F.lit(None).cast("binary")).alias("t"))
    assert one.first().t == ""
