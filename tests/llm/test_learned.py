"""Hard negatives, languages and whitening against brute force, with odd rows in every one."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isotherm.llm import hard_negatives, language_id, queries, whitening

SF = "/root/testdata/sf0.001"
ODD = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]


# ---- hard negatives -----------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 65, 40), (64, 64, 64), (70, 131, 97), (5, 300, 64), (100, 100, 0)])
def test_strassen_is_exact(shape):
    m, n, d = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(2**27), 2**27, (m, d)), rng.integers(-(2**27), 2**27, (n, d))
    assert (hard_negatives.strassen(a, b, 8) == a @ b.T).all()


def _mined(rows, positives=5, negatives=3):
    kept = []
    for i, (key, label, v, *_) in enumerate(rows):
        if key is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, key, label, [math.floor(256 * c) for c in v]))
    out = []
    for i, key, label, x in kept:
        if key % 50:
            continue
        scored = [(sum(p * q for p, q in zip(x, y, strict=False)), k, l, j) for j, k, l, y in kept if j != i]
        near = sorted((-s, k) for s, k, l, _ in scored if l == label)[:positives]
        for s, k in near:
            window = sorted((-t, m) for t, m, l, _ in scored if l != label and 50 * -s <= 100 * t <= 95 * -s)[:negatives]
            out += [(key, k, r + 1, m, -s, -t) for r, (t, m) in enumerate(window)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(3), [rnd.gauss(0.2, 0.3) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, 1, rows[50][2]) for i in range(60)]  # a hot vector, ties
    rows += [(2000 + 50 * i, None, [0.1]) for i in range(3)] + [(3000 + 50 * i, 2, v) for i, v in enumerate(ODD)]
    rows += [(100, 0, [0.5, 0.5]), (100, 0, [0.5, 0.5]), (-50, 2, [-1.0] * 6), (None, 1, [1.0] * 6), (4001, 7, [3.0] * 9)]
    rows = [(*r, 0) for r in rows]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, x int").withColumn("r", F.lit("clash"))
    for size in ({}, {"rows": 64, "slice_rows": 3}):
        got = hard_negatives.mine(df, **size)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(map(tuple, got.collect())) == _mined(rows)
    assert hard_negatives.mine(df.limit(0)).collect() == []
    assert hard_negatives.mine(df.filter("vec_id % 50 <> 0")).collect() == []


def test_large_components_stay_within_64_bits(spark):
    df = spark.createDataFrame([(0, 1, [1e300, 1.0]), (1, 1, [1e300, 0.0]), (2, 2, [2e5, 0.0])], "vec_id long, label int, embedding array<double>")
    assert hard_negatives.mine(df).collect() == []  # scores 2^60 and 256 * 2e5 * 2^30
    low, high = hard_negatives._window(np.array([2**60, 7, 0, -9]))
    assert low.tolist() == [2**59, 4, 0, -4] and high.tolist() == [19 * 2**60 // 20, 6, 0, -9]


# ---- languages ----------------------------------------------------------------------------


def _naive(rows, buckets):
    """The same model with plain dictionaries."""
    def plain(text):
        out = " "
        for c in text.lower():
            out += c if c.isalpha() else "" if out[-1] == " " else " "
        return out if out[-1] == " " else out + " "

    def places(text):
        if text is None or not any(c.isalpha() for c in text):
            return []
        t, found = plain(text), []
        for n in language_id.LENGTHS:
            for i in range(len(t) - n + 1):
                h = n * 0x9E3779B1 & 0xFFFFFFFF
                for c in t[i : i + n]:
                    h = (h ^ ord(c)) * 0x01000193 & 0xFFFFFFFF
                    h ^= h >> 15
                found.append((h * 0x85EBCA6B & 0xFFFFFFFF) >> 32 - (buckets.bit_length() - 1))
        return found

    counts, texts = {}, {}
    for text, lang in rows:
        hits = places(text)
        if lang is not None and hits:
            texts[lang] = texts.get(lang, 0) + 1
            mine = counts.setdefault(lang, [language_id.SMOOTHING] * buckets)
            for h in hits:
                mine[h] += 1

    def predict(text):
        hits = places(text)
        if not hits or not counts:
            return "und", 0.0
        scores = {}
        for lang in sorted(counts):
            total = sum(counts[lang])
            scores[lang] = math.log(texts[lang] / sum(texts.values())) + sum(math.log(counts[lang][h] / total) for h in hits)
        best = max(scores, key=scores.get)
        return best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())

    return predict


def test_languages_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(language_id, "PIECE", 7)
    monkeypatch.setattr(language_id, "HELD", 50)
    rnd = random.Random(2)
    alphabet = {"aa": "abc é", "bb": "bcd\n", "cc": "xyzİ9"}
    rows = [("".join(rnd.choices(alphabet[k], k=rnd.randrange(60))), k) for k in alphabet for _ in range(30)]
    rows += [(None, "aa"), ("", "bb"), ("12 34", "cc"), ("abc", None), ("x", "x"), rows[0], rows[0], ("Ab" * 500, "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "text string, lang string, part string").repartition(5)
    model = language_id.fit(df, buckets=256)
    wanted = _naive(rows, 256)
    assert model.languages == ["", "aa", "bb", "cc", "x"]
    got = language_id.classify([t for t, _ in rows], model)
    for (text, _), name, score in zip(rows, *got, strict=True):
        best, posterior = wanted(text)
        assert name == best and score == pytest.approx(posterior, rel=1e-9)
    predict = language_id.scorer(df, model)
    column = df.select("text", predict(F.col("text")).alias("r")).select("text", "r.*").collect()
    assert {(r.text, r.lang_pred) for r in column} == {(t, wanted(t)[0]) for t, _ in rows}
    assert language_id.fit(df.limit(0)).languages == []
    assert language_id.classify(["abc", None], language_id.fit(df.filter("lang is null"))) [0] == ["und", "und"]


def test_the_matrix_keeps_its_bound():
    assert language_id._buckets(4, 1 << 16) == 1 << 16
    assert language_id._buckets(1000, 1 << 16) * 1000 * 8 <= language_id.MATRIX_BYTES
    with pytest.raises(ValueError, match="too many"):
        language_id._buckets(1 << 20, 1 << 16)


def test_held_out_languages(spark):
    rows = queries.QUERIES["op12_language"](spark, SF)
    assert rows.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    both = rows.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(both) == docs.count() and all(0 <= r.score <= 1 for r in both)
    held = [r for r in both if r.held_out]
    assert 0.2 < len(held) / len(both) < 0.5 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.97


# ---- whitening ----------------------------------------------------------------------------


@pytest.mark.parametrize("case", ["spread", "equal", "rank 2", "one large", "clusters", "tiny", "negative"])
def test_feast_finds_the_largest(case):
    rng, d = np.random.default_rng(3), 40
    values = {
        "spread": np.linspace(1, 9, d), "equal": np.full(d, 2.0), "rank 2": np.r_[3.0, 1.0, np.zeros(d - 2)], "one large": np.r_[1e9, np.linspace(1, 2, d - 1)],
        "clusters": np.r_[np.full(3, 5.0), np.full(9, 5.0 - 1e-9), np.ones(d - 12)], "tiny": 1e-200 * np.arange(1, d + 1), "negative": -np.arange(1.0, d + 1),
    }[case]
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    found, vectors = whitening.feast(v, 8)
    scale = np.abs(values).max()
    assert np.abs(found - np.sort(values)[::-1][:8]).max() <= 1e-12 * scale
    assert np.abs(v @ vectors - vectors * found).max() <= 1e-11 * scale
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() <= 1e-12


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a = rng.standard_normal((17, 17))
        a = a + a.T - rng.standard_normal() * np.eye(17)
        values = np.linalg.eigvalsh(a)
        assert whitening.inertia(a) == ((values > 0).sum(), (values < 0).sum())
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 1) and whitening.inertia(np.zeros((3, 3))) == (0, 0)


def _whitened(spark, vectors, components=8):
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, x int").repartition(3)
    made = whitening.fit(df, key="vec_id", components=components)
    return sorted(whitening.apply(df, made, key="vec_id").collect(), key=lambda r: (r.key, r.component)), made


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(7)
    good = (rng.standard_normal((200, 12)) * np.linspace(0.1, 1, 12)).tolist()
    rows, made = _whitened(spark, [*good, *ODD, [0.5] * 11, good[0]])
    kept = [*range(200), 206]
    x = np.floor(np.array([*good, good[0]]) * 1024).astype(np.int64) + 100_000
    n = len(x)
    away = n * x - x.sum(axis=0)
    v = (away / n).T @ (away / n) / n
    values, vectors = np.linalg.eigh(v)
    want = away / n @ vectors[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    got = np.array([r.whitened for r in rows]).reshape(n, 8)
    assert [r.key for r in rows[::8]] == kept and [r.component for r in rows[:8]] == list(range(1, 9))
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-9
    assert [r.deviation for r in rows[::8]] == (away**2).sum(axis=1).tolist() and {r.n for r in rows} == {n}
    assert [r.explained for r in rows[:8]] == pytest.approx((values[::-1][:8] / np.trace(v)).tolist(), rel=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    assert np.abs(got.T @ got / n - np.eye(8)).max() < 1e-9


def test_whitening_without_variance(spark):
    rows, made = _whitened(spark, [[1.0, 2.0]])
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows] == [(1, 0, None, None, None), (2, 0, None, None, None)]
    rows, _ = _whitened(spark, [[0.0, 1.0, 0.0], [1.0, 1.0, 0.0], [2.0, 1.0, 0.0]])
    assert [r.whitened is None for r in rows[:3]] == [False, True, True] and rows[0].identity_error < 1e-12 and rows[0].explained == 1.0
    assert _whitened(spark, [None, [None]]) == ([], None)
    rows, _ = _whitened(spark, [[1e300], [0.0], [-1e300]])
    assert {r.deviation for r in rows if r.key != 1} == {None}
    assert whitening.apply(spark.createDataFrame([], "vec_id long, embedding array<double>"), None, key="vec_id").collect() == []
