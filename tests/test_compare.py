import itertools
import math

import numpy as np
import pytest

from isotherm.operators import compare as cp
from isotherm.operators import profile as pf


def pairs(spark, a, b):
    return spark.createDataFrame(
        [(int(x), int(y)) for x, y in zip(a, b)], "cluster_a int, cluster_b int"
    ).repartition(3)


def ari_by_pairs(a, b):
    both = only_a = only_b = 0
    n = len(a)
    for i, j in itertools.combinations(range(n), 2):
        x, y = a[i] == a[j], b[i] == b[j]
        both += x and y
        only_a += x
        only_b += y
    total = n * (n - 1) / 2
    expected = only_a * only_b / total
    top = (only_a + only_b) / 2 - expected
    return 1.0 if top == 0 else (both - expected) / top


def nmi_by_counts(a, b):
    n = len(a)
    def h(values):
        _, c = np.unique(values, return_counts=True)
        return -sum(k / n * math.log(k / n) for k in c)
    ha, hb, hab = h(a), h(b), h([x * 1000 + y for x, y in zip(a, b)])
    return 1.0 if ha + hb == 0 else (ha + hb - hab) / ((ha + hb) / 2)


rng = np.random.default_rng(4)
BASE = rng.integers(0, 5, 80)
CASES = {
    "identical": (BASE, BASE),
    "permuted": (BASE, (BASE + 2) % 5),
    "moved": (BASE, np.r_[(BASE[0] + 1) % 5, BASE[1:]]),
    "independent": (BASE, rng.integers(0, 4, 80)),
    "single": (np.zeros(80, int), np.zeros(80, int)),
    "one_single": (np.zeros(80, int), BASE),
    "singletons": (np.arange(80), np.arange(80)),
}


@pytest.mark.parametrize("name", CASES)
def test_scores(spark, name):
    a, b = CASES[name]
    row = cp.label_scores(pairs(spark, a, b)).head()
    assert row["n"] == 80
    assert row["ari"] == pytest.approx(ari_by_pairs(a, b), abs=1e-12)
    assert row["nmi"] == pytest.approx(nmi_by_counts(a, b), abs=1e-9)
    assert row["agreement_rate"] == pytest.approx((a == b).mean())


def test_verdicts(spark):
    rows = [(0.9, 0.9, 0.9), (0.9, 0.6, 0.7), (0.55, 0.9, 0.5), (0.31, 0.2, 0.0), (0.3, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "ari double, nmi double, agreement_rate double")
    got = [(r["ari_band"], r["nmi_band"], r["verdict"]) for r in cp.validation_verdict(df).collect()]
    assert got == [
        ("excellent", "excellent", "EXCELLENT"), ("excellent", "good", "GOOD"), ("good", "excellent", "MODERATE"),
        ("moderate", "moderate", "MODERATE"), ("low", "moderate", "LOW")]


def test_tables(spark):
    df = pairs(spark, [0, 0, 0, 0, 1, 1], [2, 2, 5, 5, 5, 7])
    best = {r["cluster_a"]: (r["cluster_b"], r["overlap"], r["total"], r["share"]) for r in cp.best_mapping(df).collect()}
    assert best == {0: (2, 2, 4, 0.5), 1: (5, 1, 2, 0.5)}
    wide = {r["cluster_a"]: r.asDict() for r in cp.confusion_wide(df).collect()}
    assert wide[1] == {"cluster_a": 1, "2": 0, "5": 1, "7": 1}
    sizes = {r["label"]: (r["n_a"], r["n_b"]) for r in cp.paired_sizes(df).collect()}
    assert sizes == {0: (4, 0), 1: (2, 0), 2: (0, 2), 5: (0, 3), 7: (0, 1)}
    rate = cp.agreement_rate(df).head()
    assert (rate["n_agree"], rate["n_disagree"]) == (0, 6)


def test_profile(spark):
    df = spark.createDataFrame(
        [(0, 46.0, -120.0, 5.0), (0, 47.0, -120.5, 7.0), (1, 48.0, -124.0, 1.0)],
        "cluster int, lat double, lon double, T2M_mean double",
    )
    profile = pf.cluster_profile(df).orderBy("cluster").collect()
    assert profile[0]["n_locations"] == 2 and profile[0]["Temperature"] == 6.0
    assert [r["region"] for r in profile] == ["Eastern Washington", "Western Washington"]
    scaled = pf.profile_minmax(pf.cluster_profile(df), ["Temperature"]).orderBy("cluster").collect()
    assert [r["Temperature"] for r in scaled] == [1.0, 0.0]
    one = pf.profile_minmax(pf.cluster_profile(df.filter("cluster = 1")), ["Temperature"]).head()
    assert one["Temperature"] == 0.5
    assert {r["cluster"]: r["percent"] for r in pf.cluster_sizes(df).collect()}[1] == pytest.approx(100 / 3)
    summary = pf.size_summary(df).head()
    assert (summary["n_clusters"], summary["mean_size"], summary["max_size"]) == (2, 1.5, 2)
    assert {r["region"]: r["n_clusters"] for r in pf.region_counts(pf.cluster_profile(df)).collect()}["Western Washington"] == 1
