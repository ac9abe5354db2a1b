"""Merging the arrays of tasks on the executors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isotherm.operators.partials import merge_arrays


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_sums_are_in_order_whatever_the_partitions(spark, fan):
    rng = np.random.default_rng(fan)
    rows = [(k, p, (rng.standard_normal(4) * 10.0 ** rng.integers(-8, 8, 4)).tolist(), [p, k or 0]) for k in (0, 1, None) for p in range(0, 41, 1 + (k or 0))]
    want = {}
    for key in (0, 1, None):
        level = {p: np.array(x) for k, p, x, _ in rows if k == key}
        parts = 41
        while True:
            merged = {}
            for p in sorted(level):
                merged[p // fan] = merged[p // fan] + level[p] if p // fan in merged else level[p]
            level, parts = merged, -(-parts // fan)
            if parts <= 1:
                break
        want[key] = level[0].tolist()
    for partitions in (1, 4, 40):
        df = spark.createDataFrame(rows, "k int, part long, x array<double>, y array<long>").repartition(partitions, F.rand(partitions))
        got = {r["k"]: r for r in merge_arrays(df, ["k"], ["x", "y"], parts=41, fan=fan).collect()}
        assert {k: r["x"] for k, r in got.items()} == want  # every last bit
        assert {k: r["y"] for k, r in got.items()} == {k: [sum(p for q, p, *_ in rows if q == k), sum(q or 0 for q, *_ in rows if q == k)] for k in want}


def test_no_rows_and_no_keys(spark):
    empty = spark.createDataFrame([], "part long, x array<long>")
    assert merge_arrays(empty, [], ["x"], parts=0).collect() == []
    some = spark.createDataFrame([(i, [1, i]) for i in range(100)], "part long, x array<long>")
    assert merge_arrays(some, [], ["x"], parts=100, fan=5).head()["x"] == [100, 4950]
    few = merge_arrays(some, [], ["x"], parts=100, fan=5, keep=20).collect()
    assert len(few) == 20 and sum(r["x"][1] for r in few) == 4950
    assert merge_arrays(some, [], ["x"], parts=100, keep=100).count() == 100
    with pytest.raises(ValueError, match="fan"):
        merge_arrays(some, [], ["x"], parts=100, fan=1)
