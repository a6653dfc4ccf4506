import numpy as np
from pyspark.sql import functions as F

from churnspark.operators.order import with_cumsum, with_position


def test_positions_with_a_hot_key(spark):
    rng = np.random.default_rng(0)
    rows = [("hot", int(v), i) for i, v in enumerate(rng.integers(0, 50, 4000))]
    rows += [(f"k{i % 30}", int(v), 10_000 + i) for i, v in enumerate(rng.integers(0, 50, 2000))]
    df = spark.createDataFrame(rows, "k string, v long, t long")
    got = with_position(df, ["k"], ["v", "t"], pos_col="pos", size_col="n", n_parts=16).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r["k"], []).append(r)
    for k, rs in by_key.items():
        rs.sort(key=lambda r: (r["v"], r["t"]))
        assert [r["pos"] for r in rs] == list(range(len(rs)))
        assert all(r["n"] == len(rs) for r in rs)


def test_weighted_running_sum(spark):
    rows = [("a", i, w) for i, w in enumerate([3, 1, 4, 1, 5, 9, 2, 6])] + [("b", 0, 7)]
    df = spark.createDataFrame(rows, "k string, o long, w long")
    got = {(r["k"], r["o"]): r["cum_before"] for r in with_cumsum(df, ["k"], ["o"], "w", n_parts=4).collect()}
    assert [got[("a", i)] for i in range(8)] == [0, 3, 4, 8, 9, 14, 23, 25] and got[("b", 0)] == 0
