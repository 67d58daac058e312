"""Splits, samples, global positions, windows, scaling -- against brute force."""
import random

from pyspark.sql import functions as F

from custvalue.operators import series as SE
from custvalue.operators.order import global_positions


def frame(spark, n=500, seed=7):
    rnd = random.Random(seed)
    keys = rnd.sample(range(10_000), n)
    return spark.createDataFrame([(f"k{k:05d}", float(rnd.randint(1, 999))) for k in keys],
                                 "InvoiceNo string, TotalValue double")


def test_global_positions_match_sorted_order(spark):
    df = frame(spark).repartition(5)
    got = {r.InvoiceNo: r.pos for r in global_positions(df, [F.col("InvoiceNo")], partitions=4).collect()}
    want = {k: i for i, k in enumerate(sorted(got))}
    assert got == want


def test_global_positions_desc_with_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", 2.0)], "key string, v double")
    got = {r.key: r.pos for r in global_positions(df, [F.col("v").desc(), F.col("key")]).collect()}
    assert got == {"b": 0, "c": 1, "d": 2, "a": 3}


def test_hash_split_is_partitioning_invariant(spark):
    df = frame(spark)
    a = {r.InvoiceNo: r.split for r in SE.hash_split(df.repartition(3), "InvoiceNo").collect()}
    b = {r.InvoiceNo: r.split for r in SE.hash_split(df.repartition(11), "InvoiceNo").collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.7 < share < 0.9


def test_hash_sample_exact_size_and_repeatable(spark):
    df = frame(spark)
    a = [r.InvoiceNo for r in SE.hash_sample(df.repartition(3), "InvoiceNo", 100).collect()]
    b = [r.InvoiceNo for r in SE.hash_sample(df.repartition(9), "InvoiceNo", 100).collect()]
    assert len(a) == 100 and a == b
    assert SE.hash_sample(df, "InvoiceNo", 10_000).count() == 500


def test_sequential_split_and_windows_brute_force(spark):
    df = frame(spark, 103)
    s = SE.sequential_split(df, [F.col("InvoiceNo")])
    rows = sorted(s.collect(), key=lambda r: r.pos)
    n_train, n_val = int(103 * 0.6), int(103 * 0.2)
    assert [r.split for r in rows] == ["train"] * n_train + ["val"] * n_val + \
        ["test"] * (103 - n_train - n_val)
    vals = {sp: [r.TotalValue for r in rows if r.split == sp] for sp in ("train", "val", "test")}
    want = sorted((sp, t, v[t], v[t + 1], v[t + 2]) for sp, v in vals.items() for t in range(len(v) - 2))
    got = sorted(tuple(r) for r in SE.supervised_windows(s, "TotalValue", 2)
                 .select("split", "t", "x0", "x1", "y").collect())
    assert got == want


def test_minmax(spark):
    df = frame(spark, 50)
    lo, hi = SE.minmax_params(df, "TotalValue")
    sc = SE.minmax_scale(df, "TotalValue", lo, hi).agg(F.min("scaled"), F.max("scaled")).first()
    assert tuple(sc) == (0.0, 1.0)
    const = spark.createDataFrame([(1.0,), (1.0,)], "TotalValue double")
    assert {r.scaled for r in SE.minmax_scale(const, "TotalValue", 1.0, 1.0).collect()} == {0.0}
    back = SE.minmax_inverse(SE.minmax_scale(df, "TotalValue", lo, hi), "scaled", lo, hi)
    assert all(abs(r.value - r.TotalValue) < 1e-9 for r in back.collect())


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "p double, y double")
    m = SE.regression_metrics(df, "p", "y").first()
    assert (m.mae, m.mse) == (1.5, 2.5) and abs(m.rmse - 2.5 ** 0.5) < 1e-12


def test_regression_metrics_keep_small_errors(spark):
    df = spark.createDataFrame([(0.0004, 0.0), (0.0, 0.0003), (5e-9, 0.0)], "p double, y double")
    m = SE.regression_metrics(df, "p", "y").first()
    assert abs(m.mae - (0.0004 + 0.0003 + 5e-9) / 3) < 1e-15 and m.rmse > 0
    assert SE.regression_metrics(df.limit(0), "p", "y").first().n == 0


def test_regression_metrics_count_unknown_errors(spark):
    rows = [(1.0, 2.0), (float("nan"), 1.0), (float("inf"), 1.0), (None, 1.0), (3.0, 3.0)]
    m = SE.regression_metrics(spark.createDataFrame(rows, "p double, y double"), "p", "y").first()
    assert (m.n, m.n_unknown, m.mae) == (2, 3, 0.5)
    none = SE.regression_metrics(spark.createDataFrame(rows[1:2], "p double, y double"), "p", "y").first()
    assert (none.n, none.n_unknown, none.mae) == (0, 1, None)
