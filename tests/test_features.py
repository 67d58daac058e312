"""Feature aggregation: one-pass = join chain, edge cases, label split."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from custvalue.operators import clean as C
from custvalue.operators import features as FE
from custvalue.schemas import FEATURE_COLUMNS, FLAT_LINE
from custvalue.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def sample(spark):
    rows = [
        ("1", "A", "a", 2, "2024-01-05 10:00:00", 5.0, "c1", "X"),   # Friday
        ("1", "B", "b", 1, "2024-01-05 10:00:00", 3.0, "c1", "X"),
        ("2", "A", "a", -1, "2024-01-10 20:00:00", 5.0, "c1", "X"),  # return
        ("3", "C", "c", 4, "2024-01-07 09:00:00", 2.5, "c2", "X"),   # Sunday
        ("4", "C", "c", 4, "2024-01-07 09:00:00", 2.5, None, "X"),   # no customer
    ]
    return C.clean_lines(spark.createDataFrame(rows, FLAT_LINE))


def test_features_values(spark):
    f = {r.CustomerID: r for r in FE.customer_features(sample(spark), "2024-01-31").collect()}
    assert set(f) == {"c1", "c2"}
    c1 = f["c1"]
    assert c1.total_revenue == 8.0 and c1.frequency == 3 and c1.recency == 5
    assert c1.t == 26 and c1.time_between == 26 / 3
    assert c1.avg_basket_value == 8.0 / 3 and c1.avg_basket_size == 2 / 3
    assert c1.num_returns == 1 and c1.purchase_hour_med == 10
    assert c1.purchase_weekend_prop == 2 / 3
    assert f["c2"].num_returns == 0 and f["c2"].purchase_weekend_prop == 0.0


def test_one_pass_equals_join_chain(spark):
    lines = C.clean_lines(FX.invoice_lines(spark, SF))
    a = FE.customer_features(lines, "2001-12-31")
    b = FE.features_by_joins(lines, "2001-12-31")
    cols = ["CustomerID"] + FEATURE_COLUMNS
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_one_pass_has_one_shuffle_for_the_aggregate(spark):
    df = FE.customer_features(sample(spark), "2024-01-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(CustomerID") == 1


def test_target_same_period_and_split(spark):
    s = sample(spark)
    same = {r.CustomerID: r.target_rev for r in FE.features_with_target(s, "2024-01-31").collect()}
    assert same == {"c1": 8.0, "c2": 10.0}
    split = {r.CustomerID: (r.total_revenue, r.target_rev)
             for r in FE.features_with_target(s, "2024-01-31", split_date="2024-01-08").collect()}
    assert split == {"c1": (13.0, -5.0), "c2": (10.0, 0.0)}


def test_null_profile_and_counts(spark):
    dirty = FX.dirty_lines(spark, SF)
    prof = FE.null_profile(dirty).first()
    assert prof.CustomerID > 0 and prof.Quantity > 0 and prof.InvoiceNo == 0
    c = FE.clean_counts(dirty).first()
    assert c.rows_in == dirty.count()
    assert c.rows_complete == c.rows_in - prof.Quantity
    assert c.rows_clean == C.clean_lines(dirty).count()
    assert c.rows_bad_date > 0


def test_describe(spark):
    d = {r.column: r for r in FE.describe_numeric(sample(spark), ["Quantity"]).collect()}
    q = d["Quantity"]
    assert q["count"] == 5 and q["min"] == -1.0 and q["max"] == 4.0
    assert abs(q["mean"] - 2.0) < 1e-12


def test_window_features_windows_are_30_days(spark):
    w = FE.window_features(sample(spark)).collect()
    assert all((r.window_end - r.window_start).days == 30 for r in w)
    assert sum(r.frequency for r in w) == 4


def test_medians_exact_on_a_hot_customer(spark):
    """A customer with 30k lines (beyond the sketch's exact range) and a few
    small ones: medians equal the lower median computed by brute force."""
    import random
    rnd = random.Random(3)
    rows = [("hot", rnd.randint(0, 23), rnd.randint(1, 7)) for _ in range(30_000)]
    rows += [(f"c{i}", rnd.randint(0, 23), rnd.randint(1, 7)) for i in range(50) for _ in range(i % 4 + 1)]
    df = spark.createDataFrame(rows, "CustomerID string, hour int, dayofweek int").repartition(6)
    got = {r.CustomerID: (r.purchase_hour_med, r.purchase_dow_med)
           for r in FE.customer_medians(df).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        hs = sorted(r[1] for r in rows if r[0] == k)
        ds = sorted(r[2] for r in rows if r[0] == k)
        want[k] = (hs[(len(hs) - 1) // 2], ds[(len(ds) - 1) // 2])
    assert got == want


def test_target_revenue_equals_total_revenue(spark):
    s = sample(spark)
    t = {r.CustomerID: r.target_rev for r in FE.target_revenue(s).collect()}
    f = {r.CustomerID: r.total_revenue for r in FE.customer_features(s, "2024-01-31").collect()}
    assert t == f


def test_describe_plain_values_of_any_size(spark):
    values = [1e-5, 3e-5, 1e15, -1e15, 0.0, 7.25, float("nan"), None]
    d = FE.describe_numeric(spark.createDataFrame([(v,) for v in values], "x double"), ["x"]).first()
    known = np.array(values[:6])
    assert d["count"] == 6 and d["min"] == -1e15 and d["max"] == 1e15
    assert abs(d["mean"] - known.mean()) < 1e-15 * 1e15 and np.isclose(d["stddev"], known.std(ddof=1), rtol=1e-9)
    assert np.allclose([d["q25"], d["q50"], d["q75"]], np.quantile(known, [0.25, 0.5, 0.75]), rtol=1e-12)
    small = FE.describe_numeric(spark.createDataFrame([(1e-5,), (3e-5,)], "x double"), ["x"]).first()
    assert np.isclose(small["mean"], 2e-5) and np.isclose(small["stddev"], np.std([1e-5, 3e-5], ddof=1))
    none = FE.describe_numeric(spark.createDataFrame([(None,)], "x double"), ["x"]).first()
    assert none["count"] == 0 and none["mean"] is None and none["q50"] is None


def test_exact_quantiles_of_skewed_values(spark):
    x = np.exp(np.random.default_rng(2).normal(size=5001) * 8) * np.where(np.arange(5001) % 3, 1, -1)
    x[:1700] = 42.0
    got = FE.exact_quantiles(spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5), ["x"],
                             [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]).collect()
    for r in got:
        assert np.isclose(r["value"], np.quantile(x, r["p"]), rtol=1e-12), r


def test_money_of_many_large_lines_does_not_overflow(spark):
    rows = [("c", "i", 100_000, 9.9e8, dt.datetime(2024, 1, 1))] * 40
    df = spark.createDataFrame(rows, "CustomerID string, InvoiceNo string, Quantity int, UnitPrice double, invoice_ts timestamp_ntz")
    df = df.withColumns({"hour": F.lit(1), "dayofweek": F.lit(2), "weekend": F.lit(0), "Revenue": F.col("Quantity") * F.col("UnitPrice")})
    assert FE.customer_features(df, "2024-01-31").first()["total_revenue"] == 40 * 100_000 * 9.9e8
    assert FE.invoice_totals(df).first()["TotalValue"] == 40 * 100_000 * 9.9e8


def test_describe_reads_its_rows_once(spark):
    from pyspark.sql import functions as F
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return float(x)
    d = FE.describe_numeric(spark.range(101).select(F.udf(look, "double")("id").alias("x")), ["x"]).first()
    assert (d["count"], d["q25"], d["q50"], d["q75"]) == (101, 25.0, 50.0, 75.0)
    assert seen.value == 101
