"""Rankings, rank change, latest-per-key, serving view, feeds."""
import json

from pyspark.sql import functions as F

from custvalue.operators import ranking as R
from custvalue.operators import scoring as S


def test_rank_change_states(spark):
    prev = spark.createDataFrame([("a", 10.0), ("b", 5.0), ("c", 1.0)], "key string, clv double")
    cur = spark.createDataFrame([("a", 4.0), ("b", 6.0), ("c", 1.5), ("d", 100.0)],
                                "key string, clv double")
    got = {r.key: (r["rank"], r.prev_rank, r.change) for r in R.rank_change(prev, cur).collect()}
    assert got == {"d": (1, None, "new"), "b": (2, 2, "none"), "a": (3, 1, "down"),
                   "c": (4, 3, "down")}
    up = {r.key: r.change for r in R.rank_change(cur, prev).collect()}
    assert up["a"] == "up"


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 3.0)], "key string, clv double")
    assert [r.key for r in R.top_k(df, 2).collect()] == ["c", "a"]


def test_latest_per_key_uses_event_order(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    feed = spark.createDataFrame([("a", 1.0, t, 1), ("a", 2.0, t, 2), ("a", 0.5, t.replace(hour=1), 0)],
                                 "key string, clv double, ts timestamp_ntz, event_id long")
    assert R.latest_per_key(feed).first().clv == 0.5


def test_serving_view_na(spark):
    ent = spark.createDataFrame([("a",), ("b",)], "key string")
    sc = spark.createDataFrame([("a", 12.345)], "key string, clv double")
    assert {r.key: r.clv_text for r in R.serving_view(ent, sc).collect()} == {"a": "12.35", "b": "N/A"}


def test_prediction_feed_message(spark):
    sc = spark.createDataFrame([("7", 1234.567)], "CustomerID string, CLV_Prediction double")
    r = R.prediction_feed(sc).first()
    assert json.loads(r.value) == {"key": "7", "clv": 1234.567} and r.clv == 1234.567


def test_kv_rows_and_upsert(spark):
    rows = spark.createDataFrame(
        [("C100", "7", 2, 1.5, 3.0, 9.99, 1700000000.0, 22, 3, 0)],
        "InvoiceNo string, CustomerID string, Quantity int, UnitPrice double, Revenue double, "
        "CLV_Prediction double, invoice_epoch double, hour int, dayofweek int, weekend int")
    kv = S.kv_rows(rows).first()
    assert kv.rowkey == "C100-7" and kv.cf_hour == "22" and kv.cf_UnitPrice == "1.5"
    assert kv.cf_InvoiceDate == "2023-11-14T22:13:20"
    puts = (rows.withColumn("item_pos", F.lit(0)).withColumn("Quantity", F.lit(50))
            .unionByName(rows.withColumn("item_pos", F.lit(1)).withColumn("Quantity", F.lit(9)))
            .unionByName(rows.withColumn("item_pos", F.lit(7)).withColumn("Quantity", F.lit(99))
                         .withColumn("invoice_epoch", rows.invoice_epoch - 1)))
    last = S.kv_upsert_latest(puts).collect()
    assert len(last) == 1 and last[0].cf_Quantity == "9"          # last place of the last time, not the largest text


def test_kv_keys_with_missing_parts(spark):
    rows = spark.createDataFrame(
        [(None, "7", 1, 0.001), ("7", None, 2, 0.001)], "InvoiceNo string, CustomerID string, Quantity int, UnitPrice double")
    kv = S.kv_rows(rows, ["Quantity", "UnitPrice"]).collect()
    assert {r.rowkey for r in kv} == {"-7", "7-"} and {r.cf_UnitPrice for r in kv} == {"0.001"}


def test_salted_join_equals_plain_join(spark):
    from pyspark.sql import functions as F
    lines = spark.range(2000).select((F.col("id") % 3).cast("string").alias("CustomerID"),
                                     F.col("id").alias("x"))
    scores = spark.createDataFrame([("0", 1.0), ("1", 2.0)], "CustomerID string, CLV_Prediction double")
    a = sorted(map(tuple, S.scored_lines(lines, scores, salts=1).collect()))
    b = sorted(map(tuple, S.scored_lines(lines, scores, salts=8).collect()))
    assert a == b and len(b) == 2000
    assert sum(1 for r in b if r[2] is None) == 666


def test_only_hot_customers_are_salted(spark):
    n, hot = 60_000, 20_000
    who = F.when(F.col("id") < hot, "hot").when(F.col("id") % 50 == 0, None).otherwise((F.col("id") % 997).cast("string"))
    lines = spark.range(n).select(who.alias("CustomerID"), F.col("id").alias("x"))
    scores = lines.where("CustomerID is not null").groupBy("CustomerID").agg(F.max("x").cast("double").alias("CLV_Prediction"))
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = S.hot_keys(lines)
        exact = S.hot_keys_of_counts(lines.groupBy("CustomerID").agg(F.count("*").alias("n")))
        joined = S.scored_lines(lines, scores)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        rows = sorted(map(tuple, joined.collect()), key=str)
        plain = sorted(map(tuple, S.scored_lines(lines, scores, salts=1).collect()), key=str)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert set(found) == set(exact) == {"hot"} and found["hot"] >= exact["hot"] == -(-hot * 128 // n)
    assert len(sizes) == 32 and sizes[-1] < 2 * sizes[16]
    assert rows == plain


def test_hot_keys_of_nothing(spark):
    none = spark.createDataFrame([], "CustomerID string, n bigint")
    assert S.hot_keys(none) == {} == S.hot_keys_of_counts(none)
    assert S.scored_lines(none, none.selectExpr("CustomerID", "1d CLV_Prediction")).count() == 0
