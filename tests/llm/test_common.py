from pyspark.sql import functions as F

import corpus_pipeline
from custvalue.llm import common as K
from custvalue.llm import quality as Q


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_small_side_is_never_broadcast(spark, tmp_path):
    """A side beyond the row bound is repeated per salt: its file looks small to the planner, its rows are not."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        big = spark.range(500).select(F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("k"), F.col("id").alias("v"))
        spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).union(
            spark.sql("select cast(null as bigint), 99L")).write.parquet(f"{tmp_path}/small")
        small = spark.read.parquet(f"{tmp_path}/small")
        for how in ("inner", "left", "left_anti"):
            got = K.join_small(big, small, ["k"], how, max_rows=10)
            plan = _plan(got)
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
            want = K.join_small(big, small, ["k"], how)
            assert "BroadcastHashJoin" in _plan(want)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_pipeline_joins_many_labels_without_the_driver(spark, sf, documents, monkeypatch):
    """More labels than the row bound: the first stage's label join does not pass through the driver."""
    plans, joined = [], Q.join_small

    def spied(big, small, keys, how="inner"):
        plans.append(_plan(joined(big, small, keys, how, max_rows=10)))
        return joined(big, small, keys, how, max_rows=10)

    monkeypatch.setattr(Q, "join_small", spied)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        got = sorted(r.doc_id for r in corpus_pipeline.quality(spark, documents, sf).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
    monkeypatch.setattr(Q, "join_small", joined)
    assert got == sorted(r.doc_id for r in corpus_pipeline.quality(spark, documents, sf).collect())
