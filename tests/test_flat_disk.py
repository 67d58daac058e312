"""What a flat-line stream leaves on the executors' disks."""
import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from custvalue.session import SHUFFLE_CLEANUP, shuffles_dropped
from custvalue.streaming import streams as ST


def shuffles(spark):
    """Shuffles whose files are still there."""
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    assert spark.conf.get(SHUFFLE_CLEANUP, None) in (None, "false")
    before = shuffles(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    df.write.parquet(f"{tmp_path}/kept")
    assert shuffles(spark) > before
    before = shuffles(spark)
    with shuffles_dropped(spark):
        df.write.parquet(f"{tmp_path}/dropped")
    assert shuffles(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) in (None, "false")
    assert sorted(spark.read.parquet(f"{tmp_path}/dropped").collect()) == sorted(df.collect())


def test_stream_flat_leaves_no_shuffles_and_no_parsed_batch(spark):
    before = shuffles(spark)
    df = E.queries()["stream_flat"](spark, "/root/testdata/sf0.001")
    assert shuffles(spark) <= before
    root = os.path.dirname(os.path.dirname(os.path.dirname(df.inputFiles()[0].removeprefix("file://"))))
    assert {"in", "out", "out_quarantine", "out_state"} <= set(os.listdir(root)) and "out_parsed" not in os.listdir(root)


def test_restart_replaces_what_a_failed_batch_left(spark, tmp_path):
    """A batch that failed after it was parsed leaves its table behind; the next run replaces it."""
    def line(no, qty, date="2024-01-01 10:00:00"):
        return (no, "s", "d", qty, date, 2.5, "c1", "UK")
    cols = "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate string, UnitPrice double, CustomerID string, Country string"

    def put(part, rows):
        spark.createDataFrame(rows, cols).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(f"{tmp_path}/in/{part}")

    def run(model=None):
        raw = ST.file_source(spark, f"{tmp_path}/in/*", spark.range(0).select(F.lit("").alias("value")).schema, "text")
        ST.finish(ST.start_flat_stream(raw, f"{tmp_path}/out", f"{tmp_path}/ckpt", "2024-01-31", model=model))

    put("a", [line("1", 2), line("2", None), line("3", 4, "n/a")])

    class Broken:
        def transform(self, df):
            raise ValueError("broken")
    try:
        run(Broken())
    except Exception as e:
        assert "broken" in str(e)
    else:
        raise AssertionError("the first run should fail")
    assert os.path.exists(f"{tmp_path}/out_parsed")
    run()
    put("b", [line("4", 1), line("1", 2)])
    run()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.batch_id, r.InvoiceNo, r.Revenue) for r in got.collect()) == [(0, "1", 5.0), (1, "1", 5.0), (1, "4", 2.5)]
    bad = ST.quarantined(spark, f"{tmp_path}/out")
    assert sorted((r.InvoiceNo, r.reason, r.value is not None) for r in bad.collect()) == [
        ("2", "incomplete", True), ("3", "invalid date", True)]
    assert not os.path.exists(f"{tmp_path}/out_parsed")
