"""File, console and landing sinks; stream dedupe; notebook parity mode."""
from pyspark.sql import functions as F

from custvalue.operators import clean as C
from custvalue.plans import jobs
from custvalue.schemas import FLAT_LINE
from custvalue.sinks import writers as W
from custvalue.sources import fixtures as FX
from custvalue.streaming import streams as ST

SF = "/root/testdata/sf0.001"


def _lines(spark):
    rows = [("1", "A", "a", 1, "2024-01-01 10:00:00", 2.0, "c1", "X"),
            ("2", "B", "b", 2, "2024-01-02 11:00:00", 3.0, "c1", "X"),
            ("3", "C", "c", 3, "2024-02-01 12:00:00", 4.0, "c2", "Y")]
    return spark.createDataFrame(rows, FLAT_LINE)


def test_write_table_partitioned_and_pruned(spark, scratch):
    path = scratch("table")
    W.write_table(W.with_ingest_date(C.clean_lines(_lines(spark))), path,
                  partition_by=["ingest_date"])
    df = spark.read.parquet(path).filter(F.col("ingest_date") == "2024-02-01")
    assert [r.InvoiceNo for r in df.collect()] == ["3"]
    assert "PartitionFilters: [isnotnull(ingest_date" in df._jdf.queryExecution().executedPlan().toString()


def test_stream_csv_json_and_console_writers(spark, scratch):
    root = scratch("landing")
    _lines(spark).write.json(f"{root}/in")
    src = spark.readStream.schema(FLAT_LINE).json(f"{root}/in")
    ST.finish(W.csv_landing_writer(src, f"{root}/csv", f"{root}/ck1",
                                   ["InvoiceNo", "CustomerID"]).trigger(availableNow=True).start())
    ST.finish(W.json_landing_writer(src, f"{root}/json", f"{root}/ck2", ["Country"])
              .trigger(availableNow=True).start())
    ST.finish(W.console_writer(src).option("checkpointLocation", f"{root}/ck3")
              .trigger(availableNow=True).start())
    csv = spark.read.option("header", True).csv(f"{root}/csv")
    assert csv.columns == ["InvoiceNo", "CustomerID"] and csv.count() == 3
    assert spark.read.json(f"{root}/json").filter("Country = 'Y'").count() == 1


def test_stream_dedup_within_watermark(spark, scratch):
    root = scratch("dedup")
    _lines(spark).write.json(f"{root}/in")
    src = C.clean_lines(spark.readStream.schema(FLAT_LINE).json(f"{root}/in"))
    out = ST.dedup_customer_stream(src)
    q = (out.drop("event_time").writeStream.format("parquet").option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
    ST.finish(q)
    assert sorted(r.CustomerID for r in spark.read.parquet(f"{root}/out").collect()) == ["c1", "c2"]


def test_series_job_parity_mode(spark):
    s = jobs.series_job(spark, FX.dirty_lines(spark, SF), sample=2000, parity=True)
    assert s["metrics"]["n"] > 0 and s["counts"]["rows_notebook"] > 0


def test_kafka_shaped_frame(spark):
    inv = FX.invoices(spark, SF)
    from custvalue.operators.nested import parse_json, to_json_value
    from custvalue.schemas import INVOICE
    kv = to_json_value(inv, key_col="InvoiceNo")
    assert kv.columns == ["key", "value"]
    back = parse_json(kv, INVOICE, "value", keep=("key",))
    assert back.filter(F.col("key") != F.col("InvoiceNo")).count() == 0
    assert back.count() == inv.count()


def test_write_jdbc_options(monkeypatch, spark):
    """No database is started here: the writer call is captured instead."""
    from pyspark.sql.readwriter import DataFrameWriter
    seen = {}

    def fake_jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties)
    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    df = spark.range(3)
    W.write_jdbc(df, "jdbc:postgresql://db/x", '"Order"', mode="overwrite",
                 properties={"user": "u"}, num_partitions=4)
    assert seen["mode"] == "overwrite" and seen["table"] == '"Order"'
    assert seen["properties"] == {"user": "u", "batchsize": "10000", "truncate": "true",
                                  "numPartitions": "4"}
    W.write_jdbc(df, "jdbc:postgresql://db/x", "sales_data_order", properties={})
    assert seen["mode"] == "append" and "truncate" not in seen["properties"]


def test_kafka_source_needs_its_connector(spark):
    """Options are wired; without the Kafka package the lookup fails cleanly
    (no broker is contacted)."""
    import pytest
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        ST.kafka_source(spark, "broker:9092", "invoices", group_id="g", max_offsets_per_trigger=10)


def test_stream_jobs_and_csv_training(spark, scratch):
    from pyspark.sql import types as T
    root = scratch("jobs")
    inv = FX.invoices(spark, SF)
    inv.select(F.to_json(F.struct(*inv.columns)).alias("value")).write.text(f"{root}/in")
    schema = T.StructType([T.StructField("value", T.StringType())])
    raw = lambda: ST.file_source(spark, f"{root}/in", schema, "text")
    ST.finish(jobs.score_stream_job(spark, raw(), f"{root}/scored", f"{root}/ck1", "2001-12-31",
                                    available_now=True))
    ST.finish(jobs.land_job(spark, raw(), f"{root}/zone", f"{root}/ck2", available_now=True))
    n_lines = FX.invoice_lines(spark, SF).count()
    assert spark.read.parquet(f"{root}/scored").count() == n_lines
    from custvalue.operators.nested import explode_items
    assert explode_items(ST.landed_invoices(spark, f"{root}/zone")[0]).count() == n_lines
    FX.invoice_lines(spark, SF).write.option("header", True).csv(f"{root}/csv")
    out = jobs.train_from_csv(spark, f"{root}/csv", f"{root}/models", ref_date="2001-12-31",
                              split_date="2000-01-01")
    assert out["model_path"].endswith("CLV_V1")
    from custvalue.sources.readers import read_table
    assert read_table(spark, f"{root}/csv", "csv").count() == n_lines
