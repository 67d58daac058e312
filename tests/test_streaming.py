"""Streams: restart from checkpoint, late rows, empty batches, idempotent replay."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from custvalue.operators import clean as C
from custvalue.schemas import FLAT_LINE
from custvalue.sinks import batches as B
from custvalue.streaming import streams as ST

TEXT = T.StructType([T.StructField("value", T.StringType())])


def flat_json(spark, rows):
    df = spark.createDataFrame(rows, FLAT_LINE)
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def line(no, cust, ts, qty=1, price=1.0):
    return (no, "A", "a", qty, ts, price, cust, "X")


def test_total_features_survive_restart(spark, scratch):
    root = scratch("t3")
    flat_json(spark, [line("1", "c1", "2024-01-01 10:00:00"), line("2", "c2", "2024-01-02 10:00:00")]) \
        .coalesce(1).write.text(f"{root}/in/a")
    def run():
        raw = ST.file_source(spark, f"{root}/in/*", TEXT, "text")
        from custvalue.operators import nested as N
        lines = C.clean_lines(N.parse_json(raw, FLAT_LINE))
        ST.finish(ST.start_total_features_stream(lines, f"{root}/ckpt", "2024-01-31", f"{root}/out"))

    run()
    flat_json(spark, [line("3", "c1", "2024-01-05 10:00:00", qty=3)]).coalesce(1).write.text(f"{root}/in/b")
    run()   # restart: only the new file is read; state carries c1's earlier line
    def values(df):
        return {r.CustomerID: (r.frequency, r.total_revenue, r.recency) for r in df.collect()}

    assert values(ST.total_features(spark, f"{root}/ckpt", "2024-01-31")) == {"c1": (2, 4.0, 4), "c2": (1, 1.0, 0)}
    first, last = B.finished_batches(spark, f"{root}/out")[::len(B.finished_batches(spark, f"{root}/out")) - 1]
    assert values(ST.total_features(spark, f"{root}/ckpt", "2024-01-31", batch_id=first)) == {"c1": (1, 1.0, 0), "c2": (1, 1.0, 0)}
    assert values(spark.read.parquet(f"{root}/out/batch_id={last}")) == {"c1": (2, 4.0, 4)}    # only who was touched


def test_window_stream_drops_late_rows(spark, scratch):
    root = scratch("t4")
    schema = T.StructType(FLAT_LINE.fields)

    def write(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/{name}")

    write([line("1", "c1", "2024-03-10 00:00:00")], "a")
    src = lambda: C.clean_lines(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*"))
    ST.finish(ST.start_window_features_stream(src(), f"{root}/out", f"{root}/ckpt"))
    # watermark is now 2024-03-09: a row for January is late and must be dropped
    write([line("2", "c1", "2024-01-05 00:00:00"), line("3", "c1", "2024-06-01 00:00:00")], "b")
    ST.finish(ST.start_window_features_stream(src(), f"{root}/out", f"{root}/ckpt"))
    out = spark.read.parquet(f"{root}/out").collect()
    starts = sorted(r.window_start for r in out)
    assert all(r.window_start > dt.datetime(2024, 2, 1) for r in out)
    assert len(starts) == 1 and sum(r.frequency for r in out) == 1   # March window closed by June row


def test_per_batch_writer_skips_empty_and_is_idempotent(spark, scratch):
    root = scratch("fb")
    body = ST.per_batch_writer(root, lambda b, _: b.withColumn("x", F.lit(1)))
    empty = spark.createDataFrame([], "a int")
    body(empty, 0)
    one = spark.createDataFrame([(1,), (2,)], "a int")
    body(one, 1)
    body(one, 1)   # replay of the same batch id
    assert spark.read.parquet(root).count() == 2


def test_batch_folders_replay_latest_and_compaction(spark, scratch):
    path, other = scratch("bf") + "/t", scratch("bf2") + "/t"
    assert B.read_batches(spark, path) is None and B.compact(spark, path, other, lambda df: df) is None
    B.write_batch(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), path, 0)
    upd = spark.createDataFrame([("b", 2), ("c", None)], "k string, v int")
    B.write_batch(upd, path, 3)
    B.write_batch(upd, path, 3)                # replayed batch: same result
    assert B.finished_batches(spark, path) == [0, 3]
    rows = [("a", 1), ("b", 2), ("c", None)]
    assert sorted(map(tuple, B.latest_rows(B.read_batches(spark, path), ["k"]).collect()), key=str) == rows
    assert B.read_batches(spark, path, before=3).count() == 2
    assert B.compact(spark, path, other, lambda df: B.latest_rows(df, ["k"])) == 3
    assert sorted(map(tuple, B.latest_rows(B.read_batches(spark, other), ["k"]).collect()), key=str) == rows


def test_scores_use_the_whole_history_and_a_model(spark, scratch):
    root = scratch("t1")

    class Doubled:
        def transform(self, df):
            return df.withColumn("prediction", F.col("total_revenue") * 2)

    def run():
        raw = ST.file_source(spark, f"{root}/in/*", TEXT, "text")
        ST.finish(ST.start_flat_stream(raw, f"{root}/out", f"{root}/ckpt", "2024-01-31", model=Doubled()))

    flat_json(spark, [line("1", "17850.0", "2024-01-01 10:00:00", qty=2)]).coalesce(1).write.text(f"{root}/in/a")
    run()
    flat_json(spark, [line("2", "17850", "2024-01-05 10:00:00", qty=3)]).coalesce(1).write.text(f"{root}/in/b")
    run()
    got = {r.InvoiceNo: (r.CustomerID, r.CLV_Prediction) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {"1": ("17850", 4.0), "2": ("17850", 10.0)}


def test_landing_keeps_messages_that_do_not_parse(spark, scratch):
    root = scratch("t5")
    texts = ["garbage", '{"InvoiceNo": "1"}', '{"InvoiceNo": "1", "InvoiceDate": "2024-01-01 10:00:00", "CustomerID": "c", "Items": []}',
             '{"InvoiceDate": "2024-01-01 10:00:00", "CustomerID": "c", "Country": "x", "Items": []}']
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(f"{root}/in")
    ST.finish(ST.start_landing_stream(ST.file_source(spark, f"{root}/in", TEXT, "text"), f"{root}/zone", f"{root}/ckpt"))
    valid, bad = ST.landed_invoices(spark, f"{root}/zone")
    assert valid.count() == 0
    assert {r.raw: r.reason for r in bad.collect()} == dict(zip(texts, ["unparseable", "missing CustomerID", "missing Country", "missing InvoiceNo"]))


def test_late_rows_are_kept_and_open_windows_readable(spark, scratch):
    root = scratch("t4b")
    schema = T.StructType(FLAT_LINE.fields)

    def run(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/{name}")
        src = C.clean_lines(spark.readStream.schema(schema).parquet(f"{root}/in/*"))
        ST.finish(ST.start_window_table_stream(src, f"{root}/out", f"{root}/ckpt"))
        return {(r.CustomerID, str(r.window_start)[:10]): (r.frequency, r.closed) for r in ST.window_table(spark, f"{root}/out").collect()}

    got = run([line("1", "c1", "2024-03-10 00:00:00"), line("1", None, "2024-03-11 00:00:00")], "a")
    assert got == {("c1", "2024-02-17"): (1, False)} and ST.late_rows(spark, f"{root}/out").count() == 0
    # the watermark is 2024-03-10 now: January has closed, the row in the open window is in time
    got = run([line("2", "c1", "2024-01-05 00:00:00"), line("3", "c1", "2024-02-20 00:00:00"), line("4", "c1", "2024-06-01 00:00:00")], "b")
    assert got == {("c1", "2024-02-17"): (2, True), ("c1", "2024-05-17"): (1, False)}
    late = ST.late_rows(spark, f"{root}/out").collect()
    assert [(r.InvoiceNo, str(r.watermark), r.batch_id) for r in late] == [("2", "2024-03-10 00:00:00", 1)]


def test_invoice_counts_once_over_batches(spark, scratch):
    root = scratch("a3")

    def run(rows, name):
        flat_json(spark, rows).coalesce(1).write.text(f"{root}/in/{name}")
        raw = ST.file_source(spark, f"{root}/in/*", TEXT, "text")
        ST.finish(ST.start_invoice_count_stream(C.clean_lines(ST.flat_json(raw)), f"{root}/ckpt"))
        return sorted(map(tuple, ST.invoice_counts(spark, f"{root}/ckpt").collect()))

    at = "2024-01-01 10:00:00"
    assert run([line("1", "c1", at), line("1", "c1", at), line("2", "c2", at), line("9", None, at)], "a") == [("c1", 1, 2), ("c2", 1, 1)]
    assert run([line("1", "c1", at), line("3", "c1", at)], "b") == [("c1", 2, 4), ("c2", 1, 1)]
    assert sorted(map(tuple, ST.invoice_counts(spark, f"{root}/ckpt", batch_id=0).collect())) == [("c1", 1, 2), ("c2", 1, 1)]


def test_landing_compaction_bounds_files_and_keeps_rows(spark, scratch):
    root = scratch("k5")
    zone, packed = f"{root}/zone", f"{root}/packed"
    rows = (spark.range(6000).repartition(12)
            .select(F.lit("the same message").alias("raw"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("2024-0"), (F.col("id") % 3).cast("string"))).alias("landing_month"),
                    F.md5(F.col("id").cast("string")).alias("x")))
    rows.write.partitionBy("landing_month").parquet(zone)

    def content(path):
        return sorted(map(str, spark.read.parquet(path).select("raw", "landing_month", "x").collect()))

    def files(path):
        return sorted(r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect())

    plan = ST.compact_landing(spark, zone, packed, target_bytes=20_000)
    assert len(files(zone)) == 36 and plan.agg(F.sum("files_before")).first()[0] == 36
    assert len(files(packed)) == plan.agg(F.sum("files")).first()[0] < 36
    assert content(packed) == content(zone)
    sizes = [r["count"] for r in spark.read.parquet(packed).groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) < 1.5 * min(sizes)                                            # equal messages are dealt out too
    rows.where("landing_month = '2024-01'").limit(50).write.mode("append").partitionBy("landing_month").parquet(zone)
    ST.compact_landing(spark, zone, packed, target_bytes=20_000, months=["2024-01"])   # only this month is replaced
    assert content(packed) == content(zone)
    assert ST.compact_landing(spark, zone, packed, months=["1999-01"]).count() == 0 and content(packed) == content(zone)


def test_leaderboard_sorts_only_touched_buckets(spark, scratch):
    import random
    root, rng = scratch("t6"), random.Random(3)
    odd = [0.0, -0.0, -5.5, 1e300, -1e300, float("inf"), float("-inf"), float("nan"), None]
    seen, order, boards = {}, {}, [{}]

    def run(n, events):
        df = spark.createDataFrame(events, "key string, clv double, ts timestamp_ntz, event_id long")
        df.coalesce(1).write.parquet(f"{root}/in/{n}")
        src = spark.readStream.schema(df.schema).parquet(f"{root}/in/*")
        ST.finish(ST.start_leaderboard_stream(src, f"{root}/state", f"{root}/ckpt"))
        for k, v, ts, e in events:
            if k not in order or (ts, e) > order[k]:
                seen[k], order[k] = v, (ts, e)
        rank = lambda v: (2, 0) if v is None else (0, 0) if v != v else (1, -v)
        boards.append({k: i + 1 for i, k in enumerate(sorted(seen, key=lambda k: (rank(seen[k]), k)))})
        got = {r.key: (r["rank"], r.prev_rank) for r in ST.leaderboard(spark, f"{root}/state").collect()}
        assert got == {k: (i, boards[-2].get(k)) for k, i in boards[-1].items()}

    t = dt.datetime(2024, 1, 1)
    run(0, [(f"k{i}", rng.choice([7.0, 7.0, rng.uniform(-50, 500)]), t, i) for i in range(300)] + [(f"o{i}", v, t, i) for i, v in enumerate(odd)])
    # one key moves, one event is late, one key is new
    run(1, [("k5", 400.25, t.replace(day=2), 0), ("k6", 9999.0, t.replace(year=2023), 0), ("new", 7.0, t, 0)])
    run(2, [("o7", 1.0, t.replace(day=3), 0)])
    run(3, [("k6", 1.0, t.replace(year=2022), 0)])                       # nothing moves
    wrote = {b: spark.read.parquet(f"{root}/state/counts/batch_id={b}").count() for b in (0, 1, 2, 3)}
    assert wrote[1] <= 3 and wrote[2] <= 2 and wrote[3] == 0 < 50 < wrote[0]
    again = {r.key: r["rank"] for r in ST.leaderboard(spark, f"{root}/state", 1).collect()}
    assert again == boards[2]


def test_replay_parts_are_written_in_one_pass_and_compressed(spark, scratch):
    root = scratch("parts")
    df = spark.range(9).select(F.col("id").cast("string").alias("value"), (F.col("id") % 3).cast("int").alias("part"))
    ST.write_replay_files(df, f"{root}/in", None, "text", columns=["value"], part="part")
    files = [r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/in").select("path").collect()]
    assert files and all(f.endswith(".gz") for f in files)
    got = []
    for i in range(3):                                     # a restarted stream finds the next part only
        raw = ST.file_source(spark, f"{root}/in/part=[0-{i}]", TEXT, "text")
        body = lambda b, n: got.append(sorted(int(r.value) for r in b.select("value").collect()))
        ST.finish(raw.writeStream.foreachBatch(body).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    assert got == [[0, 3, 6], [1, 4, 7], [2, 5, 8]]


def test_nested_lines_are_not_dealt_out_by_invoice_again(spark):
    from custvalue.sources import fixtures as FX
    plan = FX.invoices(spark, "/root/testdata/sf0.001", files=11)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(InvoiceNo" not in plan and "l_orderkey" in plan
    assert FX.invoices(spark, "/root/testdata/sf0.001", files=11).rdd.getNumPartitions() == 11


def test_compaction_keeps_item_lists(spark, scratch):
    root = scratch("items")
    text = ['{"InvoiceNo":"1","InvoiceDate":"2024-01-01 10:00:00","CustomerID":"c","Country":"x","Items":%s}' % i for i in (
        "[]", "null", "[null]", "[{}]", '[{"StockCode":"a\\"\\u00e9\\n","Description":"","Quantity":-1,"UnitPrice":0.1},{"UnitPrice":1e300}]')]
    spark.createDataFrame([(t,) for t in text * 3], "value string").repartition(4).write.text(f"{root}/in")
    ST.finish(ST.start_landing_stream(ST.file_source(spark, f"{root}/in", TEXT, "text"), f"{root}/zone", f"{root}/ckpt"))
    ST.compact_landing(spark, f"{root}/zone", f"{root}/packed")
    rows = lambda p: sorted(map(str, spark.read.parquet(f"{root}/{p}").collect()))
    assert len(rows("zone")) == 15 and rows("packed") == rows("zone")
