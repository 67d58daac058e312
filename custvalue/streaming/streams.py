"""Structured Streaming jobs.

Every stream uses the same ``DataFrame -> DataFrame`` operators as the batch
jobs.  Each query has its own checkpoint location in the shared checkpoint
folder; ``foreachBatch`` sinks are idempotent on ``batch_id`` (they overwrite
a directory named by it), so a restarted query that replays a batch writes
the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean as C
from ..operators import features as FE
from ..operators import nested as N
from ..operators import ranking as R
from ..operators import scoring as S
from ..functions.columns import (HOURS, WEEKDAYS, count_parts, event_time, normal_id, parse_invoice_ts,
                                 revenue_sum, wall_clock)
from ..schemas import FLAT_LINE, INVOICE, ITEM, RANK_MESSAGE
from ..session import remove_folder, shuffles_dropped
from ..sinks.batches import finished_batches, latest_rows, read_batches, write_batch


# ---- sources (S3, S4, S7) -------------------------------------------------

def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", group_id: str | None = None,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as an unbounded stream of (key, value) rows.
    Needs the spark-sql-kafka package on the classpath."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def file_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A directory of files replayed as a stream (schema given, never
    inferred)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def write_replay_files(df: DataFrame, path: str, files: int | None, fmt: str = "json",
                       key: str | None = None, order: str | None = None,
                       columns: list[str] | None = None, part: str | None = None,
                       level: str = "BEST_SPEED") -> None:
    """Lay a table down as stream input files.

    ``key`` puts all rows of a key in one file (so a per-batch computation
    sees whole keys); ``order`` range-partitions by time (files follow event
    time).  Otherwise rows spread evenly, or stay as they are dealt out with
    ``files`` None.  ``columns`` selects what is written (e.g. only ``value`` for text
    files); ``part`` puts the rows of each value of a column in a folder of its own.
    The files are compressed with zlib's ``level``.
    """
    if key:
        df = df.repartition(files, key)
    elif order:
        df = df.repartitionByRange(files, order)
    elif files:
        df = df.repartition(files)
    w = (df.select(*columns, *([part] if part else [])) if columns else df).write.mode("overwrite").format(fmt)
    w = w.options(compression="gzip", **{"zlib.compress.level": level}) if fmt in ("text", "json", "csv") else w
    (w.partitionBy(part) if part else w).save(path)


def invoice_json(df_value: DataFrame) -> DataFrame:
    """N1 on a stream: JSON ``value`` -> nested invoice columns."""
    return N.parse_json(df_value, INVOICE, "value").withColumn("CustomerID", normal_id("CustomerID"))


def flat_json(df_value: DataFrame, keep: tuple = ()) -> DataFrame:
    """N1 on a stream: JSON ``value`` -> flat line columns (behind the columns ``keep``)."""
    return N.parse_json(df_value, FLAT_LINE, "value", keep).withColumn("CustomerID", normal_id("CustomerID"))


# ---- T1 / T2: per-batch score ---------------------------------------------

def score_line_batch(lines: DataFrame, batch_id: int, state: str, ref_date,
                     model=None) -> tuple[DataFrame, DataFrame]:
    """Scored lines of a micro-batch and the scores of its customers (``batch_scores``)."""
    scores, own = batch_scores(lines, batch_id, state, ref_date, model)
    return S.scored_lines(lines, scores, hot=S.hot_keys_of_counts(own, n="_n")), scores


def batch_scores(lines: DataFrame, batch_id: int, state: str, ref_date, model=None) -> tuple[DataFrame, DataFrame]:
    """The scores of a micro-batch's customers, and the parts of their features in this batch.

    The folder ``state`` keeps, per batch, the mergeable feature parts of its
    customers.  A batch writes only its own parts (again on a replay); the scores
    add up what all batches so far have of its customers.  ``compact`` with
    ``merge_feature_parts`` folds many batches into one.
    """
    spark = lines.sparkSession
    own = lines.filter(F.col("CustomerID").isNotNull()).groupBy("CustomerID").agg(*FE._feature_parts(ref_date))
    write_batch(own, state, batch_id)
    own = spark.read.schema(own.schema).parquet(f"{state}/batch_id={batch_id}")
    merged = own
    before = read_batches(spark, state, before=batch_id)
    if before is not None:
        known = before.join(own.select("CustomerID"), "CustomerID", "left_semi")
        merged = FE.merge_feature_parts(own.unionByName(known.select(*own.columns)))
    return S.score_features(FE._finish(merged, ref_date, "CustomerID"), model), own


def score_state(out_path: str) -> str:
    """The folder of the feature parts that belong to an output folder."""
    return f"{out_path.rstrip('/')}_state"


def quarantine_path(out_path: str) -> str:
    """The folder of the lines that cleaning drops, with their reasons, of an output folder."""
    return f"{out_path.rstrip('/')}_quarantine"


def quarantined(spark: SparkSession, out_path: str) -> DataFrame | None:
    """Lines that a stream writing ``out_path`` could not score, with reason and ``batch_id``."""
    return read_batches(spark, quarantine_path(out_path))


def per_batch_writer(out_path: str, fn, fmt: str = "parquet"):
    """foreachBatch body writing ``fn(batch, batch_id)`` to
    ``out_path/batch_id=N`` (overwrite: idempotent on replay).  Empty
    batches write nothing (C20)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch = batch.persist()
        try:
            fn(batch, batch_id).write.mode("overwrite").format(fmt) \
                .save(f"{out_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return run


def start_score_stream(invoices: DataFrame, out_path: str, checkpoint: str,
                       ref_date, available_now: bool = True, feed_path: str | None = None,
                       model=None, state: str | None = None):
    """Stream of nested invoices -> scored lines per micro-batch.

    Scores use each customer's history up to and including the batch (kept in
    ``state``, by default next to ``out_path``), and a fitted ``model`` if given.
    Lines that cleaning drops are written with their reason (``quarantined``).
    With ``feed_path`` each batch also emits the K10 change feed: one
    ``{key, clv}`` JSON message per customer scored in the batch, written to
    ``feed_path/batch_id=N`` (hand it to ``write_kafka`` for a topic)."""
    state = state or score_state(out_path)

    def body(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch = batch.persist()
        try:
            lines = N.explode_items(batch)
            write_batch(C.unclean_lines(lines), quarantine_path(out_path), batch_id)
            scored, scores = score_line_batch(C.clean_lines(lines), batch_id, state, ref_date, model)
            scored.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
            if feed_path:
                R.prediction_feed(scores).write.mode("overwrite") \
                    .parquet(f"{feed_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    w = invoices.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def start_kv_upsert_stream(invoices: DataFrame, table: str, checkpoint: str,
                           ref_date, available_now: bool = True, model=None,
                           state: str | None = None):
    """K3 in a stream: per micro-batch, score the lines, build the row key
    ``{InvoiceNo}-{CustomerID}`` and text cells, keep the last put per key
    within the batch, and write them as the batch's folder of ``table``.  A later
    batch wins, as a later put would: ``kv_table`` reads the rows."""
    state = state or score_state(table)

    def body(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                lines = N.explode_items(batch, "item_pos")
                write_batch(C.unclean_lines(lines), quarantine_path(table), batch_id)
                scored, _ = score_line_batch(C.clean_lines(lines), batch_id, state, ref_date, model)
                write_batch(S.kv_upsert_latest(scored), table, batch_id)
        finally:
            batch.unpersist()

    w = invoices.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def kv_table(spark: SparkSession, table: str) -> DataFrame:
    """K3: the rows of a key-value table, the last put of every key."""
    return latest_rows(read_batches(spark, table), ["rowkey"])


def dedup_customer_stream(lines: DataFrame, delay: str = "1 day") -> DataFrame:
    """C14 (stream form): first line per customer within the watermark delay
    (``dropDuplicatesWithinWatermark``; state per customer expires with the
    watermark, so it stays bounded)."""
    ev = lines.withColumn("event_time", event_time("invoice_ts"))
    return ev.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["CustomerID"])


def start_batch_features_stream(invoices: DataFrame, out_path: str, checkpoint: str,
                                ref_date, available_now: bool = True):
    """Features of each micro-batch on its own (no memory across batches)."""
    def feats(b, _):
        return FE.customer_features(C.clean_lines(N.explode_items(b)), ref_date)
    w = invoices.writeStream.foreachBatch(per_batch_writer(out_path, feats)) \
        .option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


# ---- T3: cumulative features (stateful aggregation, update mode) ---------

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start_in_rocksdb(spark: SparkSession, writer, available_now: bool):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)                 # read when the query starts, and kept in its checkpoint
    try:
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def start_total_features_stream(lines: DataFrame, checkpoint: str, ref_date, out_path: str | None = None,
                                available_now: bool = True):
    """Running per-customer features over everything seen so far.

    Spark's state store (RocksDB: on the executors' disks, changes in the
    checkpoint) keeps the mergeable parts per customer; nothing else does.
    ``total_features`` reads them as a table.  With ``out_path`` each batch also
    writes the features of the customers that it touched.
    """
    spark = lines.sparkSession
    src = lines.filter(F.col("CustomerID").isNotNull())
    parts = src.groupBy("CustomerID").agg(*FE._feature_parts(ref_date))

    def body(batch: DataFrame, batch_id: int) -> None:
        write_batch(FE._finish(batch, ref_date, "CustomerID"), out_path, batch_id)

    w = parts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    w = w.foreachBatch(body) if out_path else w.format("noop")
    return _start_in_rocksdb(spark, w, available_now)


def total_features(spark: SparkSession, checkpoint: str, ref_date, batch_id: int | None = None) -> DataFrame:
    """T3 as a table: the features in the state of a stream's last batch, or of ``batch_id``."""
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    rows = r.load(checkpoint)
    empty = spark.createDataFrame([], "CustomerID string, InvoiceNo string, Quantity int, UnitPrice double, "
                                      "invoice_ts timestamp_ntz, hour int, dayofweek int, weekend int, Revenue double")
    parts = empty.groupBy("CustomerID").agg(*FE._feature_parts(ref_date)).drop("CustomerID")
    # sums, counts and extremes are one field of the state each, in the order of the parts
    named = F.col("value").cast(parts.schema)
    return FE._finish(rows.select(F.col("key.CustomerID").alias("CustomerID"), named.alias("value"))
                      .select("CustomerID", "value.*"), ref_date, "CustomerID")


# ---- A3: distinct invoices of a stream -------------------------------------

def start_invoice_count_stream(lines: DataFrame, checkpoint: str, available_now: bool = True):
    """A3 in a stream: Spark's state store keeps one row per (customer, invoice) with its lines, so an
    invoice whose lines come in several batches counts once; ``invoice_counts`` reads it."""
    pairs = (lines.filter(F.col("CustomerID").isNotNull() & F.col("InvoiceNo").isNotNull())
                  .groupBy("CustomerID", "InvoiceNo").agg(F.count(F.lit(1)).alias("n_lines")))
    w = pairs.writeStream.outputMode("update").option("checkpointLocation", checkpoint).format("noop")
    return _start_in_rocksdb(lines.sparkSession, w, available_now)


def invoice_counts(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``frequency_invoices`` and ``frequency_lines`` per customer after the last batch, or ``batch_id``."""
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    return (r.load(checkpoint).groupBy(F.col("key.CustomerID").alias("CustomerID"))
             .agg(F.count(F.lit(1)).alias("frequency_invoices"), F.sum("value.count").alias("frequency_lines")))


# ---- T4: windowed features with watermark ---------------------------------

def start_window_features_stream(lines: DataFrame, out_path: str, checkpoint: str,
                                 window: str = "30 days", delay: str = "1 day",
                                 available_now: bool = True):
    """T4: per-customer tumbling-window features.  Rows later than the
    watermark (max event time seen minus ``delay``) are dropped; a window is
    emitted once, when the watermark passes its end (append mode)."""
    ev = lines.withColumn("event_time", event_time("invoice_ts")) \
              .withWatermark("event_time", delay)
    w = F.window("event_time", window)
    agg = (ev.filter(F.col("CustomerID").isNotNull()).groupBy(w.alias("w"), "CustomerID")
             .agg(revenue_sum().alias("total_revenue"),
                  F.count("InvoiceNo").alias("frequency"),
                  F.count(F.when(F.col("Revenue") < 0, 1)).alias("num_returns"),
                  *count_parts("hour", HOURS, "_h"), *count_parts("dayofweek", WEEKDAYS, "_d"),
                  F.max("invoice_ts").alias("last_ts")))
    out = agg.select(wall_clock("w.start").alias("window_start"),
                     wall_clock("w.end").alias("window_end"),
                     "CustomerID", "total_revenue",
                     "frequency", "num_returns", *FE.median_columns(), "last_ts",
                     F.datediff(F.to_date(wall_clock("w.end")), F.to_date("last_ts"))
                     .alias("recency"))
    q = (out.writeStream.format("parquet").outputMode("append").option("path", out_path)
            .option("checkpointLocation", checkpoint))
    return (q.trigger(availableNow=True) if available_now else q).start()


def _clock(spark: SparkSession, out_path: str, before: int | None = None):
    """(latest event time, watermark) after the last batch below ``before``; None without any."""
    ids = [b for b in finished_batches(spark, f"{out_path}/clock") if before is None or b < before]
    return spark.read.parquet(f"{out_path}/clock/batch_id={ids[-1]}").first() if ids else None


def _ntz(t) -> Column:
    return F.lit(None if t is None else str(t)).cast("timestamp_ntz")


def start_window_table_stream(lines: DataFrame, out_path: str, checkpoint: str,
                              window: str = "30 days", delay: str = "1 day", available_now: bool = True):
    """T4 with its late rows kept and its open windows readable between triggers.

    The watermark of a batch is the latest event time of all batches before it minus ``delay``, as in
    ``start_window_features_stream``; a row whose window ended by then is late.  A batch writes
    its late rows, the mergeable parts of its other rows' windows, and its clock as folders named
    by its id, so a replayed batch writes the same.  ``window_table`` and ``late_rows`` read them.
    """
    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = _clock(spark, out_path, batch_id)
        seen, mark = _ntz(last and last["seen"]), _ntz(last and last["watermark"])
        w = F.window("invoice_ts", window)
        late = F.coalesce(F.col("window_end") <= mark, F.lit(False))
        batch = batch.persist()
        try:
            rows = (batch.filter(F.col("CustomerID").isNotNull())
                         .withColumns({"window_start": w["start"], "window_end": w["end"], "watermark": mark}))
            write_batch(rows.filter(late), f"{out_path}/late", batch_id)
            write_batch(FE.window_parts(rows.filter(~late)), f"{out_path}/parts", batch_id)
            clock = batch.agg(F.greatest(F.max("invoice_ts"), seen).alias("seen"))
            write_batch(clock.withColumn("watermark", F.expr(f"seen - INTERVAL {delay}")), f"{out_path}/clock", batch_id)
        finally:
            batch.unpersist()

    q = lines.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (q.trigger(availableNow=True) if available_now else q).start()


def window_table(spark: SparkSession, out_path: str) -> DataFrame:
    """The window features so far; ``closed`` once the watermark has passed a window's end."""
    last = _clock(spark, out_path)
    parts = read_batches(spark, f"{out_path}/parts").drop("batch_id")
    return FE.finish_window_parts(parts).withColumn(
        "closed", F.coalesce(F.col("window_end") <= _ntz(last["watermark"]), F.lit(False)))


def late_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """The rows that came after their window had closed, with that window, the watermark they missed and ``batch_id``."""
    return read_batches(spark, f"{out_path}/late")


# ---- T5: raw landing --------------------------------------------------------

def start_landing_stream(raw: DataFrame, out_path: str, checkpoint: str,
                         available_now: bool = True):
    """Raw invoice messages appended to the landing zone as parquet,
    partitioned by invoice month (partition pruning for later batch reads).

    Every message lands: its text in ``raw``, what parses of it in the invoice
    columns, and the S8 verdict in ``is_valid`` and ``reason``.  A message without
    a readable date lands in the null partition.

    Month, not day: each task writes one file per partition value it holds,
    so a replay spanning years would otherwise emit thousands of tiny files
    per micro-batch.  No shuffle is added before the write: a live batch
    covers one or two months, and a repartition by month would funnel it into
    one task.
    """
    from ..functions.columns import parse_invoice_ts
    landed = (N.ingest_invoices(raw).withColumn("reason", N.ingest_reason()).drop(N.CORRUPT_COL)
              .withColumn("landing_month", F.date_format(parse_invoice_ts("InvoiceDate"), "yyyy-MM")))
    q = (landed.writeStream.format("parquet").outputMode("append").option("path", out_path)
               .option("compression", "zstd").option("checkpointLocation", checkpoint).partitionBy("landing_month"))
    return (q.trigger(availableNow=True) if available_now else q).start()


def landed_invoices(spark: SparkSession, zone_path: str) -> tuple[DataFrame, DataFrame]:
    """(valid invoices, quarantine with raw text and reason) of a landing zone."""
    zone = spark.read.parquet(zone_path)
    return (zone.filter("is_valid").select(*INVOICE.fieldNames(), "landing_month"),
            zone.filter("not is_valid").select("InvoiceNo", "raw", "reason"))


TARGET_BYTES = 128 << 20    # size of a compacted landing file


def compact_landing(spark: SparkSession, zone_path: str, out_path: str, target_bytes: int = TARGET_BYTES,
                    months: list[str] | None = None) -> DataFrame:
    """K5: the many small files of a landing zone as few files of about ``target_bytes``, in one Spark job.

    Each month gets as many files as its landed bytes fill, and its rows are dealt to them evenly by
    their place in the landed files, whatever they hold.  Only months are replaced in ``out_path``
    that the run covers (``months``, default all), so a second run, or a run after more has landed,
    leaves every row once.  Returns one row per month: files and bytes before, files after.
    """
    zone = spark.read.parquet(zone_path)
    if months is not None:
        zone = zone.filter(F.col("landing_month").isin(months))
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    files = zone.select("landing_month", at[0], F.col("_metadata.file_size").alias("size")).distinct()
    sizes = (files.groupBy("landing_month").agg(F.count(F.lit(1)).alias("files_before"), F.sum("size").alias("bytes"))
                  .withColumn("files", F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int")))
    plan, first = [], 0
    for r in sorted(sizes.collect(), key=lambda r: (r["landing_month"] is not None, r["landing_month"])):    # one row per month
        plan.append((*r, first))
        first += r["files"]
    table = spark.createDataFrame(plan, f"{sizes.schema.simpleString()[7:-1].replace(':', ' ')}, first int")
    if not plan:
        return table.drop("first")
    slots = F.broadcast(table.select(F.col("landing_month").alias("_month"), "files", "first"))
    # item lists travel as JSON text: it repeats what the message holds, so the shuffle packs both into little more than one
    lists = [f.name for f in zone.schema if f.dataType == T.ArrayType(ITEM)]
    slot = F.col("first") + F.pmod(F.xxhash64("_file", "_row"), F.col("files")).cast("int")
    dealt = (zone.select("*", *at).join(slots, F.col("landing_month").eqNullSafe(F.col("_month")))
                 .withColumn("_slot", slot).select(*zone.columns, "_slot")
                 .withColumns({c: F.to_json(c) for c in lists}).repartitionById(first, "_slot"))
    (dealt.withColumns({c: F.from_json(c, T.ArrayType(ITEM)) for c in lists}).select(*zone.columns).write.mode("overwrite")
          .option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("landing_month").parquet(out_path))
    return table.drop("first")


# ---- T6: live leaderboard ---------------------------------------------------

BOARD_ROW = "key string, clv double, last_ts timestamp_ntz, last_event_id bigint, bucket int, pos bigint"


def _board_state(spark: SparkSession, state: str, before: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, counts) of the board: each bucket as the last batch (below ``before``) that touched it left it."""
    counts, rows = (read_batches(spark, f"{state}/{name}", before) for name in ("counts", "rows"))
    if counts is None or rows is None:
        return spark.createDataFrame([], BOARD_ROW), spark.createDataFrame([], "bucket int, n bigint")
    last = counts.groupBy("bucket").agg(F.max("batch_id").alias("batch_id"), F.max_by("n", "batch_id").alias("n"))
    now = rows.join(F.broadcast(last.select("bucket", "batch_id")), ["bucket", "batch_id"])       # a row per score bucket
    return now.select(*[f.split()[0] for f in BOARD_ROW.split(", ")]), last.select("bucket", "n")


def start_leaderboard_stream(feed: DataFrame, state: str, checkpoint: str, available_now: bool = True):
    """The latest score of every key, ranked.

    Keys are kept in score buckets with their place there.  A batch takes its keys out of their old
    buckets, puts them into the new ones, and sorts and writes just these buckets and their counts
    as the folders of its id; what it writes follows the batch.  Ranks come from prefix sums
    over the counts when the board is read (``leaderboard``); top-N for display is ``top_k`` on it.
    """
    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = R.latest_per_key(batch).withColumn("bucket", R.score_bucket()).persist()
        try:
            rows, _ = _board_state(spark, state, batch_id)
            cols = own.columns
            old = rows.join(own.select("key"), "key", "left_semi").select(*cols)
            order = lambda side: F.struct(F.col(f"{side}.last_ts"), F.col(f"{side}.last_event_id"))
            moved = (own.alias("o").join(old.alias("p"), "key", "left")
                        .where(F.col("p.bucket").isNull() | (order("o") > order("p")))          # a late event changes nothing
                        .select("key", *[F.col(f"o.{c}").alias(c) for c in cols[1:]], F.col("p.bucket").alias("was")))
            write_batch(moved, f"{state}/moved", batch_id)
            moved = spark.read.schema(moved.schema).parquet(f"{state}/moved/batch_id={batch_id}")
            touched = moved.select(F.explode(F.array("bucket", "was")).alias("bucket")).dropna().distinct()
            stay = (rows.select(*cols).join(F.broadcast(touched), "bucket", "left_semi")           # a row per score bucket
                        .join(moved.select("key"), "key", "left_anti"))
            write_batch(R.placed_in_buckets(stay.select(*cols).unionByName(moved.select(*cols))), f"{state}/rows", batch_id)
            placed = spark.read.schema(BOARD_ROW).parquet(f"{state}/rows/batch_id={batch_id}")
            counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
            write_batch(touched.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n")),
                        f"{state}/counts", batch_id)
        finally:
            own.unpersist()

    w = feed.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def leaderboard(spark: SparkSession, state: str, batch_id: int | None = None) -> DataFrame:
    """The board after the last batch, or ``batch_id``: rank, rank after the batch before, and the move
    (new / up / down / none)."""
    ids = finished_batches(spark, f"{state}/counts")
    if batch_id is None:
        batch_id = ids[-1] if ids else 0
    before, now = (R.ranks_of_buckets(*_board_state(spark, state, b)) for b in (batch_id, batch_id + 1))
    return R.rank_move(before.select("key", F.col("rank").alias("prev_rank")), now)


def rank_feed(raw: DataFrame) -> DataFrame:
    """Parse {key, clv} ranking messages (F5) with their event order."""
    return N.parse_json(raw, RANK_MESSAGE, "value", keep=("ts", "event_id"))


# ---- T7: flat message pipeline ----------------------------------------------

def start_flat_stream(raw: DataFrame, out_path: str, checkpoint: str, ref_date="2011-06-11",
                      available_now: bool = True, model=None, state: str | None = None):
    """Flat line messages (8 fields) -> parsed -> cleaned -> scored -> file sink.
    Lines that cleaning drops are written with their text and reason (``quarantined``)."""
    state = state or score_state(out_path)
    parsed = f"{out_path.rstrip('/')}_parsed"       # the batch at work, removed behind it

    def body(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # parsed once, into a file table: a cache of the batch would spill, several times as large.
        # The texts are kept of lines with a reason only; all others are clean, and typed by their schema
        spark = batch.sparkSession
        batch = (flat_json(batch, ("value",)).withColumn("reason", C.unclean_reason())
                 .withColumn("invoice_ts", F.when(F.col("reason").isNull(), parse_invoice_ts("InvoiceDate")))
                 .withColumns({c: F.when(F.col("reason").isNotNull(), F.col(c)) for c in ("value", "InvoiceDate")}))
        batch.write.mode("overwrite").option("compression", "zstd").parquet(parsed)
        rows = spark.read.schema(batch.schema).parquet(parsed)
        with shuffles_dropped(spark):
            write_batch(rows.filter(F.col("reason").isNotNull()).drop("invoice_ts"), quarantine_path(out_path), batch_id)
            good = rows.filter(F.col("reason").isNull()).select(*C.TYPED_COLUMNS)
            scores, own = batch_scores(C.line_parts(good), batch_id, state, ref_date, model)
            # lines meet their scores without the columns that follow from the others
            scored = C.line_parts(S.scored_lines(good, scores, hot=S.hot_keys_of_counts(own, n="_n")))
            (scored.select(*C.CLEAN_COLUMNS, "CLV_Prediction").write.mode("overwrite")
                   .option("compression", "zstd").parquet(f"{out_path}/batch_id={batch_id}"))
        remove_folder(spark, parsed)
    w = raw.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def finish(q) -> None:
    """Wait for an ``availableNow`` query and surface its failure."""
    q.awaitTermination()
    if q.exception():
        raise q.exception()
