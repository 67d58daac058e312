"""End-to-end jobs (B1-B6): plain functions composing the operators.

Only small results (paths, metrics, model metadata) return to the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as FE
from ..operators import model as M
from ..operators import nested as N
from ..operators import scoring as S
from ..operators import series as SE
from ..sinks import writers as W
from ..sources import readers as RD
from ..streaming import streams as ST


def train_job(spark: SparkSession, lines: DataFrame, model_dir: str,
              ref_date="2011-06-11", split_date: str | None = None,
              kind: str = "linear", jdbc: dict | None = None) -> dict:
    """B1: clean -> (JDBC overwrite of clean lines) -> features + label ->
    hash split 80/20 -> fit -> versioned save.  Returns path and test metrics."""
    clean = C.clean_lines(lines)
    if jdbc:
        W.write_jdbc(C.drop_helpers(clean), mode="overwrite", **jdbc)
    ft = SE.hash_split(FE.features_with_target(clean, ref_date, split_date), "CustomerID")
    with M._persisted(ft) as ft:                 # one row per customer, read by fit and test
        train = ft.filter(F.col("split") == "train")
        if kind == "linear":                     # fitted on these rows alone: update_model adds later ones
            path = M.first_linear(spark, model_dir, train)
            model = M.load_linear(spark, path)
        else:
            model = M.fit_value_model(train, kind=kind)
            path = M.save_model_version(spark, model, model_dir)
        metrics = M.evaluate(model.transform(M.known_features(ft.filter(F.col("split") == "test"))))
    return {"model_path": path, **metrics}


def train_from_csv(spark: SparkSession, csv_path: str, model_dir: str, **kw) -> dict:
    """B1 with its CSV source."""
    return train_job(spark, RD.read_csv_lines(spark, csv_path), model_dir, **kw)


def score_lines(lines: DataFrame, ref_date="2011-06-11", model=None) -> DataFrame:
    """Shared scoring body: clean -> features -> score -> scored sink rows."""
    clean = C.clean_lines(lines)
    scores = S.score_features(FE.customer_features(clean, ref_date), model)
    return S.scored_projection(S.scored_lines(clean, scores))


def score_batch_job(spark: SparkSession, raw_json_path: str, out_path: str | None = None,
                    model_dir: str | None = None, ref_date="2011-06-11",
                    jdbc: dict | None = None, run_id: str | None = None) -> DataFrame:
    """B2: nested JSON raw zone -> explode -> clean -> features -> score ->
    parquet and/or JDBC append.  Returns the scored frame.

    The rows go to the folder ``run_id=<run_id>`` of ``out_path`` (by default one
    folder per input path), which a second run replaces; a JDBC append then reads
    them from there, so nothing is computed twice.  Lines that cleaning drops go,
    with their reason, to the same folder of ``quarantine_path(out_path)``."""
    model = M.load_latest_model(spark, model_dir) if model_dir else None
    invoices = RD.read_nested_json(spark, raw_json_path)
    lines = N.explode_items(invoices)
    out = score_lines(lines, ref_date, model)
    if out_path:
        run = run_id or hashlib.md5(raw_json_path.encode()).hexdigest()[:12]
        target = f"{out_path.rstrip('/')}/run_id={run}"
        W.write_table(out, target, mode="overwrite")
        W.write_table(C.unclean_lines(lines), f"{ST.quarantine_path(out_path)}/run_id={run}", mode="overwrite")
        out = spark.read.schema(out.schema).parquet(target)
    if jdbc:
        W.write_jdbc(out, mode="append", **jdbc)
    return out


def score_stream_job(spark: SparkSession, invoices_stream: DataFrame, out_path: str,
                     checkpoint: str, ref_date="2011-06-11", available_now: bool = False,
                     model_dir: str | None = None):
    """Streaming scoring (Kafka or file source of invoice JSON values), by the
    latest model of ``model_dir`` if given."""
    model = M.load_latest_model(spark, model_dir) if model_dir else None
    return ST.start_score_stream(ST.invoice_json(invoices_stream), out_path, checkpoint,
                                 ref_date, available_now, model=model)


def land_job(spark: SparkSession, invoices_stream: DataFrame, zone_path: str,
             checkpoint: str, available_now: bool = False):
    """Raw landing of invoice messages."""
    return ST.start_landing_stream(invoices_stream, zone_path, checkpoint, available_now)


def compact_landing_job(spark: SparkSession, zone_path: str, out_path: str,
                        months: list[str] | None = None) -> DataFrame:
    """B4 maintenance: the small files of a landing zone packed by month; safe to repeat."""
    return ST.compact_landing(spark, zone_path, out_path, months=months)


def build_events_job(raw_lines: DataFrame, out_path: str | None = None) -> DataFrame:
    """Raw retail rows -> checked, filled, typed -> nested invoice
    messages (key = InvoiceNo, value = JSON).  Written as text files when
    ``out_path`` is given (or hand the frame to ``write_kafka``)."""
    df = C.check_required_columns(raw_lines)
    # an anonymous line stays without a customer: filled, it would be one big customer
    df = C.normalise_lines(C.fill_defaults(df.dropna(subset=["CustomerID"])))
    msgs = N.to_json_value(N.nest_invoices(df), key_col="InvoiceNo")
    if out_path:
        msgs.select("value").write.mode("overwrite").text(out_path)
    return msgs


def series_job(spark: SparkSession, lines: DataFrame, sample: int = 10_000,
               time_step: int = 2, parity: bool = False) -> dict:
    """Exploration + series model.  Null profile and row counts, notebook
    cleaning, per-invoice totals, repeatable sample, 60/20/20 split, scaling,
    supervised windows, linear one-step model, metrics.

    Default: invoices are summed first and then sampled (whole totals), and
    the scaler is fitted on the train part only.  ``parity=True`` reproduces
    the source notebook instead: lines are sampled before summing and the
    scaler sees all data."""
    profile = FE.null_profile(lines).first().asDict()
    counts = FE.clean_counts(lines).first().asDict()
    clean = C.clean_lines(C.notebook_clean(lines))
    if parity:
        keyed = clean.withColumn("_k", F.concat_ws("|", *clean.columns))
        totals = FE.invoice_totals(SE.hash_sample(keyed, "_k", sample))
    else:
        totals = SE.hash_sample(FE.invoice_totals(clean), "InvoiceNo", sample)
    split = SE.sequential_split(totals, [F.col("InvoiceNo")])
    fit_on = split if parity else split.filter(F.col("split") == "train")
    lo, hi = SE.minmax_params(fit_on, "TotalValue")
    scaled = SE.minmax_scale(split, "TotalValue", lo, hi, "scaled")
    win = SE.supervised_windows(scaled, "scaled", time_step)
    model = M.fit_series_model(win.filter(F.col("split") == "train"),
                               [f"x{k}" for k in range(time_step)])
    pred = model.transform(win.filter(F.col("split") == "test"))
    pred = SE.minmax_inverse(SE.minmax_inverse(pred, "prediction", lo, hi, "p"), "y", lo, hi, "a")
    metrics = SE.regression_metrics(pred, "p", "a").first().asDict()
    return {"nulls": profile, "counts": counts, "metrics": metrics}
