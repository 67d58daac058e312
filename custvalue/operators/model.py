"""Value models with ``pyspark.ml``.

Training, validation and scoring run on the executors; only model
coefficients and metrics come back to the driver.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_bucket
from ..schemas import FEATURE_COLUMNS
from .moments import (LinearModel, fit_linear, load_linear, load_sums, merge_sums, moment_sums,
                      save_linear, solve)

# Fixed value of the registry (it must equal the source system's):
MODEL_PREFIX = "CLV_V"          # folder names CLV_V1, CLV_V2, ...
_VERSION = re.compile(r"^CLV_V(\d+)$")


def value_pipeline(feature_cols=FEATURE_COLUMNS, label_col: str = "target_rev",
                   kind: str = "linear"):
    """U8 + U3: assemble features, standardise, regress."""
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features_raw",
                                handleInvalid="error")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features",
                            withMean=True, withStd=True)
    if kind == "gbt":
        reg = GBTRegressor(featuresCol="features", labelCol=label_col, seed=42)
    else:
        reg = LinearRegression(featuresCol="features", labelCol=label_col)
    return Pipeline(stages=[assembler, scaler, reg]), reg


def fit_value_model(train: DataFrame, feature_cols=FEATURE_COLUMNS,
                    label_col: str = "target_rev", kind: str = "linear",
                    train_ratio: float = 0.8, key: str = "CustomerID") -> PipelineModel:
    """Fit with an 80/20 train/validation split, MSE as the selection
    metric, over a small parameter grid; returns the best pipeline, fitted on
    all of ``train``.

    The split is a hash of ``key``, so it does not depend on partitioning.
    Missing features count as 0, as in the feature vector itself.
    """
    pipe, reg = value_pipeline(feature_cols, label_col, kind)
    if kind == "gbt":
        grid = ParamGridBuilder().addGrid(reg.maxDepth, [3, 5]).build()
    else:
        grid = ParamGridBuilder().addGrid(reg.regParam, [0.0, 0.1]).build()
    mse = RegressionEvaluator(labelCol=label_col, metricName="mse")
    inner = hash_bucket(F.concat(F.lit("validation-"), F.col(key).cast("string")), 100) < int(100 * train_ratio)
    with _persisted(known_features(train, feature_cols)) as t:
        fit_on, check_on = t.filter(inner), t.filter(~inner)
        if check_on.isEmpty() or fit_on.isEmpty():
            return pipe.fit(t)
        best = min(grid, key=lambda params: mse.evaluate(pipe.fit(fit_on, params).transform(check_on)))
        return pipe.fit(t, best)


def known_features(df: DataFrame, feature_cols=FEATURE_COLUMNS) -> DataFrame:
    """Null and NaN features become 0, so that every row is scored."""
    here = [c for c in feature_cols if c in df.columns]
    doubles = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c), F.lit(0.0)) if c in doubles else F.col(c), F.lit(0)) for c in here})


class _persisted:
    """Keep an iteratively-read training frame (one row per customer or per
    series step -- far smaller than the lines it comes from) in executor
    memory/disk for the duration of a fit; each optimiser pass would
    otherwise recompute it from the scans.  Lost blocks are recomputed from
    lineage, so an executor loss does not fail the fit."""

    def __init__(self, df: DataFrame):
        self.df = df

    def __enter__(self) -> DataFrame:
        return self.df.persist(StorageLevel.MEMORY_AND_DISK)

    def __exit__(self, *exc) -> None:
        self.df.unpersist()


def evaluate(pred: DataFrame, label_col: str = "target_rev",
             pred_col: str = "prediction") -> dict:
    """MAE, MSE, RMSE of a prediction frame, in one aggregation."""
    e = F.col(pred_col) - F.col(label_col)
    r = pred.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse")).first()
    return {"mae": r["mae"], "mse": r["mse"], "rmse": None if r["mse"] is None else r["mse"] ** 0.5}


# ---- U4: versioned model registry ------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def model_versions(spark: SparkSession, model_dir: str) -> list[int]:
    """Version numbers present in the registry; other names are ignored."""
    fs, p = _fs(spark, model_dir)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m:
            out.append(int(m.group(1)))
    return sorted(out)


def next_model_version(spark: SparkSession, model_dir: str) -> int:
    """U4: max existing version + 1 (1 for an empty registry)."""
    vs = model_versions(spark, model_dir)
    return (vs[-1] + 1) if vs else 1


def save_model_version(spark: SparkSession, model: PipelineModel, model_dir: str) -> str:
    path = f"{model_dir.rstrip('/')}/{MODEL_PREFIX}{next_model_version(spark, model_dir)}"
    model.write().overwrite().save(path)
    return path


def _latest_path(spark: SparkSession, model_dir: str) -> str | None:
    vs = model_versions(spark, model_dir)
    return f"{model_dir.rstrip('/')}/{MODEL_PREFIX}{vs[-1]}" if vs else None


def _is_linear(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, f"{path}/linear/_SUCCESS")
    return fs.exists(p)


def load_latest_model(spark: SparkSession, model_dir: str) -> PipelineModel | LinearModel | None:
    path = _latest_path(spark, model_dir)
    if path is None:
        return None
    return load_linear(spark, path) if _is_linear(spark, path) else PipelineModel.load(path)


def first_linear(spark: SparkSession, model_dir: str, train: DataFrame, feature_cols=FEATURE_COLUMNS,
                 label_col: str = "target_rev") -> str:
    """Fit a linear model on ``train`` alone and save it, with its sums, as the next version."""
    return _save_sums(spark, model_dir, moment_sums(train, feature_cols, label_col), label_col)


def update_linear(spark: SparkSession, model_dir: str, new_rows: DataFrame, feature_cols=FEATURE_COLUMNS,
                  label_col: str = "target_rev") -> str:
    """Add the sums of ``new_rows`` to those of the latest version and save the model of
    both as the next version.  Rows of earlier versions are not read again; without an
    earlier linear version the model is that of ``new_rows`` alone."""
    latest = _latest_path(spark, model_dir)
    sums = moment_sums(new_rows, feature_cols, label_col)
    if latest and _is_linear(spark, latest):
        sums = merge_sums(load_sums(spark, latest), sums)
    return _save_sums(spark, model_dir, sums, label_col)


def _save_sums(spark: SparkSession, model_dir: str, sums: DataFrame, label_col: str) -> str:
    path = f"{model_dir.rstrip('/')}/{MODEL_PREFIX}{next_model_version(spark, model_dir)}"
    sums = sums.persist()                                 # one row per pair of columns
    try:
        save_linear(spark, path, solve(sums, label_col), sums)
    finally:
        sums.unpersist()
    return path


def update_model(spark: SparkSession, model_dir: str, train: DataFrame,
                 feature_cols=FEATURE_COLUMNS, label_col: str = "target_rev",
                 kind: str = "linear") -> str:
    """U3 (fine-tune): bring the latest version up to date with ``train`` and save the next one.

    A linear model adds the sums of the new rows to its own (``update_linear``).  Trees
    cannot be merged: they are fitted again with the parameters chosen before, on
    ``train``, which then has to hold all rows."""
    if kind == "linear":
        return update_linear(spark, model_dir, train, feature_cols, label_col)
    prev = load_latest_model(spark, model_dir)
    if prev is None:
        model = fit_value_model(train, feature_cols, label_col, kind)
    else:
        est, _ = value_pipeline(feature_cols, label_col, kind)
        reg_prev = prev.stages[-1]
        reg_new = est.getStages()[-1]
        for p in ("regParam", "elasticNetParam", "maxDepth", "maxIter"):
            if reg_prev.hasParam(p) and reg_new.hasParam(p) and reg_prev.isSet(p):
                reg_new.set(reg_new.getParam(p), reg_prev.getOrDefault(p))
        with _persisted(known_features(train, feature_cols)) as t:
            model = est.fit(t)
    return save_model_version(spark, model, model_dir)


# ---- U7: one-step series forecast ------------------------------------------

def fit_series_model(windows: DataFrame, x_cols=("x0", "x1"), label_col: str = "y"):
    """U7 re-aimed: linear one-step forecast of y from the values before it."""
    return fit_linear(windows, list(x_cols), label_col)
