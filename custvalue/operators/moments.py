"""Least squares from mergeable sums (U3): a model that is updated, not refitted.

A model version keeps the sums of all products of its columns (the Gram matrix).
The sums of two sets of rows add up to those of both together, so an update reads
only the new rows.  The rows are summed in one aggregation on the executors; what
reaches the driver is one number per pair of features.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLUMNS

SUMS = "a string, b string, s double"
ONE = "1"                         # the constant column
RIDGE = 1e-6                      # added to the diagonal of the correlation matrix


def moment_sums(df: DataFrame, feature_cols=FEATURE_COLUMNS, label_col: str = "target_rev") -> DataFrame:
    """``a, b, s``: the sum of ``a * b`` for every pair of columns, the constant ``1`` included.

    Null and NaN features count as 0, as in scoring; rows without a finite label are left out.
    """
    label = F.col(label_col).cast("double")
    cols = {ONE: F.lit(1.0), **{c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in feature_cols},
            label_col: label}
    known = df.where(label.isNotNull() & ~F.isnan(label) & (F.abs(label) < F.lit(float("inf"))))
    flat = known.select(*[c.alias(f"x{i}") for i, c in enumerate(cols.values())])
    names = list(cols)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    one = flat.agg(*[F.coalesce(F.sum(F.col(f"x{i}") * F.col(f"x{j}")), F.lit(0.0)).alias(f"s{i}_{j}") for i, j in pairs])
    rows = [F.struct(F.lit(names[i]).alias("a"), F.lit(names[j]).alias("b"), F.col(f"s{i}_{j}").alias("s")) for i, j in pairs]
    return one.select(F.inline(F.array(*rows)))


def merge_sums(*sums: DataFrame) -> DataFrame:
    """The sums of several disjoint sets of rows taken together."""
    out = sums[0].select("a", "b", "s")
    for s in sums[1:]:
        out = out.unionByName(s.select("a", "b", "s"))
    return out.groupBy("a", "b").agg(F.sum("s").alias("s"))


class LinearModel:
    """Intercept and coefficients; ``transform`` adds ``prediction`` as a column expression."""

    def __init__(self, intercept: float, coefficients: dict[str, float], label_col: str = "target_rev"):
        self.intercept, self.coefficients, self.label_col = intercept, coefficients, label_col

    def score(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in self.coefficients.items():
            out = out + F.lit(float(w)) * F.col(c).cast("double")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.score())

    def to_json(self) -> str:
        return json.dumps({"intercept": self.intercept, "coefficients": self.coefficients, "label_col": self.label_col})

    @classmethod
    def from_json(cls, text: str) -> "LinearModel":
        return cls(**json.loads(text))


def solve(sums: DataFrame, label_col: str = "target_rev", ridge: float = RIDGE) -> LinearModel:
    """Least squares on standardised columns; columns of one value get the coefficient 0."""
    rows = sums.collect()                                 # one per pair of columns
    names = list(dict.fromkeys(r["a"] for r in rows if r["a"] not in (ONE, label_col)))
    at = {}
    for r in rows:
        at[(r["a"], r["b"])] = at[(r["b"], r["a"])] = r["s"]
    n = at.get((ONE, ONE), 0.0)
    if not n:
        raise ValueError("no rows to fit on")
    cols = [*names, label_col]
    mean = np.array([at[(ONE, c)] / n for c in cols])
    cov = np.array([[at[(a, b)] / n for b in cols] for a in cols]) - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    varies = sd > 1e-9 * np.maximum(np.abs(mean), 1e-300)
    use = [i for i in range(len(names)) if varies[i]]
    coef = np.zeros(len(names))
    if use and varies[-1]:
        r = cov / np.outer(np.where(varies, sd, 1.0), np.where(varies, sd, 1.0))
        beta = np.linalg.solve(r[np.ix_(use, use)] + ridge * np.eye(len(use)), r[use, -1])
        coef[use] = beta * sd[-1] / sd[use]
    return LinearModel(float(mean[-1] - coef @ mean[:-1]), {c: float(w) for c, w in zip(names, coef)}, label_col)


def fit_linear(train: DataFrame, feature_cols=FEATURE_COLUMNS, label_col: str = "target_rev",
               ridge: float = RIDGE) -> LinearModel:
    """A linear model of one set of rows."""
    return solve(moment_sums(train, feature_cols, label_col), label_col, ridge)


def save_linear(spark: SparkSession, path: str, model: LinearModel, sums: DataFrame) -> None:
    """One model version: its sums, then its coefficients (a version without them is unfinished)."""
    sums.coalesce(1).write.mode("overwrite").parquet(f"{path}/sums")
    spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/linear")


def load_linear(spark: SparkSession, path: str) -> LinearModel:
    return LinearModel.from_json(spark.read.text(f"{path}/linear").first()["value"])


def load_sums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMS).parquet(f"{path}/sums")
