"""Quality classifier by co-training of a text view and a metadata view.

Both views start from the labelled documents.  In every round each view scores
all unlabelled documents and hands those it is surest about to the *other* view
as pseudo-labels, which is refitted on them and calibrated on labelled documents
it was not fitted on.  At the end the calibrated log-odds of both views are
combined by a small logistic model and every document is scored in one pass
without a shuffle.

Only the labelled documents of the fit are a bounded sample (``max_labelled``,
chosen by a hash of the id).  The unlabelled ones stay in Spark, all of them: a
histogram of each view's odds, summed over the partitions, sets the cut-offs,
and Newton's gradient and Hessian are sums over the partitions too.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custvalue.llm.common import boxed, join_small, written

MAX_LABELLED, ROUNDS, THRESHOLD = 20_000, 3, 0.5
SURE, SHARE, STEPS = 0.95, 0.1, 6
BINS, SPAN = 6_000, 15.0                     # histogram of sign(o) * log(1 + |o|) of log-odds o, from -SPAN to SPAN
CONTENT = 107
_SOURCES, _LANGS, _SIZES = 64, 16, 24
META = _SOURCES + _LANGS + _SIZES


def text_features(text: bytes | None) -> np.ndarray:
    """Content statistics of a whole text (null: as empty)."""
    b = text or b""
    n = len(b)
    if not n:
        return np.zeros(CONTENT, np.float32)
    share = np.bincount(np.frombuffer(b, np.uint8), minlength=256) / n
    words, lines = b.split(), b.split(b"\n")
    w = max(len(words), 1)
    again = sum(map(bytes.__eq__, words, words[1:]))
    distinct = len(set(words))
    return np.concatenate((share[32:128], (
        share[128:].sum(), share[65:91].sum(), share[97:123].sum(), share[48:58].sum(),
        np.log1p(n), distinct / w, again / w, n / w / 10, len(set(lines)) / len(lines),
        len(lines) / w, np.log1p(w) - np.log1p(distinct)))).astype(np.float32)


def meta_codes(source: str | None, lang: str | None, n_chars: int | None) -> bytes:
    """Places of a document's three ones among the ``META`` metadata columns: hashed source,
    hashed language, size class; a missing value is a value of its own."""
    return bytes((0 if source is None else 1 + zlib.crc32(source.encode()) % (_SOURCES - 1),
                  _SOURCES + (0 if lang is None else 1 + zlib.crc32(lang.encode()) % (_LANGS - 1)),
                  _SOURCES + _LANGS + (0 if n_chars is None else 1 + min(max(int(n_chars), 0).bit_length(), _SIZES - 2))))


def _unpack(text: list[bytes], meta: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both views of documents from their packed features."""
    a = np.frombuffer(b"".join(text), np.float32).reshape(len(text), CONTENT)
    b = np.zeros((len(meta), META), np.float32)
    b[np.arange(len(meta))[:, None], np.frombuffer(b"".join(meta), np.uint8).reshape(len(meta), 3)] = 1
    return a, b


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Logistic:
    """Ridge-penalised logistic regression with balanced classes (Newton steps)."""

    ridge: float = 1.0
    balanced: bool = True
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    coef: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.empty((len(x), x.shape[1] + 1))
        z[:, 0] = 1
        np.divide(x - self.mean, self.scale, out=z[:, 1:])
        return z

    def weights(self, y: np.ndarray) -> np.ndarray:
        if not self.balanced:
            return np.ones(len(y))
        return np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))

    def sums(self, z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Gradient and upper half of the Hessian over rows, as one vector: vectors of parts add up."""
        p = 1 / (1 + np.exp(-np.clip(z @ self.coef, -30, 30)))
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z
        return np.concatenate((z.T @ (weight * (p - y)), hess[np.triu_indices(len(self.coef))]))

    def step(self, sums: np.ndarray) -> float:
        """One Newton step from the summed vector; the largest change of a coefficient."""
        k = len(self.coef)
        hess = np.zeros((k, k))
        hess[np.triu_indices(k)] = sums[k:]
        hess = hess + np.triu(hess, 1).T
        penalty = np.full(k, self.ridge)
        penalty[0] = 1e-6
        step = np.linalg.solve(hess + np.diag(penalty + 1e-8), sums[:k] + penalty * self.coef)
        self.coef = self.coef - step
        return float(np.abs(step).max())

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 25) -> "Logistic":
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(0), x.std(0)
        self.scale[self.scale < 1e-9] = 1.0
        self.coef = np.zeros(x.shape[1] + 1)
        z, weight = self.design(x), self.weights(y)
        for _ in range(steps):
            if self.step(self.sums(z, y, weight)) < 1e-6:
                break
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.coef[0] + ((x - self.mean) / self.scale) @ self.coef[1:]


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    text_cal: Logistic
    meta_cal: Logistic
    join: Logistic
    exchanged: list[tuple[int, int]]
    prior: float | None = None

    def score(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, text view, metadata view), each the probability of quality 1."""
        if self.prior is not None:
            same = np.full(len(a), self.prior)
            return same, same, same
        ta = self.text_cal.margin(self.text.margin(a)[:, None])
        tb = self.meta_cal.margin(self.meta.margin(b)[:, None])
        out = self.join.margin(np.c_[ta, tb])
        sig = [1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (out, ta, tb)]
        return sig[0], sig[1], sig[2]


# adds up a vector of a given length, computed from both views of a block of rows, over all rows
Total = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray], int], np.ndarray]


def _bin(odds: np.ndarray) -> np.ndarray:
    """Histogram bin of log-odds: fine near 0, and far out still apart by a two-hundredth of their size."""
    at = np.sign(odds) * np.log1p(np.abs(odds))
    return np.clip(np.floor((at + SPAN) * (BINS / (2 * SPAN))), 0, BINS - 1).astype(np.int64)


def _odds(teacher: tuple[Logistic, Logistic], x: np.ndarray) -> np.ndarray:
    """Calibrated log-odds of a view's model, as histogram bins."""
    model, cal = teacher
    return _bin(cal.margin(model.margin(x)[:, None]))


def _cutoffs(hist: np.ndarray, sure: float, share: float) -> tuple[int, int]:
    """(highest bin passed on as 0, lowest bin passed on as 1): the surest ``share`` of all rows on
    each side, rows that tie with the last one included, but nothing less sure than ``sure``."""
    most = share * hist.sum()
    low, high = (int(np.searchsorted(np.cumsum(side), most)) for side in (hist, hist[::-1]))
    odds = _logit(np.array(sure))
    return min(low, int(_bin(-odds)) - 1), max(BINS - 1 - high, int(_bin(odds)) + 1)


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, total: Total,
             rounds: int = ROUNDS, sure: float = SURE, share: float = SHARE, steps: int = STEPS) -> CoTrained:
    """Co-training over the two views ``a`` and ``b`` of labelled documents and the pool behind ``total``.

    Every fifth labelled document calibrates and is never fitted on.  In round r
    a view passes on the surest ``r * share`` of the pool per class, ties included, and only
    documents whose calibrated probability of that class is at least ``sure``.
    The pseudo-labels of a class weigh as much as its labels at most, so the model
    does not depend on how much larger the pool is.  Each refit starts at zero, where
    Newton steps cannot overshoot on rows that the last model was sure and wrong about,
    and takes at most ``steps`` of them, one pass each.
    Without both classes the model is the smoothed share of class 1.
    """
    if len(y) < 20 or y.min() == y.max():
        blank = Logistic()
        return CoTrained(blank, blank, blank, blank, blank, [], float((y.sum() + 1) / (len(y) + 2)))
    cal = np.arange(len(y)) % 5 == 0
    if y[cal].min() == y[cal].max() or y[~cal].min() == y[~cal].max():
        cal[:] = True
    fit = ~cal if not cal.all() else cal

    def calibrated(v: int) -> Logistic:
        return Logistic(ridge=1e-3, balanced=False).fit(models[v].margin(views[v][cal])[:, None], y[cal])

    views = (a, b)
    models = [Logistic().fit(x[fit], y[fit]) for x in views]
    cals = [calibrated(0), calibrated(1)]
    designs = [m.design(x[fit].astype(np.float64)) for m, x in zip(models, views)]
    weight = models[0].weights(y[fit])
    label_weight = [weight[y[fit] == c].max() for c in (0, 1)]       # of one label, and of all labels of a class
    class_weight = [weight[y[fit] == c].sum() for c in (0, 1)]
    sizes = [len(m.coef) + len(m.coef) * (len(m.coef) + 1) // 2 for m in models]
    exchanged = []
    for turn in range(rounds):
        teachers = [(replace(m), c) for m, c in zip(models, cals)]

        def histograms(*x: np.ndarray) -> np.ndarray:
            return np.concatenate([np.bincount(_odds(t, v), minlength=BINS) for t, v in zip(teachers, x)]).astype(float)

        hists = total(histograms, 2 * BINS).reshape(2, BINS)
        cuts = [_cutoffs(h, sure, share * (turn + 1)) for h in hists]
        passed = [(int(h[:low + 1].sum()), int(h[high:].sum())) for h, (low, high) in zip(hists, cuts)]
        exchanged.append((sum(passed[0]), sum(passed[1])))
        if not any(exchanged[-1]):
            break
        # what a pseudo-label of each class weighs when it comes from each view
        pseudo = [[min(label_weight[c], class_weight[c] / max(n, 1)) for c, n in enumerate(counts)] for counts in passed]

        def newton(*x: np.ndarray) -> np.ndarray:
            out = []
            for v, model in enumerate(models):
                low, high = cuts[1 - v]
                odds = _odds(teachers[1 - v], x[1 - v])
                take = (odds <= low) | (odds >= high)
                label = (odds[take] >= high).astype(float)
                out.append(model.sums(model.design(x[v][take].astype(np.float64)), label,
                                      np.where(label == 1, pseudo[1 - v][1], pseudo[1 - v][0])))
            return np.concatenate(out)

        for m in models:
            m.coef = np.zeros(len(m.coef))
        for _ in range(steps):
            got = np.split(total(newton, sum(sizes)), [sizes[0]])
            if max(m.step(g + m.sums(z, y[fit], weight)) for m, g, z in zip(models, got, designs)) < 1e-2:
                break
        cals = [calibrated(0), calibrated(1)]
    ta, tb = (c.margin(m.margin(x[cal])[:, None]) for c, m, x in zip(cals, models, views))
    join = Logistic(ridge=1e-2, balanced=False).fit(np.c_[ta, tb], y[cal])
    return CoTrained(models[0], models[1], cals[0], cals[1], join, exchanged)


def _packed(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> tuple[list[bytes], list[bytes]]:
    return ([text_features(t.as_py()).tobytes() for t in text],
            [meta_codes(*r) for r in zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist())])


def _views(*columns: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return _unpack(*_packed(*columns))


def spark_total(pool: DataFrame) -> Total:
    """Sums over all rows of ``pool(a, b)``: one vector per task, added up by Spark."""
    def total(fn: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
        def sums(batches):
            out = np.zeros(size)
            for r in batches:
                if r.num_rows:
                    out += fn(*_unpack(r.column("a").to_pylist(), r.column("b").to_pylist()))
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_pydict({"i": pa.array(at, pa.int32()), "v": pa.array(out[at], pa.float64())})

        rows = pool.select("a", "b").mapInArrow(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(size)
        out[rows["i"].to_numpy()] = rows["v"].to_numpy()
        return out
    return total


def _with_meta(docs: DataFrame) -> DataFrame:
    """The five inputs by name; a metadata column that is not there counts as null."""
    kinds = {"source": "string", "lang": "string", "n_chars": "bigint"}
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"),
                       *[(F.col(c).cast(k) if c in docs.columns else F.lit(None).cast(k)).alias(c) for c, k in kinds.items()])


def held_out(doc_id: Column) -> Column:
    """Labels of these documents are never learned from (null ids included)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
                rounds: int = ROUNDS) -> CoTrained:
    """Fit on at most about ``max_labelled`` labelled documents and on all unlabelled ones.

    Repeated labels of a document count as its lowest quality; labels without id
    or value are left out.  Of a repeated labelled id the smallest features count;
    repeated unlabelled rows and rows without an id count each.  The features of all
    documents (some 430 bytes each) are written once to the shared folder.
    """
    key = docs.schema["doc_id"].dataType
    known = written(labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
                    .groupBy(F.col("doc_id").cast(key).alias("doc_id")).agg(F.min("quality").cast("int").alias("y"))
                    .withColumn("learn", ~held_out(F.col("doc_id"))), "quality-labels")
    part = min(1.0, max_labelled / max(known.where("learn").count(), 1))
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / float(1 << 53) < part
    known = known.withColumn("learn", F.col("learn") & drawn)

    def features(batches):
        for r in batches:
            a, b = _packed(*(r.column(c) for c in ("text", "source", "lang", "n_chars")))
            yield pa.RecordBatch.from_arrays([r.column("doc_id"), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                             names=["doc_id", "a", "b"])

    slim = _with_meta(docs)
    schema = T.StructType([T.StructField("doc_id", key), T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    rows = written(join_small(slim.mapInArrow(features, schema), known, ["doc_id"], "left"), "quality-features")
    got = (rows.where("learn").groupBy("doc_id").agg(F.min(F.struct("y", "a", "b")).alias("r"))   # max_labelled rows
           .select("doc_id", "r.*").toArrow().to_pylist())
    got.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), str(r["doc_id"])))
    a, b = _unpack([r["a"] for r in got], [r["b"] for r in got])
    return co_train(a, b, np.array([r["y"] for r in got], np.int64), spark_total(rows.where("y is null")), rounds)


def score_quality(docs: DataFrame, model: CoTrained) -> Column:
    """struct<score, text_score, meta_score> of each document; an empty text scores 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score:double,text_score:double,meta_score:double>")
    def score(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        a, b = _views(text, source, lang, n_chars)
        some = a.any(axis=1)
        s, t, m = (np.where(some, v, 0.0) for v in shared.value.score(a, b))
        return pa.StructArray.from_arrays([pa.array(s), pa.array(t), pa.array(m)],
                                          names=["score", "text_score", "meta_score"])

    cols = set(docs.columns)
    meta = [(F.col(c).cast(k) if c in cols else F.lit(None).cast(k))
            for c, k in (("source", "string"), ("lang", "string"), ("n_chars", "bigint"))]
    return score(F.col("text").cast("binary"), *meta)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, text_score, meta_score, accepted``.

    * null and empty texts score 0 and are not accepted;
    * null source, language or size is a value of its own; further columns are ignored;
    * without labels of both classes every other text gets the smoothed share of class 1;
    * repeated rows stay repeated; an empty table gives an empty result.
    """
    model = fit_quality(docs, labels)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_quality(docs, model).alias("s"))
            .select("doc_id", "held_out", "s.*").withColumn("accepted", F.col("score") >= threshold))


def accept_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, all columns unchanged.

    Null and empty texts go; repeated rows share their fate; an empty table stays empty.
    """
    model = fit_quality(docs, labels)
    return docs.select(boxed(docs), score_quality(docs, model).alias("quality")).where(
        F.col("quality.score") >= threshold).select("row.*")

