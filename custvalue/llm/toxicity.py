"""Toxicity by maximum-scoring segments.

Tokens are words and, for words too rare to be judged, their known prefixes.
Each token scores its log-odds between toxic and other labelled documents,
smoothed by a Dirichlet prior proportional to the token's pooled frequency;
all other words score a small negative amount.  Every occurrence counts; one
close behind the last of the same word only makes up for the drift in between.
A linear scan finds every maximal scoring segment of the whole text.  Segment scores are put on an
extreme-value scale (expected number of such segments by chance in a text of
that length), and the text's segments together give a calibrated probability.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custvalue.llm.quality import Logistic

MAX_LABELLED, PREDICT_AT = 12_000, 0.3
PRIOR_DOCS, PRIOR_EACH = 20.0, 0.5                               # Dirichlet prior: pooled share of so many documents, plus an even part
SIGNIFICANT, LEAST_ODDS, MAX_TOKENS, PREFIXES, DRIFT, SHORT = 3.0, 1.5, 20_000, (4, 5, 6), 0.05, 64
_KEEP = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and non-ASCII bytes of the whole text."""
    return (text or "").lower().encode().translate(_KEEP).split()


def _tokens(word: bytes) -> list[bytes]:
    """The word and its proper prefixes (marked by a trailing star)."""
    return [word] + [word[:k] + b"*" for k in PREFIXES if len(word) > k]


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a sequence of words.

    ``hits`` lists the position and score of the words that do not score
    ``-drift``, in order.  One pass with a stack of candidate segments, each
    with the cumulative score before and after it.
    """
    stack: list[list] = []                                       # [first, last, before, after]
    total, seen = 0.0, 0
    for at, score in hits:
        total -= drift * (at - seen)
        seen = at + 1
        if score <= 0:
            total += score
            continue
        new = [at, at, total, total + score]
        total += score
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j -= 1
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
    return [(a, b, after - before) for a, b, before, after in stack]


@dataclass
class ToxicModel:
    score: dict[bytes, float]
    gate: frozenset[bytes]                                       # first bytes of every prefix token
    lam: float = 1.0
    k: float = 1.0
    link: Logistic | None = None
    prior: float = 0.0

    def word_score(self, word: bytes) -> float | None:
        s = self.score.get(word)
        if s is None and word[:PREFIXES[0]] in self.gate:
            for k in reversed(PREFIXES):
                if len(word) > k and (s := self.score.get(word[:k] + b"*")) is not None:
                    return s
        return s

    def chance(self, n: int) -> float:
        """Log of the number of places where a segment can start in ``n`` words."""
        return math.log(max(self.k * max(n, SHORT), 1e-300))

    def segments(self, ws: list[bytes]) -> list[tuple[int, int, float]]:
        """Maximal segments with their scores."""
        score, gate, n = self.score, self.gate, PREFIXES[0]
        last: dict[bytes, int] = {}
        hits = []
        for i, w in enumerate(ws):
            if (w in score or w[:n] in gate) and (s := self.word_score(w)) is not None:
                if w in last:                                    # a near repeat makes up for the drift since, no more
                    s = math.copysign(min(abs(s), DRIFT * (i - last[w])), s)
                last[w] = i
                hits.append((i, s))
        return maximal_segments(hits, DRIFT)

    def evidence(self, ws: list[bytes]) -> tuple[float, float, int, list[tuple[int, int, float]]]:
        """(-ln E of the best segment, sum over significant ones, their number, the segments)."""
        segs = self.segments(ws)
        if not segs:
            return 0.0, 0.0, 0, segs
        rarity = [self.lam * s - self.chance(len(ws)) for _, _, s in segs]
        good = [r for r in rarity if r > 0]
        return max(0.0, max(rarity)), sum(good), len(good), segs

    def probability(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        if self.link is None:
            return np.full(len(best), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.link.margin(np.c_[np.log1p(best), np.log1p(total)]), -30, 30)))


def _extreme_value(scores: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """(lambda, K): lambda solves E[exp(lambda s)] = 1 for background word scores; K scales the count of starts."""
    s, p = np.append(scores, -DRIFT), np.append(share, max(1e-9, 1 - share.sum()))
    if s.max() <= 0 or (s * p).sum() >= 0:
        return 0.1, 1.0
    lo, hi = 1e-6, 1.0
    while (p * np.exp(np.minimum(hi * s, 500))).sum() < 1 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * s, 500))).sum() < 1 else (lo, mid)
    return hi, float(np.clip(p[s > 0].sum(), 1e-12, 1.0))


def held_out(doc_id: Column) -> Column:
    """Labels of these documents are never learned from: CRC-32 of the id modulo 4 is 2 (null ids too)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def _log_odds(docs: np.ndarray, toxic: np.ndarray, n: int, n1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds under the Dirichlet prior, their standard error, and the smoothed count outside toxic documents."""
    prior = PRIOR_DOCS * docs / n + PRIOR_EACH
    y1, y0 = toxic + prior, docs - toxic + prior
    return np.log(y1 / n1) - np.log(y0 / (n - n1)), np.sqrt(1 / y1 + 1 / y0), y0


def _model(tokens: list[bytes], docs: np.ndarray, toxic: np.ndarray, uses: np.ndarray, n: int, n1: int,
           mean_words: float) -> ToxicModel:
    """``uses``: how often each token stands in documents that are not toxic."""
    if not n1 or n1 == n:
        return ToxicModel({}, frozenset())
    odds, error, other = _log_odds(docs, toxic, n, n1)
    sure = np.sign(odds) * np.maximum(np.abs(odds) - error, 0)   # one standard error towards zero
    keep = np.flatnonzero((np.abs(odds) >= SIGNIFICANT * error) & (np.abs(sure) >= LEAST_ODDS))
    keep = keep[np.argsort(-np.abs(odds / error)[keep], kind="stable")][:MAX_TOKENS]
    score = {tokens[i]: float(sure[i]) for i in keep}
    again = uses - (docs - toxic)                                # occurrences beyond the first of a document
    lam, k = _extreme_value(sure[keep], (other + again)[keep] / (n - n1) / mean_words)
    return ToxicModel(score, frozenset(t[:PREFIXES[0]] for t in score if t.endswith(b"*")), lam, k)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> ToxicModel:
    """Fit on at most ``max_labelled`` labelled documents outside the held-out fold, chosen by a hash of the id.

    Token scores of one half (halves by a hash of the text) rate the other half,
    and these honest ratings fit the link to a probability; the final token
    scores use both halves.  Repeated labels of a document count as its highest
    toxicity; null ids and labels are left out.  Without both classes the model
    is the smoothed share of toxic labels.
    """
    order = F.xxhash64("doc_id")
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
             .orderBy(order, "doc_id").limit(max_labelled))
    picked = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")                 # at most max_labelled rows
              .select("y", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"), "text"))
    sizes = {(r["half"], r["y"]): r for r in picked.groupBy("half", "y").agg(
        F.count("*").alias("n"), F.avg(F.length("text")).alias("c")).collect()}
    n = [sum(r["n"] for (h, _), r in sizes.items() if h == half) for half in (0, 1)]
    n1 = [sum(r["n"] for (h, y), r in sizes.items() if h == half and y == 1) for half in (0, 1)]
    if not sum(n1) or sum(n1) == sum(n):
        return ToxicModel({}, frozenset(), prior=sum(n1) / (sum(n) + 1))
    mean_words = sum((r["c"] or 0) * r["n"] for r in sizes.values()) / sum(n) / 6 + 1

    def count(batches):
        for b in batches:
            counts = [Counter() for _ in range(6)]               # documents, toxic documents and uses in others of both halves
            for y, half, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                uses = Counter()
                for w, c in Counter(words(text.as_py())).items():
                    for t in _tokens(w):
                        uses[t] += c
                counts[half].update(uses.keys())
                if y == 1:
                    counts[2 + half].update(uses.keys())
                else:
                    counts[4 + half].update(uses)
            if keys := list(counts[0].keys() | counts[1].keys()):
                yield pa.RecordBatch.from_pydict({"token": pa.array(keys, pa.binary()), **{
                    c: pa.array([k[t] for t in keys], pa.int64()) for c, k in zip(("d0", "d1", "t0", "t1", "u0", "u1"), counts)}})

    # a token in fewer than six documents cannot be significant
    table = (picked.mapInArrow(count, "token binary, d0 bigint, d1 bigint, t0 bigint, t1 bigint, u0 bigint, u1 bigint")
             .groupBy("token").agg(*[F.sum(c).alias(c) for c in ("d0", "d1", "t0", "t1", "u0", "u1")])
             .where("d0 + d1 >= 6 and t0 + t1 >= 3 or d0 + d1 >= 60")
             .orderBy(F.desc(F.abs(F.col("t0") + F.col("t1") - (F.col("d0") + F.col("d1")) * (sum(n1) / sum(n)))
                             / F.sqrt(F.col("d0") + F.col("d1"))), "token").limit(10 * MAX_TOKENS).toArrow())
    tokens = table["token"].to_pylist()
    d, t, u = ([table[f"{c}{half}"].to_numpy() for half in (0, 1)] for c in "dtu")
    model = _model(tokens, d[0] + d[1], t[0] + t[1], u[0] + u[1], sum(n), sum(n1), mean_words)
    raters = [_model(tokens, d[1 - h], t[1 - h], u[1 - h], n[1 - h], n1[1 - h], mean_words) for h in (0, 1)]
    shared = docs.sparkSession.sparkContext.broadcast(raters)

    def evidence(batches):
        for b in batches:
            got = [shared.value[half].evidence(words(text.as_py())) for half, text in zip(b.column(1).to_pylist(), b.column(2))]
            yield pa.RecordBatch.from_pydict({"y": b.column(0), "best": pa.array([g[0] for g in got], pa.float64()),
                                              "total": pa.array([g[1] for g in got], pa.float64())})

    seen = picked.mapInArrow(evidence, "y int, best double, total double").toArrow()
    x = np.log1p(np.c_[seen["best"].to_numpy(), seen["total"].to_numpy()])
    model.link = Logistic(ridge=0.1, balanced=False).fit(x, seen["y"].to_numpy().astype(np.int64))
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
                    threshold: float = PREDICT_AT) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, n_passages, passages``.

    ``passages`` holds first word, last word and score of every significant
    segment, in order.

    * null and empty texts have no passage and the lowest score of the link;
    * without labels of both classes every text gets the smoothed share of toxic labels;
    * repeated rows and null ids stay; an empty table gives an empty result;
      further columns are ignored.
    """
    model = fit_toxicity(docs, labels, max_labelled)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))

    @F.arrow_udf("struct<score:double,passages:array<struct<first:int,last:int,score:double>>>")
    def toxic(texts: pa.Array) -> pa.Array:
        model, best, total, spans = shared.value, [], [], []
        for t in texts:
            ws = words(t.as_py())
            top, everything, _, segs = model.evidence(ws)
            best.append(top)
            total.append(everything)
            bar = model.chance(len(ws)) / model.lam
            spans.append([{"first": a, "last": b, "score": s} for a, b, s in segs if s > bar])
        return pa.StructArray.from_arrays([pa.array(model.probability(np.array(best), np.array(total)), pa.float64()),
                                           pa.array(spans, kind)], names=["score", "passages"])

    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxic(F.col("text")).alias("t"))
            .select("doc_id", "held_out", "t.score", (F.col("t.score") >= threshold).cast("int").alias("predicted"),
                    F.size("t.passages").alias("n_passages"), "t.passages"))
