"""Mixing sources to target weights by temperature.

Source token shares ``p`` are raised to an exponent ``alpha`` and normalised:
``w = p^alpha / sum(p^alpha)``.  ``alpha`` is found by interval bisection, either
so that no source is repeated more than a limit, or so that the weights have a
given entropy.  The weights are then realised exactly by passes: every source
gets ``epochs = w * budget / tokens`` passes over its documents; whole passes
take every document, the last, partial one takes blocks of the source in the
order of a keyed permutation until its token budget is met, and within the last
block documents in keyed order.

Only per-source and per-block tables are aggregated; a hot source is many
blocks, and which documents are taken is decided row by row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import boxed, cut, join_small, text_key, written
from custvalue.llm.shards import feistel_slots

SEED, BLOCK_TOKENS, MAX_REPEATS = 20, 4_000_000, 2.0
_SECTIONS, _ROUNDS = 16, 9


def token_count(text: Column) -> Column:
    """Number of white-space separated words of the whole text (null or blank: 0)."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+"))).cast("bigint")


def temperature(shares: DataFrame, max_repeats: float | None = None, entropy: float | None = None) -> float:
    """The exponent for ``shares(p)``, p > 0.

    ``max_repeats``: the largest ratio allowed between the passes of any two
    sources; the smallest exponent that keeps it.  ``entropy`` (in nats): the
    exponent whose weights have it, clipped to [0, 1].  Every round evaluates
    one grid of exponents in a single aggregation, so the number of sources
    does not matter.
    """
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give either max_repeats or entropy")
    if max_repeats is not None and max_repeats < 1:
        raise ValueError("max_repeats must be at least 1")
    lo, hi = 0.0, 1.0
    logs = shares.select(F.ln("p").alias("l"))
    for _ in range(_ROUNDS):
        grid = [lo + (hi - lo) * i / _SECTIONS for i in range(_SECTIONS + 1)]
        if max_repeats is not None:
            r = logs.agg((F.max("l") - F.min("l")).alias("gap")).first()["gap"] or 0.0
            fits = [(1 - a) * r <= math.log(max_repeats) + 1e-12 for a in grid]
        else:
            e = [F.exp(F.lit(a) * F.col("l")) for a in grid]
            row = logs.agg(*[F.struct(F.sum(x).alias("z"), F.sum(x * F.col("l")).alias("s")).alias(f"g{i}")
                             for i, x in enumerate(e)]).first()
            if row["g0"]["z"] is None:
                return 1.0
            # entropy falls as the exponent rises
            fits = [math.log(row[f"g{i}"]["z"]) - a * row[f"g{i}"]["s"] / row[f"g{i}"]["z"] <= entropy
                    for i, a in enumerate(grid)]
        if fits[0]:
            return grid[0]
        if not fits[-1]:
            return grid[-1]
        k = fits.index(True)
        lo, hi = grid[k - 1], grid[k]
    return hi


def _key(*parts) -> Column:
    """Keyed 63-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), 1)


def block_rank(block: Column, blocks: Column, epoch: Column, seed: int) -> Column:
    """Place of a block in the pass's keyed permutation of 0 .. blocks-1: a Feistel network with
    cycle-walking, keyed by seed and pass."""

    @F.arrow_udf("bigint")
    def place(block: pa.Array, blocks: pa.Array, epoch: pa.Array) -> pa.Array:
        b, n, e = (np.asarray(x.fill_null(0).to_numpy(zero_copy_only=False), np.int64) for x in (block, blocks, epoch))
        out = np.zeros(len(b), np.int64)
        for size, turn in set(zip(n.tolist(), e.tolist())):
            here = (n == size) & (e == turn)
            out[here] = feistel_slots(b[here], max(size, 1), seed * 1_000_003 + turn)
        return pa.array(out, pa.int64())

    return place(block, blocks, epoch.cast("bigint"))


def mix_plan(rows: DataFrame, budget_tokens: float | None, max_repeats: float | None, entropy: float | None,
             block_tokens: int, seed: int) -> DataFrame:
    """One row per source from slim ``rows(source, h, tokens)``: weight, passes and where the partial pass ends."""
    src = cut(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    filled = src.where("tokens > 0")
    total = filled.agg(F.sum("tokens").alias("t")).first()["t"] or 1
    alpha = temperature(filled.select((F.col("tokens") / float(total)).alias("p")), max_repeats, entropy)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / float(total), F.lit(alpha))).otherwise(0.0)
    norm = src.agg(F.sum(power).alias("z")).first()["z"] or 1.0
    plan = src.withColumn("alpha", F.lit(float(alpha))).withColumn("weight", power / float(norm or 1.0))
    if budget_tokens is None:                                    # the least repeated source passes exactly once
        budget_tokens = plan.where("tokens > 0").agg(F.max(F.col("tokens") / F.col("weight")).alias("b")).first()["b"] or 0.0
    epochs = F.when(F.col("tokens") > 0, F.col("weight") * float(budget_tokens) / F.col("tokens")).otherwise(1.0)
    plan = cut(plan.withColumn("epochs", epochs)
               .withColumn("full", F.floor(F.col("epochs") + 1e-9).cast("int"))
               .withColumn("rest", F.greatest(F.lit(0.0), F.col("epochs") - F.col("full")) * F.col("tokens"))
               .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("bigint")))

    placed = join_small(rows, plan.select("source", "blocks", "full", "rest"), ["source"]).where("rest >= 0.5")
    placed = placed.withColumn("block", F.pmod("h", "blocks"))
    by_block = placed.groupBy("source", "block", "blocks", "full", "rest").agg(F.sum("tokens").alias("t"))
    order = Window.partitionBy("source").orderBy("rank")
    ends = cut(by_block.withColumn("rank", block_rank(F.col("block"), F.col("blocks"), F.col("full"), seed))
               .withColumn("before", F.sum("t").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("t"))
               .where("before < rest and before + t >= rest").select("source", "rank", "block", "before"))
    last = join_small(placed, ends.withColumnRenamed("block", "eblock"), ["source"]).where("block = eblock")
    inner = Window.partitionBy("source").orderBy("dkey").rangeBetween(Window.unboundedPreceding, 0)
    cuts = (last.withColumn("dkey", _key(F.col("h"), F.col("full"), seed))
            .groupBy("source", "rest", "before", "dkey").agg(F.sum("tokens").alias("t"))
            .withColumn("done", F.col("before") + F.sum("t").over(inner) - F.col("t"))
            .where("done + t / 2 <= rest").groupBy("source").agg(F.max("dkey").alias("dlast")))
    ends = ends.select("source", "rank").join(
        cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return cut(plan.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))


def mix(docs: DataFrame, budget_tokens: float | None = None, max_repeats: float | None = MAX_REPEATS,
        entropy: float | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
        text_out: bool = True) -> DataFrame:
    """The mixture: one row per document and pass, with columns prefixed ``mix_``.

    ``mix_epoch`` numbers the pass, ``mix_weight`` is the source's normalised
    weight, ``mix_position`` in [0, 1] is the keyed training order that
    interleaves all sources in proportion to their weights.  Without
    ``budget_tokens`` the budget is the one at which the least repeated source
    passes once, so that no document is lost and none passes more than
    ``max_repeats`` times (rounded up).

    * a null source is a source of its own;
    * null, empty or blank texts have no tokens: they add nothing to the shares
      and pass with every whole pass of their source; a source without any
      token passes once;
    * rows equal in doc_id and text share their keys and are taken together, so
      a partial pass misses its budget by at most half of one such group;
    * an empty table gives an empty result; further columns are kept.
    """
    h = F.xxhash64(F.col("doc_id"), text_key(F.col("text")))
    slim = written(docs.select("source", "doc_id", h.alias("h"), token_count(F.col("text")).alias("tokens")), "mix-rows")
    plan = mix_plan(slim.select("source", "h", "tokens"), budget_tokens, max_repeats, entropy, block_tokens, seed)
    per = plan.select("source", F.struct("weight", "alpha", "epochs", "full", "rest", "blocks", "rank", "dlast").alias("__m"))
    base = docs.select(boxed(docs), "source", h.alias("__h")) if text_out else slim.withColumnRenamed("h", "__h")
    rows = join_small(base, per, ["source"])
    m = lambda c: F.col(f"__m.{c}")
    block = F.pmod("__h", m("blocks"))
    rank = block_rank(block, m("blocks"), m("full"), seed)
    partial = ((m("rest") >= 0.5) & m("rank").isNotNull()
               & ((rank < m("rank")) | ((rank == m("rank")) & (_key(F.col("__h"), m("full"), seed) <= m("dlast")))))
    passes = m("full") + F.when(partial, 1).otherwise(0)
    rows = (rows.withColumn("__block", block).withColumn("__passes", passes).where("__passes > 0")
            .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("__passes") - 1))))
    epoch = F.col("mix_epoch")
    place = ((block_rank(F.col("__block"), m("blocks"), epoch, seed)
              + _key(F.col("__h"), epoch, seed).cast("double") / float(1 << 63)) / m("blocks"))
    return (rows.withColumn("mix_weight", m("weight")).withColumn("mix_exponent", m("alpha"))
            .withColumn("mix_block", F.col("__block"))
            .withColumn("mix_position", (epoch + place) / F.greatest(m("epochs"), F.col("__passes")))
            .select(*(["row.*"] if text_out else ["source", "doc_id", "tokens"]),
                    "mix_epoch", "mix_weight", "mix_exponent", "mix_block", "mix_position"))
