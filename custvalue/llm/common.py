"""Helpers shared by the training-data operators.

Everything that has to outlive one job (lineage cuts, tables read twice) goes
to the shared folder named by ``spark.checkpoint.dir``; nothing is kept in a
machine-local folder or in an executor's block manager, so a lost executor
costs only the tasks it was running.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custvalue.session import checkpoint_root

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (any store Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Used for tables that several later steps read: the dear work runs once and
    survives executor loss.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: ends the lineage of an iterative step."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


BATCH_BYTES, BATCH_ROWS = 4 << 20, 1_000


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches between Spark and Python workers by bytes and rows.

    Spark's defaults are 64 MB and 10,000 rows, held in the executor and again, unpacked, in
    every worker.  Results do not depend on batches.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def boxed(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct ``row``: an operator's own columns stand beside it,
    so no column of the user can clash with them; ``row.*`` gives them back unchanged."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def text_key(text: Column) -> Column:
    """128-bit identity of a text; null and empty text share one key."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def join_small(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
               max_rows: int = 200_000, salts: int = 16) -> DataFrame:
    """Join ``big`` (any key may hold most of its rows) with a table of one row per key.

    ``small`` is counted first.  Up to ``max_rows`` rows it is broadcast and
    ``big`` is not shuffled.  Beyond that ``big`` is salted by a row hash and
    ``small`` is repeated once per salt, so a hot key spreads over ``salts``
    tasks; the join is a sort-merge join whatever the planner expects, as it sees the
    compressed file of ``small``, not the repeated rows, and would send those through the
    driver.  Both ways give the same rows.  Null keys match null keys.
    """
    names = [c for c in small.columns if c not in keys]
    small = small.select(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in keys],
                         *[F.col(f"`{c}`") for c in names])
    cond = None
    for k in keys:
        c = big[k].eqNullSafe(small[f"__k_{k}"])
        cond = c if cond is None else cond & c
    if small.limit(max_rows + 1).count() <= max_rows:
        out = big.join(F.broadcast(small), cond, how)
    else:
        salted = big.withColumn("__salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)))
        small = small.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cond = salted["__salt"] == small["__s"]
        for k in keys:
            cond = cond & salted[k].eqNullSafe(small[f"__k_{k}"])
        out = salted.join(small.hint("merge"), cond, how).drop("__salt", "__s")
    return out.drop(*[f"__k_{k}" for k in keys])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every node of ``edges(src, dst)``; component = smallest id.

    Each round halves the distance of a node to its root (hook to the smallest
    grandparent seen over an edge, then shortcut), so chains of length n take
    about log n rounds.  Only joins and mergeable ``min`` aggregations: a hub
    with most of the edges is combined on the map side.  Every round is a
    checkpoint.  An edge list without rows gives no rows.
    """
    both = cut(edges.select("src", "dst").where("src != dst")
               .unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")).where("src != dst"))
               .distinct())
    parent = cut(both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("m"))
                 .select("id", F.least("id", "m").alias("p")))
    for _ in range(max_rounds):
        # many nodes may share one parent and many edges one hub: both look it up in a
        # table of one row per key, never in a plain join on that key
        asked = parent.select(F.col("p").alias("__q")).distinct()
        roots = asked.join(parent, F.col("__q") == F.col("id")).select(F.col("__q").alias("p"), F.col("p").alias("g"))
        grand = cut(join_small(parent, written(roots, "roots"), ["p"]).select("id", "p", "g"))
        seen = (join_small(both, grand.select(F.col("id").alias("dst"), F.col("g").alias("gv")), ["dst"])
                .groupBy("src").agg(F.min("gv").alias("m")))
        hook = grand.join(seen.withColumnRenamed("src", "id"), "id")
        moves = hook.select(F.explode(F.array(
            F.struct(F.col("id").alias("id"), F.least("p", "g", "m").alias("p")),
            F.struct(F.col("p").alias("id"), F.least("m", "g").alias("p")))).alias("x")).select("x.*")
        new = cut(moves.groupBy("id").agg(F.min("p").alias("p")))
        moved = (new.join(parent.withColumnRenamed("p", "old"), "id")
                 .where("p != old").limit(1).count())
        parent = new
        if not moved:
            return parent.select("id", F.col("p").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
