"""Sharding by balanced label propagation.

Every document starts in a hashed shard.  In each round, Spark joins tell each
linked document where its neighbours are; a document that has more neighbours
in another shard asks to move there.  Requests meet capacity quotas: opposite
moves between two shards may always be swapped, and a shard with room takes its
share of the rest; which requests are granted is a keyed hash, not an order.

Groups of equal text that are then still cut are brought together, each in the
shard with most of its rows among those whose even count has room for the rest.

Afterwards the sizes are made exactly even: the rows of each shard are numbered,
documents without links last, and what lies beyond the shard's even count fills
the others.  So only documents whose move cuts no link leave, as long as there
are enough of them; groups larger than ``whole_group`` are the next to be cut.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import cut, join_small, text_key, written

SHARDS, MOVE_ROUNDS, SLACK, WHOLE_GROUP, BUCKET_ROWS = 8, 8, 0.05, 10_000, 20_000
GATHER_CELLS = 1024


def _unit(*cols) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / float(1 << 53)


def propagate(nodes: DataFrame, edges: DataFrame, free: int, shards: int,
              rounds: int = MOVE_ROUNDS, slack: float = SLACK) -> DataFrame:
    """(id, label) of the linked ``nodes(id, label)`` after ``rounds`` of quota-bound moves.

    ``edges(src, dst)`` join ids of ``nodes``.  ``free`` counts rows without a
    link: they can fill any shard afterwards, so linked rows may take up a whole
    even share; with few free rows a shard may exceed it by ``slack``.  A round is two joins and mergeable counts; only a
    table of at most ``shards`` squared rows is collected.
    """
    both = cut(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    labels = cut(nodes.select("id", "label"))
    size = labels.count() + free
    cap = size / shards * (1 if free >= slack * size else 1 + slack)
    for turn in range(rounds):
        votes = (both.join(labels.select(F.col("id").alias("dst"), "label"), "dst")
                 .groupBy(F.col("src").alias("id"), "label").agg(F.count("*").alias("n")))
        best = votes.groupBy("id").agg(F.max(F.struct(F.col("n"), (-F.col("label")).alias("l"))).alias("b"),
                                       F.collect_list(F.struct("label", "n")).alias("all"))   # at most one entry per shard
        here = F.coalesce(F.element_at(F.map_from_entries("all"), F.col("label")), F.lit(0))
        asks = cut(labels.join(best, "id").select("id", "label", (-F.col("b.l")).alias("to"), (F.col("b.n") - here).alias("gain"))
                   .where("gain > 0").where(F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)) == 0).select("id", "label", "to"))
        flow = {(r["label"], r["to"]): r["n"] for r in asks.groupBy("label", "to").agg(F.count("*").alias("n")).collect()}
        if not flow:
            continue
        held = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
        grants = []
        for (i, j), n in sorted(flow.items()):
            swap = min(n, flow.get((j, i), 0))
            want = sum(m - min(m, flow.get((j, a), 0)) for (a, b), m in flow.items() if b == j)
            room = max(0.0, cap - held.get(j, 0))
            extra = (n - swap) * min(1.0, room / want) if want else 0.0
            grants.append((i, j, (swap + extra) / n))
        quota = labels.sparkSession.createDataFrame(grants, "label int, `to` int, part double")
        moved = (asks.join(F.broadcast(quota), ["label", "to"])                               # at most shards^2 rows
                 .where(_unit(F.col("id"), F.lit(-1 - turn)) < F.col("part")).select("id", F.col("to").alias("new")))
        labels = cut(labels.join(moved, "id", "left").select("id", F.coalesce("new", "label").alias("label")))
    return labels


def gather(held: DataFrame, even: list[int]) -> DataFrame:
    """(hub, home) of the groups of ``held(hub, label, n)`` that move whole to one shard.

    It is the shard with most of their rows among those with room for the rest:
    the shard's linked rows stay within its ``even`` count.  Groups move,
    those with few rows elsewhere first, until none fits.  A gathered group is
    never cut again, so this ends.  Per turn one aggregation, and a running sum
    over at most shards x 64 x ``GATHER_CELLS`` rows.
    """
    moved = None
    for turn in count():
        full = {r["label"]: r["n"] for r in held.groupBy("label").agg(F.sum("n").alias("n")).collect()}   # one row per shard
        rooms = [max(0, e - full.get(j, 0)) for j, e in enumerate(even)]
        room = F.element_at(F.array(*[F.lit(r).cast("bigint") for r in rooms]), F.col("home") + 1)
        away = [F.col("all") - F.coalesce(F.element_at("at", F.lit(j)), F.lit(0)) for j in range(len(even))]
        best = F.array_min(F.array(*[F.when(a <= r, F.struct(a.alias("away"), F.lit(j).alias("home")))
                                     for j, (a, r) in enumerate(zip(away, rooms))]))
        lead = (held.groupBy("hub").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("at"),   # at most one entry per shard
                                        F.sum("n").alias("all"))
                .where(F.size("at") > 1).select("hub", best.alias("b")).where("b is not null").select("hub", "b.*"))
        cell = ["home", "many", "cell"]
        lead = cut(lead.withColumn("many", F.length(F.bin("away")))
                   .withColumn("cell", F.pmod(F.xxhash64("hub", F.lit(turn)), F.lit(GATHER_CELLS))))
        before = Window.partitionBy("home").orderBy("many", "cell").rowsBetween(Window.unboundedPreceding, 0)
        fits = (lead.groupBy(*cell).agg(F.sum("away").alias("n")).withColumn("n", F.sum("n").over(before))
                .where(F.col("n") <= room).select(*cell))
        go = cut(lead.join(fits, cell).select("hub", "home"))
        if not go.limit(1).count():
            # a cell too large for the room left: its smallest group alone fits
            go = cut(lead.groupBy("home").agg(F.min(F.struct("away", "hub")).alias("g")).select("g.hub", "home"))
            if not go.limit(1).count():
                return go if moved is None else moved
        moved = go if moved is None else cut(moved.unionByName(go))
        held = cut(held.join(go, "hub", "left").withColumn("label", F.coalesce("home", "label"))
                   .groupBy("hub", "label").agg(F.sum("n").alias("n")))


def cut_edges(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges whose ends lie in different shards."""
    a = labels.select(F.col("id").alias("src"), F.col("label").alias("a"))
    b = labels.select(F.col("id").alias("dst"), F.col("label").alias("b"))
    return edges.join(a, "src").join(b, "dst").where("a != b")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = MOVE_ROUNDS,
                    whole_group: int = WHOLE_GROUP, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Law ``rows``: shard counts differ by at most one; documents of equal text are
    linked and kept together where the counts allow.  ``slot`` numbers a shard's
    rows without a gap from 0; ``grown_shard`` is null under this law.

    * null text: size 1, CRC of no bytes, linked with empty texts;
    * repeated rows and null ids are rows like any other;
    * an empty table gives an empty result; further columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = written(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                               (F.octet_length(text) + 1).cast("bigint").alias("size"),
                               F.crc32(text).alias("text_crc32"), text_key(F.col("text")).alias("key")), "shard-rows")
    groups = written(slim.groupBy("key").agg(F.count("*").alias("n"), F.min("rid").alias("hub")).where("n > 1"), "shard-groups")
    rows = join_small(slim, groups, ["key"], "left")
    start = F.pmod(F.xxhash64("doc_id", "key", F.when(F.col("n").isNotNull(), F.col("rid"))), F.lit(shards)).cast("int")
    rows = written(rows.withColumn("label", start), "shard-start")
    linked = rows.where("n is not null")
    free = rows.where("n is null").count()
    labels = propagate(linked.select(F.col("rid").alias("id"), "label"),
                       linked.where("rid != hub").select(F.col("rid").alias("src"), F.col("hub").alias("dst")),
                       free, shards, rounds)
    rows = (rows.join(labels.select(F.col("id").alias("rid"), F.col("label").alias("moved")), "rid", "left")
            .withColumn("label", F.coalesce("moved", "label")).drop("moved"))
    total = free + labels.count()
    even = [total // shards + (j < total % shards) for j in range(shards)]
    rows = written(rows, "shard-moved")
    homes = gather(cut(rows.where("n is not null").groupBy("hub", "label").agg(F.count("*").alias("n"))), even)
    rows = join_small(rows, homes, ["hub"], "left").withColumn("label", F.coalesce("home", "label")).drop("home")

    buckets = max(1, -(-total // bucket_rows))
    klass = F.when(F.col("n").isNull(), 2).when(F.col("n") > whole_group, 1).otherwise(0)
    spread = F.pmod(F.when(F.col("n") <= whole_group, F.xxhash64("key")).otherwise(F.xxhash64("doc_id", "key", F.col("rid") % 64)),
                    F.lit(buckets))
    rows = cut(rows.withColumn("klass", klass).withColumn("bucket", spread).drop("n", "hub"))
    place = ["label", "klass", "bucket"]
    counts = cut(rows.groupBy(*place).agg(F.count("*").alias("n")))
    have = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    over, free = [0], [0]
    for j in range(shards):
        over.append(over[-1] + max(0, have.get(j, 0) - even[j]))
        free.append(free[-1] + max(0, even[j] - have.get(j, 0)))
    pick = lambda values, at: F.element_at(F.array(*[F.lit(int(v)).cast("bigint") for v in values]), (at + 1).cast("int"))

    before = Window.partitionBy("label").orderBy("klass", "bucket").rowsBetween(Window.unboundedPreceding, 0)
    starts = counts.withColumn("first", F.sum("n").over(before) - F.col("n")).drop("n")
    within = Window.partitionBy(*place).orderBy("key", "doc_id", "rid")
    rows = (rows.withColumn("rank", F.row_number().over(within) - 1).join(starts, place)
            .withColumn("pos", F.col("first") + F.col("rank")))
    stays = F.col("pos") < pick(even, F.col("label"))
    spill = pick(over[:-1], F.col("label")) + F.col("pos") - pick(even, F.col("label"))
    home = F.size(F.filter(F.array(*[F.lit(int(v)).cast("bigint") for v in free[1:]]), lambda v: v <= spill))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.when(stays, F.col("label")).otherwise(home).cast("int").alias("shard"),
        F.when(stays, F.col("pos")).otherwise(
            pick([min(have.get(j, 0), even[j]) for j in range(shards)] + [0], home) + spill - pick(free, home)).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
