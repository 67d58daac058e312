"""Prefix trie of conversations in balanced parentheses.

Conversations are sequences of turn digests.  They are dealt in sorted order
into shards (range partitions on sequence and id, so that copies of one
conversation spread over shards).  A shard encodes its trie as balanced
parentheses, one pair per node in preorder, and reads every figure off the
encoding:

* blocks of excess with a range-min tree above them answer ``findclose``, which
  delimits the subtree of a node;
* the rank of leaf pairs ``()`` counts its leaves;
* cumulative arrays over the preorder give its conversations and savings.

A node on the first or last path of a shard may go on in the neighbour.  Each
shard knows how many turns it shares with the neighbour on either side, counts
a shared node as new only in its first shard and as a leaf only in its last;
so all figures of a node are plain sums over shards.  Only those shared spines
are merged by a shuffle; all other nodes are finished where they were built.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custvalue.llm.common import join_small, written
from custvalue.operators.order import global_positions

DIGEST = 16                       # bytes of a turn digest
SHARD_ROWS = 100_000              # turns and conversations of one shard, about
BLOCK = 64                        # parentheses of one excess block
PIECE = 512                       # ids of one piece of a member list
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"

_NODES = ("key binary, parent_key binary, shard bigint, piece bigint, conv_id bigint, depth bigint, "
          "turn_key string, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
          "saved_tokens bigint, ends string, ends_sha256 string")


# --------------------------------------------------- balanced parentheses

def findclose(bits: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Position of the parenthesis that closes each of ``opens``.

    The first later position whose excess falls below that before the opening one:
    looked for in the rest of its block, then up and down a tree of block minima.
    """
    if not len(opens):
        return opens
    n_blocks = -(-len(bits) // BLOCK)
    excess = np.full(n_blocks * BLOCK, np.iinfo(np.int64).max, np.int64)
    excess[:len(bits)] = np.cumsum(2 * bits.astype(np.int64) - 1)
    target = excess[opens] - 1
    close = np.full(len(opens), -1, np.int64)

    def scan(rows: np.ndarray, start: np.ndarray) -> None:
        """Look through the rest of the block of ``start``, all rows abreast."""
        at = start.copy()
        while len(rows):
            hit = excess[at] <= target[rows]
            close[rows[hit]] = at[hit]
            at = at + 1
            on = ~hit & (at % BLOCK != 0)
            rows, at = rows[on], at[on]

    start = opens + 1
    inside = np.flatnonzero(start % BLOCK != 0)
    scan(inside, start[inside])

    minima = [excess.reshape(n_blocks, BLOCK).min(axis=1)]
    while len(minima[-1]) > 1:
        row = minima[-1]
        row = np.append(row, np.iinfo(np.int64).max) if len(row) % 2 else row
        minima.append(row.reshape(-1, 2).min(axis=1))
    rest = np.flatnonzero(close < 0)
    block = -(-start[rest] // BLOCK)                      # first block not looked at
    found = np.full(len(rest), -1, np.int64)              # level of a subtree that holds the answer
    for level, row in enumerate(minima):                  # up
        odd = (found < 0) & ((block % 2 == 1) | (level == len(minima) - 1)) & (block < len(row))
        hit = odd.copy()
        hit[odd] = row[block[odd]] <= target[rest[odd]]
        found[hit] = level
        climb = found < 0
        block[climb] = (block[climb] + 1) >> 1
    for level in range(len(minima) - 1, 0, -1):           # down
        here = found >= level
        left = block[here] * 2
        below = minima[level - 1]
        block[here] = np.where(below[left] <= target[rest[here]], left, left + 1)
    scan(rest, block * BLOCK)
    return close


def shared_turns(a: bytes | None, b: bytes | None) -> int:
    """Number of leading turns that two sequences share (-1 if one is missing)."""
    if a is None or b is None:
        return -1
    most, d = min(len(a), len(b)) // DIGEST, 0
    while d < most and a[d * DIGEST:(d + 1) * DIGEST] == b[d * DIGEST:(d + 1) * DIGEST]:
        d += 1
    return d


class Encoded:
    """Balanced parentheses of the trie of sorted sequences, with what belongs to each node."""

    def __init__(self, paths: list[bytes], words: list[list[int]]):
        bits, depth, word, parent, turn = bytearray(b"\1"), [0], [0], [-1], [b""]
        first, count = [0], [0]                           # sequences that end at a node
        stack, before = [0], b""
        for k, path in enumerate(paths):
            if k == 0 or path != before:
                d = shared_turns(before, path)
                bits += b"\0" * (len(stack) - 1 - d)
                del stack[d + 1:]
                for d in range(d, len(path) // DIGEST):
                    bits.append(1)
                    parent.append(stack[-1])
                    stack.append(len(depth))
                    depth.append(d + 1)
                    word.append(words[k][d])
                    turn.append(path[d * DIGEST:(d + 1) * DIGEST])
                    first.append(k)
                    count.append(0)
                first[stack[-1]] = k
                before = path
            count[stack[-1]] += 1
        self.last_spine = np.array(stack)
        bits += b"\0" * len(stack)
        self.bits = np.frombuffer(bytes(bits), np.uint8)
        self.depth, self.word, self.parent = (np.array(x, np.int64) for x in (depth, word, parent))
        self.first, self.count, self.turn = np.array(first, np.int64), np.array(count, np.int64), turn
        self.open = np.flatnonzero(self.bits)
        self.close = findclose(self.bits, self.open)

    def subtree_sum(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per node over the subtree of every node."""
        total = np.concatenate([[0], np.cumsum(values)])
        start = np.arange(len(self.open))
        return total[start + (self.close - self.open + 1) // 2] - total[start]

    def leaves(self, uncounted: int | None) -> np.ndarray:
        """Leaf pairs between the parentheses of every node, but for one node's own pair."""
        pair = self.bits.astype(bool)
        pair[:-1] &= self.bits[1:] == 0
        if uncounted is not None:
            pair[self.open[uncounted]] = False
        rank = np.concatenate([[0], np.cumsum(pair)])
        return rank[self.close + 1] - rank[self.open]

    def smallest(self, ids: np.ndarray) -> np.ndarray:
        """Smallest id below every node, level by level from the deepest."""
        low = np.where(self.count > 0, ids[self.first], np.iinfo(np.int64).max)
        order = np.argsort(self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        for level in reversed(np.split(order, cuts)[1:]):
            np.minimum.at(low, self.parent[level], low[level])
        return low


def shard_nodes(rows: pa.Table, around: pa.Table) -> pa.Table:
    """Nodes of one shard: finished ones, and parts of those shared with a neighbour (with ``key``)."""
    names = [f.split()[0] for f in _NODES.split(", ")]
    rows = rows.sort_by([("path", "ascending"), ("conv_id", "ascending")])
    paths, ids = rows["path"].to_pylist(), rows["conv_id"].to_numpy()
    trie = Encoded(paths, rows["words"].to_pylist())
    left = shared_turns(around["before"][0].as_py(), paths[0])
    right = shared_turns(paths[-1], around["after"][0].as_py())

    n = len(trie.open)
    new = np.arange(n) > left                             # the first path is the start of the preorder
    going_on = int(trie.last_spine[-1]) if right * DIGEST == len(paths[-1]) else None
    convs = trie.subtree_sum(trie.count)
    saved = trie.subtree_sum((convs - new) * trie.word)
    leaves = trie.leaves(going_on)
    children = np.bincount(trie.parent[1:][new[1:]], minlength=n)
    low = trie.smallest(ids)

    keys: dict[int, bytes] = {}
    for path, spine, upto in ((paths[0], range(left + 1), left), (paths[-1], trie.last_spine.tolist(), right)):
        h = hashlib.md5()
        for d in range(upto + 1):
            if d:
                h.update(path[(d - 1) * DIGEST:d * DIGEST])
            keys[spine[d]] = h.digest() + d.to_bytes(8, "big")

    shard = rows["shard"][0].as_py()
    out: dict[str, list] = {c: [] for c in names}

    def put(*values) -> None:
        for c, v in zip(names, values):
            out[c].append(v)

    parent = trie.parent.tolist()
    figures = list(zip(low.tolist(), trie.depth.tolist(), convs.tolist(), children.tolist(), leaves.tolist(),
                       saved.tolist(), trie.first.tolist(), trie.count.tolist()))
    for v, (conv, depth, c, ch, lv, sv, k, m) in enumerate(figures):
        up = parent[v]
        members = ids[k:k + m].tolist()
        key, turn_key = keys.get(v), trie.turn[v].hex() if v else None
        if key is None:
            sha = hashlib.sha256(",".join(map(str, members)).encode()).hexdigest() if m else NO_MEMBERS
            up_key = keys.get(up)
            put(None, up_key, shard, 0, conv, depth, turn_key, None if up < 0 or up_key else figures[up][0],
                c, ch, lv, sv, None, sha)
            continue
        pieces = [",".join(map(str, members[i:i + PIECE])) for i in range(0, m, PIECE)] or [None]
        put(key, keys.get(up), shard, 0, conv, depth, turn_key, None, c, ch, lv, sv, pieces[0], None)
        for i, piece in enumerate(pieces[1:], 1):
            put(key, keys.get(up), shard, i, conv, depth, turn_key, None, 0, 0, 0, 0, piece, None)
    kinds = {"key": pa.binary(), "parent_key": pa.binary(), "turn_key": pa.string(), "ends": pa.string(),
             "ends_sha256": pa.string()}
    return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})


# ------------------------------------------------------------------ Spark

def turn_sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of a conversation in order, as (turn, digest, words).

    Null role and text count as empty; a null ``turn`` comes first; turns of one number
    follow their digest.  Rows without a ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    one = F.struct("turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    return (turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), one.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def rebased(seqs: DataFrame, every: int, head: Column, most: int) -> DataFrame:
    """Every conversation with its first ``head`` (at most ``most``) turns taken from the
    conversation whose id is the multiple of ``every`` at or before its own; none if that is missing."""
    seqs = written(seqs, "trie-turns")
    bases = (seqs.where(F.col("conv_id") % every == 0)
             .select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("lent")))
    held = (seqs.withColumn("head", head.cast("int")).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
            .join(bases, "base", "left"))
    lent = F.when(F.col("lent").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("lent", F.lit(1), F.col("head")))
    own = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return held.select("conv_id", F.concat(lent, own).alias("turns"))


def _shards(seqs: DataFrame) -> DataFrame:
    """Sequences dealt in sorted order: ``conv_id, path, words, shard``."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    flat = written(seqs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")),
                   "trie-sequences")
    rows = flat.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    n = max(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // SHARD_ROWS))
    dealt = flat.repartitionByRange(n, "path", "conv_id")
    return written(dealt.withColumn("shard", F.spark_partition_id().cast("bigint")), "trie-shards")


def _neighbours(shards: DataFrame) -> DataFrame:
    """``shard, before, after``: the last sequence before each shard and the first one after it."""
    ends = global_positions(shards.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")),
                            ["shard"], "at")
    ends = written(ends, "trie-ends")
    return (ends.select("shard", "at")
            .join(ends.select((F.col("at") + 1).alias("at"), F.col("last").alias("before")), "at", "left")
            .join(ends.select((F.col("at") - 1).alias("at"), F.col("first").alias("after")), "at", "left")
            .select("shard", "before", "after"))


def _member_hash(pieces: DataFrame) -> DataFrame:
    """``key, ends_sha256``: SHA-256 over the pieces of a shared node's member list.

    A digest needs its bytes in order, so they stream through one task per node, as
    pieces of ids joined beforehand; only the running digest is held.
    """
    def run(batches):
        key, h = None, None
        for batch in batches:
            done = ([], [])
            for k, piece in zip(batch["key"].to_pylist(), batch["ends"].to_pylist()):
                if k != key:
                    if h is not None:
                        done[0].append(key)
                        done[1].append(h.hexdigest())
                    key, h = k, hashlib.sha256(piece.encode())
                else:
                    h.update(b"," + piece.encode())
            yield pa.record_batch([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], ["key", "ends_sha256"])
        if h is not None:
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], ["key", "ends_sha256"])

    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.select("key", "shard", "piece", "ends").repartition(n, "key").sortWithinPartitions("key", "shard", "piece")
    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``seqs(conv_id, turns)``, one row per conversation.

    ``conv_id`` (smallest member), ``depth``, ``turn_key`` (digest of the last turn),
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256`` (members that end here).  Conversations without turns are members
    of the root; no conversations give no rows.  A shard holds 16 bytes per turn of its
    sequences, and the longest one is a single row.
    """
    shards = _shards(seqs)
    parts = written(shards.groupBy("shard").cogroup(_neighbours(shards).groupBy("shard"))
                    .applyInArrow(shard_nodes, _NODES), "trie-nodes")
    shared = parts.where("key is not null")
    spine = shared.groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.min("turn_key").alias("turn_key"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    ended = _member_hash(shared.where("ends is not null"))
    spine = written(spine.join(ended, "key", "left").fillna(NO_MEMBERS, ["ends_sha256"]), "trie-spines")

    cols = ["conv_id", "depth", "turn_key", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            "ends_sha256"]
    nodes = parts.where("key is null").select("parent_key", *cols).unionByName(spine.select("parent_key", *cols))
    below = join_small(nodes.where("parent_key is not null").drop("parent_conv_id"),
                       spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")),
                       ["parent_key"])
    return nodes.where("parent_key is null").select(*cols).unionByName(below.select(*cols))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """Prefix trie of the conversations in ``turns(conv_id, turn, role, text)``; further columns are ignored."""
    return prefix_trie(turn_sequences(turns))
