"""Merkle manifest of a document table by bitmap-rank indexing.

Every row is a leaf; leaves of one group (``lang``) ascend by ``doc_id``.  No
step sorts the documents to find a leaf's place:

* the ids of a group are bits: one 64-bit word for 64 ids, merged by
  ``bit_or``.  Words without ids are not there, so sparse ids stay small;
* popcounts of the words are summed up a directory of four levels, 65,536
  entries wide each; running sums never see more than one such stretch;
* the rank of an id (directory entry plus popcount below its bit) is the slot
  of its leaf.  Repeated ids add their surplus to the word.

Levels are reduced in slot arrays of 4,096 nodes, keyed by (group, slot div
4,096): one shuffle per twelve levels.  A second pass, from the root down,
hands every array the path above it, so that each leaf gets its whole proof.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import join_small, written
from custvalue.operators.order import global_positions

LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
ARRAY_BITS = 12                       # nodes of one slot array: 4,096
_NO_ID = -(1 << 58)                   # word of null ids: below the word of every bigint
_HASH = "tree string, n bigint, slot bigint, hash string"
_PATH = "tree string, slot bigint, path string, subroot string, root string"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon and value (integers in decimal)."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(columns: dict[str, Column] | None = None) -> Column:
    """SHA-256 (lowercase hex) of a row's fields; ``columns`` replaces some of them."""
    parts = [field((columns or {}).get(c, F.col(c))) for c in LEAF_COLUMNS]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


# ------------------------------------------------------------------ ranks

def _before(part: list[str], order: str, value: str) -> Column:
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def rank_directory(rows: DataFrame, ident: str, weight: str) -> DataFrame:
    """Bitmap words of ``rows(tree, <ident>, <weight>)`` with the rank at which each word starts.

    Gives ``tree, word, bits, more, base``; ``more`` lists ids of the word that stand
    for several rows.  Null ids come before all others.
    """
    ids = (rows.groupBy("tree", _word(ident).alias("word"), _bit(ident).alias("bit"))
           .agg(F.sum(weight).alias("w")))
    extra = F.when(F.col("w") > 1, F.struct("bit", (F.col("w") - 1).alias("extra")))
    words = written(ids.groupBy("tree", "word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("bits"),
        F.sum("w").alias("n"), F.collect_list(extra).alias("more")), "merkle-words")

    levels = [words.select("tree", F.col("word").alias("at"), "n")]
    for _ in range(3):
        levels.append(levels[-1].groupBy("tree", F.shiftright("at", 16).alias("at")).agg(F.sum("n").alias("n")))
    base = levels[3].select("tree", "at", _before(["tree"], "at", "n").alias("base"))
    for level in levels[2::-1]:
        up = base.select("tree", F.col("at").alias("up"), F.col("base").alias("above"))
        base = (level.withColumn("up", F.shiftright("at", 16))
                .withColumn("here", _before(["tree", "up"], "at", "n"))
                .join(up, ["tree", "up"]).select("tree", "at", (F.col("above") + F.col("here")).alias("base")))
    return (words.join(base.withColumnRenamed("at", "word"), ["tree", "word"])
            .select("tree", "word", "bits", "more", "base"))


def _word(ident: str) -> Column:
    return F.coalesce(F.shiftright(ident, 6), F.lit(_NO_ID).cast("bigint"))


def _bit(ident: str) -> Column:
    return F.coalesce(F.col(ident).bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def ranked(rows: DataFrame, ident: str, weight: str, name: str) -> DataFrame:
    """``rows`` with the number of rows (by weight) of their tree that have a smaller id."""
    below = F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.col("__bit"))))
    surplus = F.aggregate(F.filter("more", lambda x: x["bit"] < F.col("__bit")), F.lit(0).cast("bigint"),
                          lambda s, x: s + x["extra"])
    found = rows.withColumn("word", _word(ident)).withColumn("__bit", _bit(ident))
    return (found.join(rank_directory(rows, ident, weight), ["tree", "word"])
            .withColumn(name, F.col("base") + F.bit_count(below) + surplus)
            .select(*rows.columns, name))


def leaf_slots(leaves: DataFrame) -> DataFrame:
    """Slot of every leaf in its tree; ``leaves(tree, doc_id, leaf, ..., copies)`` has distinct rows.

    Rows of one ``doc_id`` ascend by leaf hash; equal rows take neighbouring slots.
    """
    slots = ranked(leaves, "doc_id", "copies", "slot")
    tied = leaves.groupBy("tree", "doc_id").agg(F.count("*").alias("forms")).where("forms > 1").drop("forms")
    tied = written(tied, "merkle-tied")
    if tied.limit(1).count():
        # one id, several different rows: the same rank among them, on 60 bits of the leaf hash
        among = join_small(leaves, tied, ["tree", "doc_id"]).select(
            F.concat("tree", F.lit("|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias("tree"),
            F.col("tree").alias("__tree"), "doc_id", "leaf", "copies",
            F.conv(F.substring("leaf", 1, 15), 16, 10).cast("bigint").alias("head"))
        among = ranked(among, "head", "copies", "among")
        w = Window.partitionBy("tree", "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
        among = among.select(F.col("__tree").alias("__t"), F.col("doc_id").alias("__d"), F.col("leaf").alias("__l"),
                             (F.col("among") + F.coalesce(F.sum("copies").over(w), F.lit(0))).alias("among"))
        slots = (slots.join(among, (slots["tree"] == among["__t"]) & (slots["leaf"] == among["__l"])
                            & slots["doc_id"].eqNullSafe(among["__d"]), "left")
                 .withColumn("slot", F.col("slot") + F.coalesce("among", F.lit(0))).drop("among", "__t", "__d", "__l"))
    return (slots.withColumn("slot", F.explode(F.sequence("slot", F.col("slot") + F.col("copies") - 1)))
            .drop("copies"))


# ------------------------------------------------------------ slot arrays

def _h(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def reduce_levels(hashes: list[bytes], n: int, bits: int = ARRAY_BITS) -> list[list[bytes]]:
    """The levels above one slot array of a tree of ``n`` nodes, the array itself first.

    An array of a larger tree is raised ``bits`` levels even if it holds one node;
    the only array of a tree is raised until one node is left.
    """
    steps = bits if n > 1 << bits else max(n - 1, 0).bit_length()
    levels = [hashes]
    for _ in range(steps):
        row = levels[-1]
        levels.append([_h(*row[i:i + 2]) for i in range(0, len(row), 2)])
    return levels


def array_paths(levels: list[list[bytes]], above: bytes) -> list[bytes]:
    """Path of every node of a slot array: per level ``L`` or ``R`` and the sibling on that side,
    ``-`` where there is none; then the path above the array."""
    paths = [above]
    for row in reversed(levels[:-1]):
        lower = []
        for i in range(len(row)):
            j = i ^ 1
            step = b"-" if j >= len(row) else (b"L" if j < i else b"R") + row[j]
            lower.append(step + paths[i >> 1])
        paths = lower
    return paths


def fold(leaf: bytes, path: bytes) -> bytes:
    """Root that a leaf and its path lead to."""
    at = 0
    while at < len(path):
        if path[at] == 45:                                  # '-'
            leaf, at = _h(leaf), at + 1
        else:
            other = path[at + 1:at + 65]
            leaf, at = (_h(other, leaf) if path[at] == 76 else _h(leaf, other)), at + 65
    return leaf


def _rows_by_slot(block: pa.Table) -> pa.Table:
    return block.sort_by("slot")


def _raised(nodes: DataFrame) -> DataFrame:
    """One node for each slot array."""
    def one(key: tuple, block: pa.Table) -> pa.Table:
        block = _rows_by_slot(block)
        n = block["n"][0].as_py()
        top = reduce_levels([h.encode() for h in block["hash"].to_pylist()], n)[-1][0]
        return pa.table({"tree": pa.array([key[0].as_py()], pa.string()),
                         "n": pa.array([-(-n >> ARRAY_BITS) if n > 1 << ARRAY_BITS else 1], pa.int64()),
                         "slot": pa.array([key[1].as_py()], pa.int64()),
                         "hash": pa.array([top.decode()], pa.string())})

    return (nodes.select("tree", "n", "slot", "hash", F.shiftright("slot", ARRAY_BITS).alias("array"))
            .groupBy("tree", "array").applyInArrow(one, _HASH))


def _stages(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and what it is raised to, until every tree has one node (the last frame)."""
    out = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        out.append(written(_raised(out[-1]), "merkle-nodes"))
        most = -(-most >> ARRAY_BITS)
        if most <= 1:
            return out


def _with_paths(nodes: DataFrame, above: DataFrame, carried: list[str]) -> DataFrame:
    """Path of every node of ``nodes`` below the paths of its slot arrays."""
    schema = nodes.select(*carried).schema
    for name in ("path", "subroot", "root"):
        schema = schema.add(name, "string")

    def paths(block: pa.Table) -> pa.Table:
        block = _rows_by_slot(block)
        levels = reduce_levels([h.encode() for h in block["hash"].to_pylist()], block["n"][0].as_py())
        out = array_paths(levels, block["above"][0].as_py().encode())
        cols = [block[c] for c in carried] + [pa.array([p.decode() for p in out], pa.string()),
                                              block["subroot"], block["root"]]
        return pa.table(cols, names=schema.names)

    up = above.select("tree", F.col("slot").alias("array"), F.col("path").alias("above"), "subroot", "root")
    held = nodes.withColumn("array", F.shiftright("slot", ARRAY_BITS)).join(up, ["tree", "array"])
    return held.groupBy("tree", "array").applyInArrow(paths, schema)


def _walk_down(stages: list[DataFrame], top: DataFrame, carried: list[str]) -> DataFrame:
    """From the paths of the trees' last nodes down to the paths of their leaves."""
    paths = top
    for nodes in stages[-2:0:-1]:
        paths = _with_paths(nodes, paths, ["tree", "slot"])
    return _with_paths(stages[0], paths, carried)


def merkle_manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, source, lang, n_chars, text)``.

    ``doc_id, tree, slot, leaf, <carried>, path, subroot, root``: the coordinates of the
    leaf (``tree`` names the language), its hash, its path to ``root`` and both roots.
    ``carry`` adds string columns computed from a row of ``docs``.

    * every null field hashes as ``-``; an empty text as ``0:``; null ``lang`` is a
      tree of its own, the first;
    * null ``doc_id`` comes first in its tree; rows of one ``doc_id`` ascend by leaf
      hash, and equal rows are leaves side by side;
    * ``doc_id`` is an integer; further columns are ignored; an empty table gives none.
    """
    carry = carry or {}
    names = [f"carry_{c}" for c in carry]
    leaves = docs.select(field(F.col("lang")).alias("tree"), F.col("lang"), F.col("doc_id").cast("bigint").alias("doc_id"),
                         leaf_hash().alias("leaf"), *[v.cast("string").alias(n) for n, v in zip(names, carry.values())])
    leaves = written(leaves.groupBy(*leaves.columns).agg(F.count("*").alias("copies")), "merkle-leaves")

    trees = leaves.groupBy("tree", "lang").agg(F.sum("copies").alias("n"))
    trees = written(global_positions(trees, [F.col("lang").asc_nulls_first()], "place"), "merkle-trees")
    n_trees = trees.count()
    slots = leaf_slots(leaves.drop("lang"))
    nodes = written(join_small(slots, trees.select("tree", "n"), ["tree"]).withColumnRenamed("leaf", "hash"),
                    "merkle-leaf-nodes")

    forest = _stages(nodes)
    subroots = join_small(forest[-1].select("tree", "hash"), trees.select("tree", "place"), ["tree"])
    tops = subroots.select(F.lit("").alias("tree"), F.lit(n_trees).cast("bigint").alias("n"),
                           F.col("place").cast("bigint").alias("slot"), "hash", F.col("tree").alias("name"))
    tops = written(tops, "merkle-subroots")
    crown = _stages(tops)
    root = crown[-1].select("tree", "slot", F.lit("").alias("path"), F.lit("").alias("subroot"),
                            F.col("hash").alias("root"))
    down = _walk_down(crown, root, ["name", "hash"])
    down = written(down.select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("slot"), "path",
                               F.col("hash").alias("subroot"), "root"), "merkle-paths")
    out = _walk_down(forest, down, ["doc_id", "tree", "slot", "hash", *names])
    return out.select("doc_id", "tree", "slot", F.col("hash").alias("leaf"),
                      *[F.col(n).alias(c) for n, c in zip(names, carry)], "path", "subroot", "root")


def proof_hash(path: Column) -> Column:
    """SHA-256 of the siblings of a path, from the leaf up."""
    return F.sha2(F.regexp_replace(path, "[LR-]", "").cast("binary"), 256)


def fold_column(leaf: Column, path: Column) -> Column:
    """Arrow-batched :func:`fold`."""

    @F.arrow_udf("string")
    def root(leaves: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([fold(a.as_py().encode(), b.as_py().encode()).decode()
                         for a, b in zip(leaves, paths)], pa.string())

    return root(leaf, path)


def verified_manifest(docs: DataFrame, tampered: Column, n_chars: Column) -> DataFrame:
    """Manifest of ``docs`` and the root to which each row leads when rows where ``tampered`` is
    true carry ``n_chars`` instead of their own: ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified``.  A null condition tampers nothing."""
    false_leaf = F.when(tampered, leaf_hash({"n_chars": n_chars}))
    m = merkle_manifest(docs, {"false_leaf": false_leaf})
    folded = m.withColumn("folded_root", fold_column(F.coalesce("false_leaf", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
