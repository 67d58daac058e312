"""SimHash near-duplicate groups through a byte-position inverted index.

A fingerprint has eight positional bytes.  Two fingerprints that differ in at
most ``d`` bits differ in at most ``d`` bytes, so they share at least ``8 - d``
positional bytes: the guaranteed minimum.  The index posts every distinct
fingerprint under all combinations of ``4 - d`` of its four byte couples; a
pair above the minimum meets under one of them.  For each pair that meets, the
shared positional bytes are tallied, pairs below the minimum go, and the rest
is verified by the exact bit distance.

A posting list longer than ``pair_block`` (a large group of near copies) is not
paired.  Its fingerprints are linked exactly and in linear space through
their one-bit neighbours: two fingerprints are within two bits of each other
if and only if their one-bit neighbourhoods meet.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import boxed, connected_components, cut, join_small, text_key, written

SEED = 42
_CHUNK = 16384


def simhash(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one text (null or without words: 0)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    grams = zip(*(itertools.islice(words, i, None) for i in range(k)))
    ones, n = np.zeros(64, np.int64), 0
    while part := [xxhash.xxh64_digest(b" ".join(g), SEED) for g in itertools.islice(grams, _CHUNK)]:
        bits = np.unpackbits(np.frombuffer(b"".join(part), np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def simhash_column(text: Column, shingle: int = 3) -> Column:
    """Arrow-batched fingerprint column (bigint)."""

    @F.arrow_udf("bigint")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t.as_py(), shingle) for t in texts], pa.int64())

    return fingerprint(text.cast("binary"))


def shared_bytes(a: Column, b: Column) -> Column:
    """Tally of positional bytes that two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum((F.shiftrightunsigned(x, 8 * p).bitwiseAND(F.lit(255)) == 0).cast("int") for p in range(8))


def _postings(fps: DataFrame, max_bits: int) -> DataFrame:
    couple = [F.shiftrightunsigned("fp", 16 * c).bitwiseAND(F.lit(0xFFFF)) for c in range(4)]
    keys = [F.struct(F.lit(i).alias("list"),
                     sum((F.shiftleft(couple[c], 16 * j) for j, c in enumerate(chosen)), F.lit(0).cast("bigint")).alias("key"))
            for i, chosen in enumerate(itertools.combinations(range(4), 4 - max_bits))]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.list", "k.key")


def fingerprint_links(fps: DataFrame, max_bits: int = 2, pair_block: int = 32) -> DataFrame:
    """Edges ``(src, dst)`` that connect exactly the distinct fingerprints within ``max_bits``.

    ``fps`` has distinct values in ``fp``.  Pairs come from posting lists of
    up to ``pair_block`` fingerprints; longer lists are linked through one-bit
    neighbours, which gives hub edges with the same components.
    """
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2")
    posts = _postings(fps, max_bits)
    lists = posts.groupBy("list", "key").agg(F.count("*").alias("size")).where("size > 1")
    posts = written(posts.join(lists, ["list", "key"]), "simhash-postings")

    short = posts.where(F.col("size") <= pair_block)
    pairs = (short.alias("a").join(short.alias("b"), ["list", "key"])
             .where("a.fp < b.fp").select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))
             .where(shared_bytes(F.col("src"), F.col("dst")) >= 8 - max_bits)
             .where(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits))

    dense = posts.where(F.col("size") > pair_block).select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)),
                        lambda b: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)))
    near = dense.select("fp", F.explode(flips).alias("spot"))
    if max_bits == 2:
        # at most 65 distinct fingerprints lie around one spot: a bounded window
        hub = F.min("fp").over(Window.partitionBy("spot"))
        linear = (near.unionByName(dense.select("fp", F.col("fp").alias("spot")))
                  .select("fp", hub.alias("dst")).where("fp != dst").select(F.col("fp").alias("src"), "dst"))
    else:
        linear = (near.join(dense.select(F.col("fp").alias("spot")), "spot")
                  .where("spot < fp").select(F.col("fp").alias("src"), F.col("spot").alias("dst")))
    return pairs.unionByName(linear).distinct()


def fingerprint_groups(prints: DataFrame, max_bits: int = 2, pair_block: int = 32) -> DataFrame:
    """(fp, group) for every distinct fingerprint; group = smallest linked fingerprint."""
    fps = prints.select("fp").distinct()
    comps = connected_components(fingerprint_links(fps, max_bits, pair_block))
    return (fps.join(comps.withColumnRenamed("id", "fp"), "fp", "left")
            .select("fp", F.coalesce("component", "fp").alias("group")))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    * null and word-free texts have fingerprint zero and link like any other;
    * a text with fewer words than ``shingle`` is one shingle;
    * repeated rows stay repeated; null ``doc_id`` rows take part, and a group
      without any doc_id has a null ``component_id``;
    * an empty table gives an empty result; further columns are ignored.
    """
    prints = written(docs.select("doc_id", simhash_column(F.col("text"), shingle).alias("fp")), "simhash-prints")
    groups = cut(fingerprint_groups(prints, max_bits))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("m"))
    least = groups.join(first, "fp").groupBy("group").agg(F.min("m").alias("component_id"))
    by_fp = written(groups.join(least, "group").select("fp", "component_id"), "simhash-groups")
    return join_small(prints, by_fp, ["fp"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Keep one document of each group: the smallest ``doc_id`` (null last, then text key).

    Rows equal in doc_id and text count as copies of each other; one stays.
    All columns of ``docs`` are returned unchanged.
    """
    key = text_key(F.col("text"))
    prints = written(docs.select("doc_id", key.alias("key"), simhash_column(F.col("text"), shingle).alias("fp")),
                     "dedup-prints")
    groups = cut(fingerprint_groups(prints, max_bits))
    # the smallest document of a fingerprint before the join, so that no fingerprint is hot in it
    first = (prints.groupBy("fp", "doc_id", "key").agg(F.count("*").alias("n"))
             .groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "n")).alias("k")))
    best = first.join(groups, "fp").groupBy("group").agg(F.min("k").alias("k"))
    keep = best.select("k.doc_id", "k.key", "k.n").alias("keep")
    rows = docs.select(boxed(docs)).alias("docs")
    same = text_key(F.col("docs.row.text")).eqNullSafe(F.col("keep.key")) & F.col("docs.row.doc_id").eqNullSafe(F.col("keep.doc_id"))
    kept = rows.join(keep, same).select("row", "keep.doc_id", "keep.key", "keep.n")
    once = kept.where("n = 1").select("row.*")
    again = kept.where("n > 1").dropDuplicates(["doc_id", "key"]).select("row.*")
    return once.unionByName(again)
