"""MinHash near-duplicates through an LSH forest.

Texts with one shingle set are one class.  Every tree of the forest is a sorted
order of the classes' signatures, eight hashes deep; range partitions hold it.

* Neighbours in an order share the longest prefix.  Those that share six or
  more hashes in the first orders are verified at once: this joins large groups
  of near copies with a few links per member instead of all pairs.
* What is left is compared by region, a run of one prefix.  Depth adapts to the
  region: three hashes where at most 32 classes share them, four where more do.
  Only pairs of different components are compared, so the largest component of
  a region never meets itself; a region is worked in blocks of some 256 rows.
* Pairs that agree in too few of the 192 hashes go; the rest is verified on the
  full shingle sets, block by block.  No row is made per pair: blocks pass on the
  rows that have something to be compared with, then only links.

With 24 orders two sets at the threshold of 0.8 meet in no region with a
probability of 3e-6 (four hashes) or 4e-8 (three), and fall below the agreement
needed with one of about 3e-7.  There is no cap on partners or candidates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custvalue.llm.common import connected_components, join_small, text_key, written

TREES, DEPTH = 24, 8
SHALLOW, DEEP, CROWD = 3, 4, 32       # depth of thin and of crowded regions; classes of a thin one
EARLY_TREES, EARLY_DEPTH = 4, 6       # neighbours verified at once
AGREE = 126                           # of 192 hashes: five deviations below 0.8
BLOCK_ROWS = 256
SHARD_ROWS = 500_000                  # rows of one range partition, about
_CHUNK = 2048

_MULTIPLIERS = np.random.default_rng(20_240_613).integers(0, 2 ** 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- one text

def shingle_set(text: bytes | None, size: int = 2) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct word shingles.

    A text of fewer words is one shingle, one without words has none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):                                    # order of the words counts
        out = (out ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash signature: 16 bits for each of the forest's 192 hash functions."""
    low = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        low = np.minimum(low, (hashes[None, at:at + _CHUNK] * _MULTIPLIERS[:, None]).min(axis=1))
    return ((low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(">u2")


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``percent`` / 100."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def set_column(text: Column, size: int) -> Column:
    """Arrow-batched shingle set (its 64-bit hashes as bytes)."""

    @F.arrow_udf("binary")
    def shingles(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t.as_py(), size).tobytes() for t in texts], pa.binary())

    return shingles(text.cast("binary"))


def _prints(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_key, n, class, signature``; class and signature are null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, sig = [], [], []
            for t in batch["text"]:
                s = shingle_set(t.as_py(), size)
                n.append(len(s))
                key.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.record_batch([batch["doc_id"], batch["text_key"], pa.array(n, pa.int64()),
                                   pa.array(key, pa.binary()), pa.array(sig, pa.binary())],
                                  ["doc_id", "text_key", "n", "class", "signature"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
                       F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text_key string, n bigint, class binary, signature binary")


# ------------------------------------------------------------------ forest

def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition that share ``SHALLOW`` hashes with a neighbour, with the one
    before them.  The first and last row stay too: their neighbours may lie next door."""
    held = None                                           # last row seen: (tree, band, class, lcp)
    held_class = None                                     # class of the row before it
    start = True

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 5
        return pa.record_batch([pa.array(c, k) for c, k in zip(
            cols, (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32()))],
            ["tree", "band", "class", "before", "lcp"])

    for batch in batches:
        if not batch.num_rows:
            continue
        tree, band, cls = (batch[c].to_pylist() for c in ("tree", "band", "class"))
        offset = 0
        if held is not None:
            tree, band, cls, offset = [held[0], *tree], [held[1], *band], [held[2], *cls], 1
        levels = np.frombuffer(b"".join(band), np.uint16).reshape(-1, DEPTH)
        order = np.array(tree)
        same = (levels[1:] == levels[:-1]) & (order[1:] == order[:-1])[:, None]
        lcp = np.concatenate([[held[3] if held is not None else 0], np.cumprod(same, axis=1).sum(axis=1)]).astype(int)
        keep = lcp >= SHALLOW
        keep[:-1] |= lcp[1:] >= SHALLOW
        if start:
            keep[0], start = True, False
        last = len(tree) - 1
        rows = [(tree[i], band[i], cls[i],
                 ((held_class if offset and i == 0 else cls[i - 1]) if lcp[i] >= SHALLOW else None), int(lcp[i]))
                for i in np.flatnonzero(keep[:last])]
        held_class = cls[last - 1] if last else None
        held = (tree[last], band[last], cls[last], int(lcp[last]))
        yield out(rows)
    if held is not None:
        yield out([(held[0], held[1], held[2], held_class if held[3] >= SHALLOW else None, held[3])])


def _forest(classes: DataFrame) -> DataFrame:
    """Rows of all sorted orders that have a neighbour: ``tree, band, class, before, lcp``."""
    width = 2 * DEPTH
    bands = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)),
                        lambda t: F.struct(t.alias("tree"), F.substring(F.col("signature"), t * width + 1, F.lit(width)).alias("band")))
    rows = classes.select("class", F.explode(bands).alias("b")).select("b.tree", "b.band", "class")
    n = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            -(-classes.count() * TREES // SHARD_ROWS))
    orders = rows.repartitionByRange(n, "tree", "band", "class").sortWithinPartitions("tree", "band", "class")
    return orders.mapInArrow(_met, "tree int, band binary, class binary, before binary, lcp int")


def _blocks(rows: DataFrame) -> DataFrame:
    """Regions in blocks: every pair of blocks but those of the region's largest component.

    ``rows(tree, region, class, comp, size, main, in_main)``; a row is repeated for every pair
    of blocks that it belongs to.
    """
    n_main = F.ceil(F.col("in_main") / BLOCK_ROWS)
    n_rest = F.ceil((F.col("size") - F.col("in_main")) / BLOCK_ROWS)
    is_main = F.col("comp") == F.col("main")
    own = F.pmod(F.xxhash64("class"), F.when(is_main, n_main).otherwise(n_rest))
    span = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    spots = F.when(is_main, F.transform(span(n_rest), lambda i: F.struct(i.alias("a"), (-F.col("own") - 1).alias("b")))) \
        .otherwise(F.concat(
            F.transform(span(n_rest), lambda i: F.struct(F.least(i, F.col("own")).alias("a"), F.greatest(i, F.col("own")).alias("b"))),
            F.transform(span(n_main), lambda i: F.struct(F.col("own").alias("a"), (-i - 1).alias("b")))))
    return (rows.withColumn("own", own).withColumn("s", F.explode(spots))
            .select("tree", "region", F.col("s.a").alias("a"), F.col("s.b").alias("b"),
                    F.when(is_main, -F.col("own") - 1).otherwise(F.col("own")).alias("own"), "class", "comp"))


_BLOCK = "tree int, region binary, a bigint, b bigint, own bigint, class binary, comp binary, n bigint, signature binary"


def _candidates(rows: list[tuple], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """A row of a block pair with the later rows that it has to be compared with: of another component,
    of a size that allows the similarity, with a signature that agrees, and in no earlier order's region."""
    tree, _, a, b = rows[0][:4]
    own, n = np.array([r[4] for r in rows]), np.array([r[7] for r in rows])
    names: dict[bytes, int] = {}
    comp = np.array([names.setdefault(r[6], len(names)) for r in rows])
    sig = np.frombuffer(b"".join(r[8] for r in rows), np.uint16).reshape(len(rows), TREES, DEPTH)
    for i in range(len(rows)):
        j = np.arange(i + 1, len(rows)) if a == b else np.flatnonzero(own == b) if own[i] == a else np.empty(0, int)
        j = j[(comp[j] != comp[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
        j = j[(sig[j] == sig[i]).sum(axis=(1, 2)) >= AGREE]
        met = (sig[j, :tree, :DEEP] == sig[i, :tree, :DEEP]).all(axis=2).any(axis=1)
        if not met.all():
            yield i, j[~met]


def _compared(rows: list[tuple], percent: int) -> list[tuple]:
    """Rows of a block pair that have something to be compared with."""
    use: set[int] = set()
    for i, j in _candidates(rows, percent):
        use.add(i)
        use.update(j.tolist())
    return [rows[i] for i in sorted(use)]


def _linked(rows: list[tuple], percent: int) -> list[tuple]:
    """Verified links of a block pair: for a row and another component the first link."""
    sets = [np.frombuffer(r[9], np.uint64) for r in rows]
    out = []
    for i, j in _candidates(rows, percent):
        x, others = sets[i], [sets[k] for k in j]
        flat = np.concatenate(others)
        at = np.minimum(np.searchsorted(x, flat), len(x) - 1)
        size = np.array([len(o) for o in others])
        both = np.add.reduceat((x[at] == flat).astype(np.int64), np.cumsum(size) - size)
        first = {}
        for k in j[100 * both >= percent * (len(x) + size - both)].tolist():
            first.setdefault(rows[k][6], rows[k][5])
        out += [(rows[i][5], y) for y in first.values()]
    return out


def _by_block(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on the rows of every pair of blocks; at most two blocks are held at a time."""
    keys = ["tree", "region", "a", "b"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found)) or [()] * len(fields)
            return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], [f for f, _ in fields])

        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:4] != row[:4]:
                    found += work(held)
                    held = []
                held.append(row)
            yield out(found)
        if held:
            yield out(work(held))

    return rows.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _region_links(forest: DataFrame, comps: DataFrame, classes: DataFrame, docs: DataFrame, size: int,
                  percent: int) -> DataFrame:
    """Links between different components that share a region, at the depth of that region."""
    prefix = lambda d: F.substring("band", 1, 2 * d)
    rows = forest.select("tree", "band", "class").join(comps, "class", "left") \
        .withColumn("comp", F.coalesce("comp", "class")).withColumn("top", prefix(SHALLOW))
    rows = written(rows, "forest-rows")
    crowded = rows.groupBy("tree", "top").agg(F.count("*").alias("k")).where(F.col("k") > CROWD)
    rows = join_small(rows, crowded, ["tree", "top"], "left") \
        .withColumn("region", F.when(F.col("k").isNull(), F.col("top")).otherwise(prefix(DEEP)))
    parts = rows.groupBy("tree", "region", "comp").agg(F.count("*").alias("k"))
    regions = (parts.groupBy("tree", "region")
               .agg(F.sum("k").alias("size"), F.max(F.struct("k", "comp")).alias("m"), F.count("*").alias("comps"))
               .where("comps > 1")
               .select("tree", "region", "size", F.col("m.comp").alias("main"), F.col("m.k").alias("in_main")))
    mixed = join_small(rows.select("tree", "region", "class", "comp"), written(regions, "forest-regions"), ["tree", "region"])
    blocks = _blocks(mixed).join(classes.select("class", "n", "signature"), "class").select(
        "tree", "region", "a", "b", "own", "class", "comp", "n", "signature")
    rows = written(_by_block(blocks, lambda r: _compared(r, percent), _BLOCK), "forest-compared")
    sets = _sets(rows.select("class").distinct(), docs, classes, size)
    return _by_block(rows.join(sets, "class").select(*blocks.columns, "set"), lambda r: _linked(r, percent),
                     "src binary, dst binary")


# ------------------------------------------------------------ verification

def _sets(needed: DataFrame, docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``class, set``: the full shingle sets of the classes in ``needed``."""
    wanted = written(needed.join(classes, "class").select("class", "text_key"), "forest-wanted")
    texts = docs.select(text_key(F.col("text")).alias("text_key"), F.col("text").alias("text"))
    texts = join_small(texts, wanted, ["text_key"]).groupBy("class").agg(F.any_value("text").alias("text"))
    return written(texts.select("class", set_column(F.col("text"), size).alias("set")), "forest-sets")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are alike."""
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("class")).distinct()
    sets = _sets(ends, docs, classes, size)

    @F.arrow_udf("boolean")
    def same(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([alike(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                         for x, y in zip(a, b)], pa.bool_())

    held = (pairs.join(sets.select(F.col("class").alias("src"), F.col("set").alias("a")), "src")
            .join(sets.select(F.col("class").alias("dst"), F.col("set").alias("b")), "dst"))
    return written(held.where(same("a", "b")).select("src", "dst"), "forest-links")


def minhash_components(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents whose sets of ``size``-word shingles have a Jaccard similarity of at least
    ``percent`` / 100 are linked; ``component_id`` is the smallest doc_id reachable.

    * null, empty and word-free texts have an empty set and are linked with nothing, not
      even each other; a text with fewer words than ``size`` is one shingle;
    * repeated rows stay repeated; rows without doc_id take part, but a group without any
      doc_id has a null ``component_id``, and they are never ``kept``;
    * an empty table gives an empty result; further columns are ignored.
    """
    prints = written(_prints(docs, size), "forest-prints")
    classes = written(prints.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("first"), F.min("text_key").alias("text_key"), F.min("n").alias("n"),
        F.min("signature").alias("signature"), F.count("*").alias("copies")), "forest-classes")
    forest = written(_forest(classes), "forest")

    early = (forest.where((F.col("tree") < EARLY_TREES) & (F.col("lcp") >= EARLY_DEPTH))
             .select(F.least("before", "class").alias("src"), F.greatest("before", "class").alias("dst")).distinct())
    links = _verified(written(early, "forest-early"), docs, classes, size, percent)
    comps = connected_components(links).select(F.col("id").alias("class"), F.col("component").alias("comp"))

    ends = _region_links(forest, comps, classes, docs, size, percent)
    for end in ("src", "dst"):
        ends = (ends.join(comps.select(F.col("class").alias(end), F.col("comp").alias("c")), end, "left")
                .withColumn(end, F.coalesce("c", end)).drop("c"))
    merged = connected_components(ends).select(F.col("id").alias("comp"), F.col("component").alias("whole"))
    early_comp = classes.select("class", "first", "copies").join(comps, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    members = written(join_small(early_comp, merged, ["comp"], "left").select(
        "class", F.coalesce("whole", "comp").alias("comp"), "first", "copies"), "forest-members")

    least = (members.groupBy("comp").agg(F.min("first").alias("component_id"), F.count("*").alias("k"),
                                         F.max("copies").alias("most")).where("k > 1 or most > 1"))
    groups = join_small(members, written(least.select("comp", "component_id"), "forest-least"), ["comp"]).select(
        "class", "component_id")
    out = join_small(prints.select("doc_id", "n", "class"), written(groups.withColumn("grouped", F.lit(True)), "forest-groups"),
                     ["class"], "left")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
