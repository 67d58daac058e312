"""Benchmark decontamination: a prefix-filtered set join on word shingles.

A window is ``window`` consecutive words of a benchmark item (a shorter item is
one window).  All shingles of a window must occur where the window occurs, so
any single one of them is a necessary prefix; the rarest in the corpus is the
cheapest.  The steps:

1. one pass over the whole texts counts words and keeps, per document, only the
   runs of words whose shingles are all in a bitmap of benchmark shingles (the
   bitmap has a fixed size; a false hit costs a row, never a result);
2. equal runs are collapsed, so a passage in a third of all documents is joined
   once; shingle frequencies over all documents give the rarity order;
3. each window is joined on its rarest shingle only, placed by the shingle's
   offset, bounded by the run's length and verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import boxed, cut, join_small, text_key, written

WINDOW, SHINGLE, BITMAP_BITS = 10, 5, 26

# Bytes that belong to words: digits, letters (A-Z folded to a-z) and all of non-ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
_BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEEDED = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Hasher:
    """Word positions and shingle hashes of folded bytes, in vector operations."""

    def __init__(self) -> None:
        base = int(_ODD)
        self.up, self.down = _powers(base, _BLOCK + 1), _powers(pow(base, -1, 2**64), _BLOCK + 1)

    def words(self, folded: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, hash) of every word; a word is hashed by its bytes alone."""
        a = np.frombuffer(folded, np.uint8)
        edge = np.flatnonzero(np.diff(a != 32, prepend=False, append=False))
        start, end = edge[::2], edge[1::2]
        out = np.zeros(len(start), np.uint64)
        lo = 0
        while lo < len(start):                                   # blocks of whole words
            hi = max(lo + 1, int(np.searchsorted(end, start[lo] + _BLOCK, "right")))
            s0, e0 = int(start[lo]), int(end[hi - 1])
            if e0 - s0 > _BLOCK:                                 # one giant word
                out[lo] = _giant(a[s0:e0], self)
            else:
                total = np.concatenate(([np.uint64(0)], np.cumsum(_SEEDED[a[s0:e0]] * self.up[:e0 - s0], dtype=np.uint64)))
                s, e = start[lo:hi] - s0, end[lo:hi] - s0
                h = (total[e] - total[s]) * self.down[s]
                out[lo:hi] = (h ^ (h >> np.uint64(29))) * _ODD
            lo = hi
        return start, end, out

    @staticmethod
    def shingles(words: np.ndarray, size: int) -> np.ndarray:
        n = len(words) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = words[:n].copy()
        for j in range(1, size):
            h = (h ^ (h >> np.uint64(31))) * _ODD + words[j:j + n]
        h = (h ^ (h >> np.uint64(32))) * _ODD
        return h ^ (h >> np.uint64(28))


def _giant(a: np.ndarray, hasher: _Hasher) -> np.uint64:
    h = np.uint64(len(a))
    with np.errstate(over="ignore"):
        for i in range(0, len(a), _BLOCK):
            part = a[i:i + _BLOCK]
            h = (h ^ (h >> np.uint64(29))) * _ODD + (_SEEDED[part] * hasher.up[:len(part)]).sum(dtype=np.uint64)
    return h


def _fold(text: bytes | None) -> bytes:
    return (text or b"").translate(_FOLD)


def _item_words(text: Column) -> Column:
    @F.arrow_udf("array<string>")
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([[w.decode() for w in _fold(t.as_py()).split()] for t in texts], pa.list_(pa.string()))

    return words(text.cast("binary"))


def benchmark_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, item) of every window of every item; items without words have none."""
    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                         _item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (items.select("item", "w", F.explode(starts).alias("at"))
            .select("item", F.slice("w", F.col("at"), F.lit(window)).alias("words")).distinct())


def _shingled(df: DataFrame, words: str, size: Column, *keep: str) -> DataFrame:
    """One row per shingle of ``size`` words: (keep..., at, shingle); ``at`` from 0."""
    return (df.where(F.size(words) >= size)
            .select(*keep, F.explode(F.sequence(F.lit(0), F.size(words) - size)).alias("at"), words, size.alias("__z"))
            .select(*keep, "at", F.array_join(F.slice(words, F.col("at") + 1, F.col("__z")), " ").alias("shingle")))


def _bitmap(shingles: DataFrame) -> dict[int, np.ndarray]:
    """Per shingle size a bitmap of hashes; its memory does not depend on the benchmark's size."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for b in batches:
            sizes, slots = [], []
            for z, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = hasher.shingles(hasher.words(t.encode())[2], z)
                sizes.append(z)
                slots.append(int(h[0] >> np.uint64(64 - BITMAP_BITS)))
            yield pa.RecordBatch.from_pydict({"size": pa.array(sizes, pa.int32()), "slot": pa.array(slots, pa.int64())})

    cells = (shingles.select("size", "shingle").distinct().mapInArrow(bits, "size int, slot bigint")
             .groupBy("size", F.shiftright("slot", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow())
    sizes, cell, bits = (cells[c].to_numpy() for c in ("size", "cell", "bits"))   # at most 2^20 rows per shingle size
    out = {}
    for size in np.unique(sizes):
        out[int(size)] = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
        out[int(size)][cell[sizes == size]] = bits[sizes == size].astype(np.int64).view(np.uint64)
    return out


def _runs(text: bytes | None, maps: dict[int, np.ndarray], hasher: _Hasher) -> tuple[int, list[dict]]:
    folded = _fold(text)
    start, end, words = hasher.words(folded)
    cover = np.zeros(len(words) + 1, np.int32)
    for size, bitmap in maps.items():
        slot = hasher.shingles(words, size) >> np.uint64(64 - BITMAP_BITS)
        at = np.flatnonzero(bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1))
        if len(at):
            np.add.at(cover, at, 1)
            np.add.at(cover, at + size, -1)
    edge = np.flatnonzero(np.diff(np.cumsum(cover) > 0, prepend=False))
    least = min(maps, default=1)
    return len(words), [
        {"start": int(i), "run": " ".join(folded[start[k]:end[k]].decode() for k in range(i, j))}
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()) if j - i >= least]


def _scan(docs: DataFrame, maps: dict[int, np.ndarray]) -> DataFrame:
    """(rid, doc_id, key, n_words, runs): the one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(maps)

    @F.arrow_udf("struct<n_words:bigint,runs:array<struct<start:int,run:string>>>")
    def scan(texts: pa.Array) -> pa.Array:
        hasher, out = _Hasher(), []
        for t in texts:
            n, runs = _runs(t.as_py(), shared.value, hasher)
            out.append({"n_words": n, "runs": runs})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct(
            [("start", pa.int32()), ("run", pa.string())])))]))

    return written(docs.select("doc_id", text_key(F.col("text")).alias("key"),
                               scan(F.col("text").cast("binary")).alias("s"))
                   .select(F.monotonically_increasing_id().alias("rid"), "doc_id", "key", "s.n_words", "s.runs"),
                   "decontaminate-scan")


def _occurrences(runs: DataFrame, windows: DataFrame, shingle: int) -> DataFrame:
    """(run, item, at, size): verified windows in the distinct ``runs(run, n)``."""
    sizes = [r["size"] for r in windows.select("size").distinct().orderBy("size").collect()]
    split = runs.select("run", "n", F.split("run", " ").alias("w"))
    tokens = None
    for size in sizes:                                           # at most ``shingle`` sizes
        part = _shingled(split, "w", F.lit(size), "run", "n")
        tokens = part if tokens is None else tokens.unionByName(part)
    if tokens is None:
        tokens = _shingled(split, "w", F.lit(1), "run", "n").limit(0)
    tokens = cut(tokens)
    rarity = tokens.groupBy("shingle").agg(F.sum("n").alias("freq"))
    # a window with a shingle that no document has cannot occur: inner join, all shingles present
    prefix = (_shingled(windows, "words", F.col("size"), "words").join(rarity, "shingle")
              .groupBy("words").agg(F.min(F.struct("freq", "shingle", "at")).alias("p"), F.count("*").alias("found"))
              .where(F.col("found") == F.size("words") - F.least(F.size("words"), F.lit(shingle)) + 1)
              .select("words", F.col("p.shingle").alias("shingle"), F.col("p.at").alias("offset")))
    hits = (tokens.join(prefix, "shingle")
            .select("run", "words", (F.col("at") - F.col("offset")).alias("at"))
            .withColumn("w", F.split("run", " "))
            .where((F.col("at") >= 0) & (F.col("at") + F.size("words") <= F.size("w")))
            .where(F.slice("w", F.col("at") + 1, F.size("words")) == F.col("words")))
    return hits.select("run", "words", "at", F.size("words").alias("size")).distinct()


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, key``.

    * null and empty texts have no words, no hits and the digest of no items;
    * repeated document rows stay repeated; null doc_ids are kept;
    * items with equal ids count once; a null item_id is named by the empty string;
    * an empty benchmark or documents table gives no hits or no rows;
    * further columns are ignored.  ``key`` identifies the text.
    """
    wins = cut(benchmark_windows(bench, window).withColumn("size", F.least(F.size("words"), F.lit(shingle))))
    distinct = wins.select("words", "size").distinct()
    maps = _bitmap(_shingled(distinct, "words", F.col("size"), "size"))
    scan = _scan(docs, maps)
    found = scan.select("rid", F.explode("runs").alias("r")).select("rid", "r.start", "r.run")
    runs = found.groupBy("run").agg(F.count("*").alias("n"))
    hits = cut(_occurrences(runs, distinct, shingle))

    # per distinct run: the union of its windows (running end), and its items
    before = (Window.partitionBy("run").orderBy("at", "end")
              .rowsBetween(Window.unboundedPreceding, -1))
    spans = (hits.select("run", "at", (F.col("at") + F.col("size")).alias("end"))
             .withColumn("past", F.coalesce(F.max("end").over(before), F.lit(0)))
             .groupBy("run").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("at", "past"))).alias("hit")))
    items = hits.join(wins, "words").groupBy("run").agg(F.collect_set("item").alias("items"))
    per_run = spans.join(items, "run")
    # runs of one document are disjoint, so their hits add up
    per_doc = (found.select("rid", "run").join(per_run, "run").groupBy("rid")
               .agg(F.sum("hit").alias("n_hit"),
                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    return (scan.select("rid", "doc_id", "key", "n_words").join(per_doc, "rid", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "key"))


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Documents without any benchmark window, all columns unchanged.

    Null and empty texts have no words and stay; repeated rows stay repeated or go
    together; an empty table, or an empty benchmark, changes nothing.
    """
    bad = cut(contamination(docs, bench, window, shingle).where("contaminated")
              .select("key").distinct())
    rows = docs.select(boxed(docs), text_key(F.col("text")).alias("key"))
    return join_small(rows, bad, ["key"], "left_anti").select("row.*")
