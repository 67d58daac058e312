"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts up to three bytes long with frozen
counts.  A byte seen ``c`` times in a context of ``n`` bytes and ``t`` distinct
successors costs ``-log2(c / (n + t))`` bits; a byte never seen there costs the
escape ``-log2(t / (n + t))`` plus its cost in the next shorter context, down to
eight bits.  The language whose tree codes the whole text in the fewest bits is
predicted.

The counts come from a bounded number of labelled documents per language; the
chained costs are laid out in tables once, so that scoring a text is a lookup
and a sum per byte in vector operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PER_LANGUAGE = 3_000
UNDETERMINED = "und"
_KEEP = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_BLOCK = 1 << 18


def folded(text: str | None) -> bytes:
    """Lower-cased UTF-8 with all ASCII but letters turned into spaces, after a three-byte start context."""
    return b"   " + (text or "").lower().encode().translate(_KEEP)


def grams(data: bytes) -> np.ndarray:
    """Code of (three context bytes, byte) for every byte after the first three."""
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    return a[:-3] << 24 | a[1:-2] << 16 | a[2:-1] << 8 | a[3:]


class Slots:
    """Vectorised lookup of uint32 codes (open addressing); -1 for unknown codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.bits = max(4, (4 * max(len(codes), 1) - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint32)
        self.vals = np.full(1 << self.bits, -1, np.int32)
        todo, at = np.arange(len(codes), dtype=np.int32), self._home(codes)
        while len(todo):
            free = np.flatnonzero(self.vals[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.vals[at[put]] = codes[todo[put]], todo[put]
            left = np.ones(len(todo), bool)
            left[put] = False
            todo, at = todo[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _home(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        at = self._home(codes)
        out = self.vals[at]
        wrong = np.flatnonzero((out >= 0) & (self.keys[at] != codes))
        while len(wrong):
            at = (at[wrong] if len(at) != len(wrong) else at) + 1 & ((1 << self.bits) - 1)
            sub = codes[wrong]
            got = self.vals[at]
            out[wrong] = got
            bad = (got >= 0) & (self.keys[at] != sub)
            at, wrong = at[bad], wrong[bad]
        return out


@dataclass
class Trees:
    """Frozen chained code lengths of all languages (columns in order of ``languages``)."""

    languages: list[str]
    order1: np.ndarray            # [65536, L] cost of (1 context byte, byte)
    escape2: np.ndarray           # [65536, L] escape cost of a two-byte context
    find2: Slots
    order2: np.ndarray
    find_context: Slots
    escape3: np.ndarray
    find3: Slots
    order3: np.ndarray

    def bits(self, data: bytes) -> np.ndarray:
        """Exact code length of the folded text under every language."""
        total = np.zeros(len(self.languages))
        for lo in range(3, len(data), _BLOCK):
            code = grams(data[lo - 3:lo + _BLOCK])
            at = self.find3.find(code)
            known = at >= 0
            total += self.order3[at[known]].sum(axis=0, dtype=np.float64)
            if not known.all():
                total += self._short(code[~known]).sum(axis=0, dtype=np.float64)
        return total

    def _short(self, code: np.ndarray) -> np.ndarray:
        """Cost of bytes that no language has seen after their three-byte context."""
        context = self.find_context.find(code >> np.uint32(8))
        out = np.where((context >= 0)[:, None], self.escape3[context], 0.0)
        tri = code & np.uint32(0xFFFFFF)
        at = self.find2.find(tri)
        lower = self.escape2[tri >> np.uint32(8)] + self.order1[tri & np.uint32(0xFFFF)]
        return out + np.where((at >= 0)[:, None], self.order2[at], lower)


def build_trees(codes: np.ndarray, lang: np.ndarray, count: np.ndarray, languages: list[str]) -> Trees:
    """Chained cost tables from counts of (gram code, language)."""
    n_lang = len(languages)

    def level(order: int):
        """Codes of a context order, their counts per language, and the context's totals."""
        sub = codes & np.uint32((1 << 8 * (order + 1)) - 1) if order < 3 else codes
        uniq, inv = np.unique(sub, return_inverse=True)
        c = np.zeros((len(uniq), n_lang))
        np.add.at(c, (inv, lang), count)
        ctx, cinv = np.unique(uniq >> np.uint32(8), return_inverse=True)
        n, t = np.zeros((len(ctx), n_lang)), np.zeros((len(ctx), n_lang))
        np.add.at(n, cinv, c)
        np.add.at(t, cinv, c > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            esc = np.where(n > 0, -np.log2(t / (n + t)), 0.0)
            cost = np.where(c > 0, -np.log2(c / (n + t)[cinv]), np.inf)
        return uniq, cost, ctx, cinv, esc

    def dense(size: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((size, n_lang))
        out[at] = rows
        return out

    u0, c0, _, _, e0 = level(0)
    base = np.repeat((e0[0] if len(e0) else np.zeros(n_lang))[None, :] + 8.0, 256, axis=0)
    base[u0] = np.where(np.isfinite(c0), c0, base[u0])
    u1, c1, x1, _, e1 = level(1)
    order1 = dense(256, x1, e1)[np.arange(65536) >> 8] + base[np.arange(65536) & 255]
    order1[u1] = np.where(np.isfinite(c1), c1, order1[u1])
    u2, c2, x2, i2, e2 = level(2)
    escape2 = dense(65536, x2, e2)
    order2 = np.where(np.isfinite(c2), c2, e2[i2] + order1[u2 & np.uint32(0xFFFF)])
    u3, c3, x3, i3, e3 = level(3)
    find2 = Slots(u2)
    order3 = np.where(np.isfinite(c3), c3, e3[i3] + order2[find2.find(u3 & np.uint32(0xFFFFFF))])
    f32 = np.float32
    return Trees(languages, order1.astype(f32), escape2.astype(f32), find2, order2.astype(f32),
                 Slots(x3), e3.astype(f32), Slots(u3), order3.astype(f32))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: CRC-32 of the id modulo 3 is 1 (null ids too)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def fit_trees(docs: DataFrame, max_per_language: int = MAX_PER_LANGUAGE) -> Trees | None:
    """Trees from about ``max_per_language`` hashed documents of every language (all, if fewer).

    Only text and non-null ``lang`` of documents outside the held-out fold are
    used.  None without any labelled text.
    """
    base = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in base.groupBy("lang").agg(F.count("*").alias("n")).collect()}   # one row per language
    languages = sorted(sizes)
    if not languages:
        return None
    number = {name: i for i, name in enumerate(languages)}
    unit = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / float(1 << 53)
    share = F.element_at(F.create_map(*[x for n in languages for x in (F.lit(n), F.lit(max_per_language / sizes[n]))]), F.col("lang"))

    def count(batches):
        for b in batches:
            parts: dict[int, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                data = folded(text.as_py())
                if len(data) > 3:
                    parts.setdefault(number[lang], []).append(grams(data))
            for lang, codes in parts.items():
                u, n = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array(np.full(len(u), lang, np.int32)),
                                                  "gram": pa.array(u.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    counts = (base.where(unit < share).select("lang", "text").mapInArrow(count, "lang int, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").cast("int").alias("n")).toArrow())
    if not counts.num_rows:
        return None
    return build_trees(counts["gram"].to_numpy().astype(np.uint32), counts["lang"].to_numpy(),
                       counts["n"].to_numpy(), languages)


def predict(text: str | None, trees: Trees | None) -> tuple[str, float]:
    """(language, posterior of equal priors); ``und`` and 0 without a letter or a model."""
    if trees is None or not text or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0
    bits = trees.bits(folded(text))
    best = int(np.argmin(bits))
    return trees.languages[best], float(1 / np.exp2(np.clip(bits[best] - bits, -60, 0)).sum())


def identify_languages(docs: DataFrame, max_per_language: int = MAX_PER_LANGUAGE) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    * null texts and texts without a letter are ``und`` with score 0, and so is
      every text if nothing can be learned;
    * equal code lengths go to the first language by name;
    * repeated rows and null ids stay; an empty table gives an empty result;
      further columns are ignored.
    """
    trees = fit_trees(docs, max_per_language)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def identify(texts: pa.Array) -> pa.Array:
        got = [predict(t.as_py(), shared.value) for t in texts]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                          names=["lang_pred", "score"])

    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(F.col("text")).alias("p"))
            .select("doc_id", "held_out", "p.*"))
