"""Merkle manifest against a straightforward tree in Python."""
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from custvalue.llm.merkle import (array_paths, fold, merkle_manifest, reduce_levels, verified_manifest)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r):
    doc_id, text, lang, source, n = r
    return sha(field(doc_id) + field(source) + field(lang) + field(n) + field(text))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[i:i + 2])) for i in range(0, len(row), 2)])
    return levels


def siblings(levels, i):
    for row in levels[:-1]:
        yield i & 1, row[i ^ 1] if (i ^ 1) < len(row) else None
        i >>= 1


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        groups[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {x: tree([leaf(r) for r in groups[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for place, x in enumerate(langs):
        for i, r in enumerate(groups[x]):
            steps = list(siblings(trees[x], i)) + list(siblings(top, place))
            false = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                false[4] += 1
            h = leaf(false)
            for odd, s in steps:
                h = sha(h if s is None else (s + h if odd else h + s))
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], sha("".join(s or "" for _, s in steps)),
                        h, h == top[-1][0]))
    return out


def order(r):
    return tuple((x is not None, x or 0) for x in r)


def check(docs):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = [tuple(r) for r in verified_manifest(docs, chosen, F.col("n_chars") + 1).collect()]
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted(got, key=order) == sorted(brute(rows), key=order)
    return got


def test_documents(documents):
    got = check(documents)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_odd_rows(odd):
    check(odd)


def test_empty(empty):
    assert check(empty) == []


def test_ties_and_extreme_ids(spark):
    rows = [(5, "a", "en", "s", 1), (5, "a", "en", "s", 1), (5, "b", "en", "s", 1), (None, "x", None, "s", 2),
            (None, "y", None, "s", 3), (None, "y", None, "s", 3), (-(2 ** 63), "n", "en", None, 2),
            (2 ** 63 - 1, "n", "en", None, 2), (-3, "", "en", None, 0), (7, "z", "é", "s", None), (8, "z", "", "s", 1)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_several_slot_arrays_and_one_id_for_a_third(spark):
    rows = [(i * 7919 % 100_003 if i % 3 else 42, f"text {i}", "en" if i % 5 else f"l{i % 50}", "s", i)
            for i in range(9_000)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_slots_are_gapless(documents):
    m = merkle_manifest(documents).groupBy("tree").agg(
        F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("n")).collect()
    assert all(r.a == 0 and r.b == r.n - 1 for r in m)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 31])
def test_slot_arrays_of_eight_equal_the_whole_tree(n):
    hashes = [sha(str(i)).encode() for i in range(n)]
    whole = reduce_levels(hashes, n, 40)
    arrays = [reduce_levels(hashes[i:i + 8], n, 3) for i in range(0, n, 8)]
    if n > 8:
        tops = [a[-1][0] for a in arrays]
        above = array_paths(reduce_levels(tops, len(tops), 40), b"")
        root = reduce_levels(tops, len(tops), 40)[-1][0]
    else:
        above, root = [b""], arrays[0][-1][0]
    assert root == whole[-1][0]
    paths = [p for a, up in zip(arrays, above) for p in array_paths(a, up)]
    assert paths == array_paths(whole, b"")
    assert all(fold(h, p) == root for h, p in zip(hashes, paths))
