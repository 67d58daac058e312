import hashlib
import re

import pytest
from pyspark.sql import functions as F

from custvalue.llm import decontaminate as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def slow(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[i:i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                if (t := tuple(w[i:i + size])) in wins:
                    hit |= set(range(i, i + size))
                    found |= wins[t]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(docs, bench):
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r[c] for c in cols) for r in D.contamination(docs, bench).collect()), key=str)


def test_matches_brute_force(documents, benchmark):
    want = slow([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert got(documents, benchmark) == want
    assert any(r[5] for r in want) and not all(r[5] for r in want)


def test_windows_short_items_and_overlaps(spark, odd, empty):
    long = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, long), (2, "Red-Fox"), (3, ""), (4, None), (None, "the door"), (2, "red fox"), (9, "cat sat on the mat and"), (10, "word5")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("key", F.lit(1))
    docs = [(10, f"zero {long} thirteen"), (11, long[4:]), (12, "a RED fox, red fox red"), (13, "one two three four five six seven eight nine"),
            (14, f"{long} {long}"), (15, None), (16, "")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(frame, bench) == slow(docs, items)
    odd_rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd, bench) == slow(odd_rows, items)
    assert D.contamination(empty, bench).count() == 0
    assert not any(r[5] for r in got(frame, bench.limit(0)))


def test_only_contaminated_documents_go(documents, benchmark, odd):
    clean = {r.doc_id for r in D.contamination(documents, benchmark).where("not contaminated").collect()}
    out = D.decontaminate(documents, benchmark)
    assert out.columns == documents.columns and {r.doc_id for r in out.collect()} == clean
    assert D.decontaminate(odd, benchmark).count() == odd.count()


@pytest.mark.parametrize("block", [1 << 20, 64, 7])
def test_word_hashes_do_not_depend_on_blocks(monkeypatch, block):
    text = D._fold(("The quick brown fox " * 30 + "x" * 500 + " jumps over " * 3).encode())
    want = D._Hasher().words(text)[2]
    monkeypatch.setattr(D, "_BLOCK", block)
    hasher = D._Hasher()
    start, end, have = hasher.words(text)
    assert [text[a:b] for a, b in zip(start, end)] == text.split()
    by = {}
    for w, h in zip(text.split(), have):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)
    if block > 1000:
        assert (want == have).all()
