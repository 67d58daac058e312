import hashlib
import re

import pytest

from custvalue.llm import spotsigs as G


def slow_set(text):
    common, w = set(G.COMMON_WORDS), re.findall(r"[^\W\d_]+", (text or "").lower())
    out, follow = set(), []
    for a in reversed(w):
        if a not in common:
            follow = [a, *follow[:1]]
        elif len(follow) == 2:
            out.add((a, *follow))
    return out or {(" ".join(w),)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def check(rows, docs):
    """``docs``: distinct ids."""
    order = sorted(docs, key=lambda r: -r[0])
    got = {r.doc_id: r for r in rows}
    prints = {}
    for i, (doc, text) in enumerate(order):
        text, follow = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + follow[:half]
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = slow_set(text), slow_set(edited), slow_set(follow)
        assert r.near_edited == pytest.approx(jaccard(a, b)) and r.near_next == pytest.approx(jaccard(a, c))
        assert (r.fingerprint == r.edited_fingerprint) == (a == b)
        assert prints.setdefault(frozenset(a), r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_matches_brute_force(documents):
    check(G.fingerprints(documents).collect(), [(r.doc_id, r.text) for r in documents.collect()])


def test_order_over_parts(spark):
    ids = [3, 90, 14, 1, 77, 25, 60]
    frame = spark.createDataFrame([(i, f"the text number {i} of a lot") for i in ids], "doc_id bigint, text string")
    nxt = {r.row.split(":")[0]: r.next_row.split(":")[0] for r in G.successors(frame, rows_per_part=2).collect()}
    order = [str(i) for i in sorted(ids, reverse=True)]
    assert nxt == dict(zip(order, order[1:] + order[:1]))


def test_odd_rows(spark, odd, empty):
    rows = G.fingerprints(odd).collect()
    assert len(rows) == 12 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert by[1] == by[5] and len(by[6]) == 1 and by[2] == by[3] == by[4]
    assert G.fingerprints(empty).count() == 0
    single = spark.createDataFrame([(1, "on the one hand and so on")], "doc_id bigint, text string")
    check(G.fingerprints(single).collect(), [(1, "on the one hand and so on")])


def test_no_python_on_the_executors(documents):
    plan = G.fingerprints(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pruning_never_loses_a_likeness_above_the_floor(spark):
    import random
    rng = random.Random(2)
    pairs = [(rng.sample(range(60), rng.randint(1, 50)), rng.sample(range(60), rng.randint(1, 50))) for _ in range(200)]
    pairs += [(list(range(n)), list(range(n - n // 5))) for n in range(5, 60)]
    frame = spark.createDataFrame(pairs, "a array<int>, b array<int>")
    for floor in (0.3, 0.8):
        rows = frame.select("a", "b", G.pruned_jaccard(frame.a, frame.b, floor).alias("j")).collect()
        assert sum(r.j == 0 for r in rows) > 20
        for r in rows:
            want = jaccard(set(r.a), set(r.b))
            assert r.j == pytest.approx(want) or (r.j == 0 and want < floor)
