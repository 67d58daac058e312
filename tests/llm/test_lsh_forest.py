"""LSH forest components against an exact prefix-filter join in Python."""
import collections
import random
import re

import numpy as np
import pytest

from custvalue.llm.lsh_forest import AGREE, alike, minhash_components, shingle_set, signature

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id bigint, text string"


def grams(text):
    w = WORD.findall((text or "").translate(FOLD))
    if len(w) < 2:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(w, w[1:]))


def brute(rows):
    docs = [(d, grams(t)) for d, t in rows]
    members = collections.defaultdict(list)
    for i, (_, g) in enumerate(docs):
        if g:
            members[g].append(i)
    keys = sorted(members, key=len)
    freq = collections.Counter(x for k in keys for x in k)
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    index = collections.defaultdict(list)
    for i, k in enumerate(keys):
        head = sorted(k, key=lambda x: (freq[x], x))[:len(k) - (4 * len(k) + 4) // 5 + 1]
        for j in {j for x in head for j in index[x]}:
            both = len(k & keys[j])
            if 100 * both >= 80 * (len(k) + len(keys[j]) - both):
                root[find(i)] = find(j)
        for x in head:
            index[x].append(i)
    least, comp = {}, {}
    for i, k in enumerate(keys):
        for m in members[k]:
            d = docs[m][0]
            if d is not None:
                least[find(i)] = min(least.get(find(i), d), d)
    for i, k in enumerate(keys):
        for m in members[k]:
            comp[m] = least.get(find(i))
    return [(d, len(g), comp[i] if g else d, d is not None and d == (comp[i] if g else d))
            for i, (d, g) in enumerate(docs)]


def order(r):
    return tuple((x is not None, x or 0) for x in r)


def check(df):
    got = sorted((tuple(r) for r in minhash_components(df).collect()), key=order)
    assert got == sorted(brute([tuple(r) for r in df.select("doc_id", "text").collect()]), key=order)
    return got


def test_documents(documents):
    got = check(documents)
    assert 0 < sum(r[3] for r in got) < len(got)


def test_empty(spark):
    assert check(spark.createDataFrame([], SCHEMA)) == []


def test_odd_rows(spark, odd):
    got = check(odd)
    assert all(r[2] == r[0] for r in got if r[1] == 0)
    check(spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (5, "A"), (None, "a"),
                                 (None, "zz q"), (9, "a b"), (10, "b a"), (11, "Ä b"), (12, "ä b")], SCHEMA))


def test_clashing_columns(spark, documents):
    names = ["class", "signature", "tree", "band", "n", "set", "comp", "text_key"]
    df = documents.selectExpr("doc_id", "text", *[f"doc_id as {c}" for c in names])
    check(df)


def test_large_near_copy_group_and_shared_passage(spark):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(5000)}" for _ in range(60)]
    rows = []
    for i in range(2400):
        if i % 3 == 0:                                    # near copies of one text, all different
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 4, 6])):
                w[rnd.randrange(60)] = f"x{rnd.randrange(10 ** 6)}"
        elif i % 3 == 1:                                  # one passage in otherwise different texts
            w = base[:25] + [f"y{rnd.randrange(10 ** 6)}" for _ in range(35)]
        else:
            w = [f"z{rnd.randrange(300)}" for _ in range(rnd.choice([1, 2, 3, 10, 40]))]
        rows.append((i, " ".join(w)))
    check(spark.createDataFrame(rows, SCHEMA).repartition(4))


def test_template_below_the_threshold(spark):
    """Many texts of one frame, each pair near 0.7: crowded regions without links."""
    frame = [f"f{i}" for i in range(120)]
    rows = [(i, " ".join(frame + [f"u{i}_{k}" for k in range(26)])) for i in range(600)]
    got = check(spark.createDataFrame(rows, SCHEMA))
    assert sum(r[3] for r in got) == 600


def test_chain_of_near_copies(spark):
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 4:i * 4 + 100])) for i in range(75)]
    assert {r[2] for r in check(spark.createDataFrame(rows, SCHEMA))} == {0}


@pytest.mark.parametrize("n,other", [(90, 10), (450, 50)])
def test_signatures_agree_with_the_similarity(n, other):
    a = shingle_set(" ".join(f"w{i}" for i in range(n + other)).encode())
    b = shingle_set(" ".join(f"w{i}" for i in range(other, n + 2 * other)).encode())
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    agree = int((signature(a) == signature(b)).sum())
    assert abs(agree - 192 * j) < 30 and agree >= AGREE
    assert alike(a, b, 80) == (j >= 0.8)
