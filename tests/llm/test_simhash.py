from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from custvalue.llm.common import connected_components
from custvalue.llm.simhash import fingerprint_groups, simhash, simhash_components, simhash_dedup


def slow_simhash(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(values, bits=2):
    values, parent = sorted(set(values)), {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                parent[root(a)] = root(b)
    return {v: root(v) for v in values}


def partition(pairs):
    out = defaultdict(set)
    for member, group in pairs:
        out[group].add(member)
    return sorted(map(sorted, out.values()))


def test_matches_brute_force(spark, documents):
    got = simhash_components(documents).collect()
    prints = {r.doc_id: slow_simhash(r.text) for r in documents.select("doc_id", "text").collect()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints
    root = slow_groups(prints.values())
    least = {}
    for doc, fp in prints.items():
        least[root[fp]] = min(doc, least.get(root[fp], doc))
    assert {r.doc_id: r.component_id for r in got} == {d: least[root[fp]] for d, fp in prints.items()}


def test_dense_groups_are_linked_exactly(spark):
    """Large balls of near copies go the linear way; small lists are paired; both agree with brute force."""
    rng = np.random.default_rng(5)
    values = set()
    for _ in range(3):
        centre = int(rng.integers(0, 2**62))
        for _ in range(120):
            v = centre
            for b in rng.integers(0, 63, rng.integers(0, 5)):
                v ^= 1 << int(b)
            values.add(v)
    values |= {int(x) for x in rng.integers(0, 2**62, 50)}
    frame = spark.createDataFrame([(v,) for v in values], "fp bigint")
    want = partition((v, r) for v, r in slow_groups(values).items())
    for block in (4, 32, 100_000):
        got = fingerprint_groups(frame, 2, pair_block=block).collect()
        assert partition((r.fp, r.group) for r in got) == want
    one = slow_groups(values, 1)
    got = fingerprint_groups(frame, 1, pair_block=4).collect()
    assert partition((r.fp, r.group) for r in got) == partition(one.items())


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "src bigint, dst bigint")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1001] == 1000


def test_odd_rows(odd, empty):
    got = simhash_components(odd).collect()
    assert len(got) == 12
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert sorted((r.doc_id or 0) for r in zero) == [0, 2, 3, 4] and {r.component_id for r in zero} == {2}
    assert {r.component_id for r in got if r.doc_id in (1, 5)} == {1}
    assert simhash_components(empty).count() == 0
    assert simhash(b"A b", 3) == simhash(b"a  B", 3) != 0


def test_dedup_keeps_one_of_each_group(spark, documents, odd, empty):
    kept = simhash_dedup(documents)
    comps = simhash_components(documents)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.component_id for r in comps.select("component_id").distinct().collect())
    assert kept.columns == documents.columns
    out = simhash_dedup(odd)
    assert out.columns == odd.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 6, 7, 8] and ids.count(None) == 1
    assert simhash_dedup(empty).count() == 0
    assert out.where(F.col("doc_id") == 6).count() == 1
