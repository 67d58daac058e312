import zlib
from collections import Counter, defaultdict

from custvalue.llm.sharding import cut_edges, propagate, shard_documents


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(slots[j]) for j in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_even_and_together(spark):
    docs = [(i, f"text {i // 3}" if i < 900 else f"single {i}") for i in range(2003)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = shard_documents(frame).collect()
    check(rows, docs, 8)
    where, text = defaultdict(set), dict(docs)
    for r in rows:
        where[text[r.doc_id]].add(r.shard)
    assert sum(len(v) > 1 for t, v in where.items()) <= 0.05 * 300      # groups of three that were cut


def test_no_group_that_fits_is_cut(spark):
    sizes = [2] * 200 + [3] * 200 + [10] * 40 + [50] * 10 + [150]
    docs = [(0, f"group {g}") for g, n in enumerate(sizes) for _ in range(n)] + [(0, f"single {i}") for i in range(800)]
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    rows = shard_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    check(rows, docs, 8)
    where, text = defaultdict(set), dict(docs)
    for r in rows:
        where[text[r.doc_id]].add(r.shard)
    assert [t for t, v in where.items() if len(v) > 1] == []


def test_one_group_larger_than_a_shard(spark):
    docs = [(i, "the same text") for i in range(1200)] + [(i, f"pair {i // 2}") for i in range(1200, 1600)] + [(i, f"one {i}") for i in range(1600, 2400)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = shard_documents(frame, whole_group=300, bucket_rows=100).collect()
    check(rows, docs, 8)
    where, text = defaultdict(set), dict(docs)
    for r in rows:
        where[text[r.doc_id]].add(r.shard)
    assert sum(len(v) > 1 for t, v in where.items() if t.startswith("pair")) <= 20


def test_propagation_cuts_fewer_edges_within_quota(spark):
    edges = spark.createDataFrame([(g * 10 + i, g * 10 + (i + 1) % 10) for g in range(100) for i in range(10)], "src bigint, dst bigint")
    nodes = spark.createDataFrame([(i, i % 4) for i in range(1000)], "id bigint, label int")
    before = cut_edges(edges, nodes).count()
    after = propagate(nodes, edges, 0, 4, rounds=8, slack=0.1)
    assert cut_edges(edges, after).count() < 0.8 * before
    sizes = [r["count"] for r in after.groupBy("label").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 330


def test_odd_rows(odd, empty, documents):
    check(shard_documents(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()], 8)
    check(shard_documents(documents, shards=3).collect(), [(r.doc_id, r.text) for r in documents.collect()], 3)
    assert shard_documents(empty).count() == 0
