import math

import pytest

from custvalue.llm.mixing import mix, temperature


def shares(spark, values):
    total = sum(values)
    return spark.createDataFrame([(v / total,) for v in values], "p double")


def slow_entropy(values, alpha):
    p = [(v / sum(values)) ** alpha for v in values]
    return -sum(x / sum(p) * math.log(x / sum(p)) for x in p)


def test_exponent(spark):
    values = [1000, 10, 1, 400]
    a = temperature(shares(spark, values), entropy=1.0)
    assert slow_entropy(values, a) == pytest.approx(1.0, abs=1e-6)
    r = temperature(shares(spark, values), max_repeats=4)
    assert (1000 / 1) ** (1 - r) == pytest.approx(4, rel=1e-6)
    assert temperature(shares(spark, values), max_repeats=1) == 1.0
    assert temperature(shares(spark, values), max_repeats=1e9) == 0.0
    with pytest.raises(ValueError):
        temperature(shares(spark, values))


def test_realised_weights(spark):
    docs = [(i, " ".join(["w"] * (1 + i % 7)), f"s{min(i % 10, 4)}") for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    tokens, total = {}, 0
    for _, t, s in docs:
        tokens[s] = tokens.get(s, 0) + len(t.split())
        total += len(t.split())
    for kw in ({"max_repeats": 2.0}, {"max_repeats": None, "entropy": 1.55, "budget_tokens": 30_000.0},
               {"max_repeats": 3.0, "budget_tokens": 5_000.0}):
        rows = mix(frame, block_tokens=300, text_out=False, **kw).collect()
        budget = kw.get("budget_tokens") or max(tokens[r.source] / r.mix_weight for r in rows)
        got, seen = {}, {}
        for r in rows:
            got[r.source] = got.get(r.source, 0) + r.tokens
            seen.setdefault((r.source, r.doc_id), set()).add(r.mix_epoch)
        weights = {r.source: r.mix_weight for r in rows}
        assert sum(weights.values()) == pytest.approx(1)
        for s, w in weights.items():
            assert abs(got[s] - w * budget) <= 4                 # half of the longest document
        assert all(v == set(range(len(v))) for v in seen.values())    # passes 0, 1, ... without a gap
        assert len({(r.doc_id, r.mix_epoch) for r in rows}) == len(rows)
        if kw == {"max_repeats": 2.0}:
            assert {d for _, d in seen} == set(range(3000)) and max(map(len, seen.values())) <= 2
        assert all(0 <= r.mix_position <= 1 for r in rows)


def test_blocks_are_contiguous(spark):
    frame = spark.createDataFrame([(i, "a b c d", "one") for i in range(2000)], "doc_id bigint, text string, source string")
    rows = sorted(mix(frame, block_tokens=400, text_out=False).collect(), key=lambda r: r.mix_position)
    order = [r.mix_block for r in rows]
    assert len({b for b in order}) == 20 and sum(a != b for a, b in zip(order, order[1:])) == 19
    assert order != sorted(order)


def test_odd_rows(odd, empty):
    out = mix(odd)
    assert [c for c in out.columns if not c.startswith("mix_")] == odd.columns
    ids = [r.doc_id for r in out.collect()]
    assert set(ids) == {1, 2, 3, 4, 5, 6, 7, 8, None} and ids.count(6) >= 2
    assert mix(empty).count() == 0 and mix(empty, text_out=False).count() == 0
    assert mix(odd.where("text is null")).count() == 2
