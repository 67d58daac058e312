import itertools
import random

import pytest

from custvalue.llm import toxicity as T


def slow_segments(scores):
    """All maximal scoring segments by their recursive definition: take the best, then left and right of it."""
    best = None
    for a, b in itertools.combinations(range(len(scores) + 1), 2):
        s = sum(scores[a:b])
        if s > 1e-12 and (best is None or s > best[0] + 1e-9 or abs(s - best[0]) <= 1e-9 and b - a < best[2] - best[1]):
            best = (s, a, b)
    if best is None:
        return []
    s, a, b = best
    return slow_segments(scores[:a]) + [(a, b - 1, s)] + [(x + b, y + b, z) for x, y, z in slow_segments(scores[b:])]


def test_segments_match_the_definition():
    rng = random.Random(4)
    for _ in range(300):
        drift, n = 0.5, rng.randint(0, 14)
        hits = {i: rng.choice([3.7, 1.3, 0.9, -1.1, 2.1]) + rng.random() / 7 for i in range(n) if rng.random() < 0.5}
        scores = [hits.get(i, -drift) for i in range(n)]
        got = T.maximal_segments(sorted(hits.items()), drift)
        want = slow_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_every_passage_of_a_long_text_is_found():
    insults = [b"vile%d" % i for i in range(6)]
    model = T.ToxicModel({w: 3.0 for w in insults} | {b"kind": -3.0}, frozenset(), lam=1.0, k=0.01)
    plain = [b"word%d" % (i % 50) for i in range(400)]

    def found(ws):
        return [(a, b) for a, b, s in model.segments(ws) if s > model.chance(len(ws)) / model.lam]

    assert found(plain + insults + plain + insults + plain) == [(400, 405), (806, 811)]
    singles = [w for i in insults for w in [i] + plain[:150]]
    at = len(singles) + 400
    assert (at, at + 5) in found(singles + plain + insults + plain)
    near = model.segments(plain + insults[:1] * 20 + plain)      # one word over and over is not a passage of many
    assert near[0][2] < 4
    spoken = model.segments(insults[:1] + [b"kind"] + plain + insults[1:2] + [b"kind"] + insults[2:3])
    assert [(a, b) for a, b, _ in spoken] == [(0, 0), (402, 402), (404, 404)]


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = T.toxicity_scores(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in got if r.toxic == 1]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in got if r.toxic == 0) <= 0.03 * len(got)
    assert all(r.n_passages == len(r.passages) and (r.predicted == 1) == (r.score >= 0.3) for r in got)


def test_odd_rows(odd, empty, labels):
    for given in (labels, labels.limit(0), labels.where("toxic = 0")):
        got = T.toxicity_scores(odd, given).collect()
        assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
        assert all(r.n_passages == 0 for r in got if r.doc_id in (2, 3, 4))
        assert T.toxicity_scores(empty, given).count() == 0
