import numpy as np
import pytest

from custvalue.llm import language as L


def slow_bits(data, counts):
    """PPM code length by the definition, from a dict of (context, byte) counts of one language."""
    total = 0.0
    for i in range(3, len(data)):
        bits = 0.0
        for k in (3, 2, 1, 0):
            ctx = data[i - k:i]
            row = counts.get(ctx, {})
            n, t = sum(row.values()), len(row)
            if data[i] in row:
                bits -= np.log2(row[data[i]] / (n + t))
                break
            if n:
                bits -= np.log2(t / (n + t))
        else:
            bits += 8
        total += bits
    return total


def test_code_length_is_exact():
    samples = {"en": ["the cat and the dog", "they then that"], "de": ["der hund und die katze", "größer"]}
    codes, lang, counts = [], [], [{}, {}]
    for j, name in enumerate(sorted(samples)):
        for text in samples[name]:
            data = L.folded(text)
            codes.append(L.grams(data))
            lang.append(np.full(len(codes[-1]), j))
            for i in range(3, len(data)):
                for k in range(4):
                    row = counts[j].setdefault(data[i - k:i], {})
                    row[data[i]] = row.get(data[i], 0) + 1
    code, which = np.concatenate(codes), np.concatenate(lang)
    trees = L.build_trees(code, which, np.ones(len(code)), sorted(samples))
    for text in ("the hund", "zebra größe und", "x", "they that der", "ωμέγα"):
        data = L.folded(text)
        want = [slow_bits(data, counts[0]), slow_bits(data, counts[1])]
        assert trees.bits(data) == pytest.approx(want, rel=1e-5)


def test_blocks_do_not_change_the_length(monkeypatch, documents):
    trees = L.fit_trees(documents)
    data = L.folded(" ".join(r.text or "" for r in documents.limit(20).collect()))
    want = trees.bits(data)
    monkeypatch.setattr(L, "_BLOCK", 1000)
    assert trees.bits(data) == pytest.approx(want, rel=1e-6)


def test_slots_find_every_code():
    codes = np.unique(np.random.default_rng(1).integers(0, 2**32, 5000, dtype=np.uint32))
    slots = L.Slots(codes)
    assert (slots.find(codes) == np.arange(len(codes))).all()
    others = np.setdiff1d(np.random.default_rng(2).integers(0, 2**32, 5000, dtype=np.uint32), codes)
    assert (slots.find(others) == -1).all()
    assert (L.Slots(codes[:0]).find(others) == -1).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)


def test_odd_rows(odd, empty):
    got = L.identify_languages(odd).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (2, 3, 4, 7))
    assert {r.lang_pred for r in got if r.doc_id in (1, 5, 6)} <= {"en", "de"}
    assert {r.lang_pred for r in L.identify_languages(odd.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}
    assert L.identify_languages(empty).count() == 0
