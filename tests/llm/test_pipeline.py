import pytest

import corpus_pipeline
from custvalue.llm.common import table, written
from custvalue.llm.decontaminate import contamination
from custvalue.llm.quality import quality_scores
from custvalue.llm.simhash import simhash_components
from test_shards import decode

import __spark_entry__ as E
from oracle_check import compare, duck


def test_every_stage_on_what_its_predecessor_kept(spark, sf, documents, labels, benchmark):
    docs, names = documents, documents.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), f"test-{name}")
        if name == "quality":
            want = {r.doc_id for r in quality_scores(docs, labels).where("accepted").collect()}
        elif name == "near_dedup":
            want = {r.component_id for r in simhash_components(docs).collect()}
        elif name == "decontamination":
            want = {r.doc_id for r in contamination(docs, benchmark).where("not contaminated").collect()}
        elif name == "mixing":
            want = {r.doc_id for r in docs.collect()}
        if name != "token_records":
            assert out.columns == names and {r.doc_id for r in out.collect()} == want
            if name != "mixing":
                assert out.count() == len(want)
            kept[name] = len(want)
            docs = out
    assert sorted(decode(out.collect())) == sorted(r.text or "" for r in docs.collect())
    assert documents.count() > kept["quality"] > kept["near_dedup"] > kept["decontamination"] == kept["mixing"]


def test_run_and_registration(spark, sf):
    qs = E.queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in qs)] == [] and "pipeline" in qs
    assert qs["pipeline"](spark, sf).count() > 0


@pytest.mark.parametrize("name", [n for n in E.oracle_sql() if n.startswith("op")])
def test_sql_twins(spark, sf, name):
    assert compare(name, spark, duck(sf), sf, E.queries()[name], E.oracle_sql()[name])["status"] == "exact"


def test_stages_keep_clashing_columns(spark, sf, odd):
    """Every stage but the last gives a user's columns back as they were."""
    import corpus_pipeline
    rows = {(r.doc_id, r.text): r for r in odd.collect()}
    names = [c for c in odd.columns if c not in ("doc_id", "text")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns, name
        for r in out.collect():
            assert r["row"].startswith("row") and r["__key"].startswith("__key") and r["quality"].startswith("quality"), name
        assert names


def test_mixture_order_reaches_the_next_stage(spark, sf, documents):
    """Passes of a repeated document lie apart in the order in which the next stage reads."""
    import corpus_pipeline
    from pyspark.sql import functions as F
    out = corpus_pipeline.mixing(spark, documents, sf).withColumn("at", F.monotonically_increasing_id()).collect()
    place = {}
    for i, r in enumerate(sorted(out, key=lambda r: r["at"])):
        place.setdefault(r.doc_id, []).append(i)
    gaps = [b - a for v in place.values() for a, b in zip(v, v[1:])]
    assert gaps and sum(g > len(out) / 20 for g in gaps) > 0.8 * len(gaps)
