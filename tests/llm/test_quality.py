import numpy as np
from pyspark.sql import functions as F

from custvalue.llm import quality as Q


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = Q.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in got) / len(got)
    assert right > 0.93 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.quality == 1 and not r.accepted for r in got) <= 0.03 * len(got)


def test_views_teach_each_other():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 60)
    a = (y[:, None] * 4 + rng.normal(size=(60, 3))).astype(np.float32)
    b = (y[:, None] * 4 + rng.normal(size=(60, 2))).astype(np.float32)
    truth = rng.integers(0, 2, 500)
    pool_a = (truth[:, None] * 4 + rng.normal(size=(500, 3))).astype(np.float32)
    pool_b = (truth[:, None] * 4 + rng.normal(size=(500, 2))).astype(np.float32)
    model = Q.co_train(a, b, y, lambda fn, size: fn(pool_a, pool_b))
    assert all(x > 0 and z > 0 for x, z in model.exchanged[:2])
    assert (((model.score(pool_a, pool_b)[0] >= 0.5) == truth).mean()) > 0.97


def test_odd_rows(odd, empty, labels):
    for given in (labels, labels.limit(0)):
        got = Q.quality_scores(odd, given).collect()
        assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
        assert all(r.score == 0 and not r.accepted for r in got if r.doc_id in (2, 3))
        assert Q.quality_scores(empty, given).count() == 0
    assert Q.accept_quality(odd, labels).columns == odd.columns
    bare = odd.select("doc_id", "text")
    assert Q.quality_scores(bare, labels).count() == 12
    twice = labels.unionByName(labels.withColumn("quality", F.lit(None).cast("int")))
    assert Q.quality_scores(odd, twice).count() == 12


def test_accepts_what_it_scores(documents, labels):
    kept = {r.doc_id for r in Q.accept_quality(documents, labels).collect()}
    assert kept == {r.doc_id for r in Q.quality_scores(documents, labels).where("accepted").collect()}


def test_pool_is_summed_whole_in_spark(spark, documents, labels):
    slim = Q._with_meta(documents).collect()
    a = [Q.text_features(r.text and bytes(r.text)).tobytes() for r in slim]
    b = [Q.meta_codes(r.source, r.lang, r.n_chars) for r in slim]
    pool = spark.createDataFrame(list(zip(a, b)), "a binary, b binary").repartition(5)
    both = Q._unpack(a, b)
    assert (both[1].sum(1) == 3).all()

    def sums(x, z):
        return np.concatenate((x.sum(0), z.sum(0), [len(x)])).astype(float)

    got = Q.spark_total(pool)(sums, Q.CONTENT + Q.META + 1)
    np.testing.assert_allclose(got, sums(*both), rtol=1e-4)
    assert got[-1] == len(slim)


def test_cutoffs_keep_ties_and_the_sure_only():
    hist = np.zeros(Q.BINS)
    hist[Q.BINS // 2] = 700
    hist[-1], hist[-2], hist[0] = 200, 50, 50
    low, high = Q._cutoffs(hist, 0.95, 0.1)
    assert hist[high:].sum() == 200                          # the whole tied bin, though it is more than a tenth
    assert hist[:low + 1].sum() == 50                        # never a row less sure than 0.95
    assert Q._cutoffs(hist, 0.95, 0.22)[1] == Q.BINS - 2
    low, high = Q._cutoffs(np.zeros(Q.BINS), 0.95, 0.1)
    assert low < high


def test_repeated_ids_do_not_depend_on_order(spark, documents, labels):
    twice = documents.unionByName(documents.withColumn("text", F.reverse("text")))
    fits = [Q.fit_quality(d, labels) for d in (twice, twice.repartition(7, "text"))]
    np.testing.assert_allclose(fits[0].text.coef, fits[1].text.coef, rtol=1e-6, atol=1e-8)
    text_ids = documents.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    named = labels.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert Q.quality_scores(text_ids, named).count() == documents.count()
