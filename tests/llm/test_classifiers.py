from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.learning import Factorization, Rows, bounded, calibration, fit, held_out, sample, screened, sigmoid
from strata.llm.quality import certain_documents, co_train, good_documents, meta_view, quality, text_view, train
from strata.llm.toxicity import learn, terms, toxicity
from strata.llm.toxicity import train as train_toxicity
from tests.conftest import rows_of
from tests.llm.conftest import text_pairs
from tests.llm.plain import by_hash_of, plain_quality, plain_scores

LARGER = "/root/testdata/sf0.1"


def test_held_out_fold_is_the_crc_of_the_id(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id").withColumn("h", held_out())
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.collect())


def test_sample_is_bounded_and_never_from_the_held_out_fold(spark, documents, labels):
    rows = sample(documents, labels.union(labels), "toxic", rows=20).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 20
    assert not any(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)


def test_labels_of_absent_documents_do_not_use_up_the_bound(spark, documents, labels):
    absent = spark.range(10**6, 10**6 + 5000).selectExpr("id AS doc_id", "1 AS quality", "1 AS toxic")
    few = sample(documents, labels.unionByName(absent), "toxic", rows=20)
    assert rows_of(few) == rows_of(sample(documents, labels, "toxic", rows=20))


def test_features_are_bounded_in_bytes(documents, labels):
    def featured(most):
        rows = sample(documents, labels, "quality").select("doc_id", F.col("text").cast("binary").alias("f"))
        return bounded(rows, ["f"], most)

    everything = featured(1 << 30)
    order = sorted(everything, key=lambda r: by_hash_of(r.doc_id))
    size = sum(len(r.f) for r in order[:9])
    assert [r.doc_id for r in featured(size)] == sorted(r.doc_id for r in order[:9])
    assert [r.doc_id for r in everything] == sorted(r.doc_id for r in everything)


def test_odd_labels_are_left_out(spark, documents):
    odd = spark.createDataFrame(
        [(0, None, 1), (1, 3, 2), (None, 1, 1), (3, 1, 0), (3, 0, 0), (10**9, 1, 1)], "doc_id long, quality int, toxic int"
    )
    kept = {r.doc_id: r.label for r in sample(documents, odd, "quality").collect()}
    assert kept in ({3: 1}, {})  # id 3 counts unless it belongs to the held-out fold


def test_factors_learn_a_pair_that_weights_cannot():
    """Toxic only if both terms stand together or neither does: no additive score separates that."""
    random = np.random.default_rng(0)
    both = random.integers(0, 2, (800, 2))
    rows = Rows.of([(np.flatnonzero(np.r_[b, 1]), np.ones(int(b.sum()) + 1)) for b in both])
    labels = (both[:, 0] == both[:, 1]).astype(float)
    pairs = fit(rows, labels, 3, n_factors=4, epochs=60, rate=0.3)
    alone = fit(rows, labels, 3, n_factors=0, epochs=60, rate=0.3)
    right = lambda m: ((sigmoid(m.raw(rows)) >= 0.5) == labels).mean()
    assert right(pairs) > 0.98 and right(alone) < 0.8


def test_raw_scores_equal_the_sum_over_pairs():
    random = np.random.default_rng(1)
    model = Factorization(0.3, random.normal(size=6), random.normal(size=(6, 3)))
    index, value = np.array([0, 2, 5]), np.array([1.0, 0.5, 2.0])
    pairs = sum(
        model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b] for a in range(3) for b in range(a)
    )
    expected = 0.3 + model.weights[index] @ value + pairs
    nothing = np.zeros(0, int)
    rows = Rows.of([(index, value), (nothing, nothing.astype(float))])
    assert model.raw(rows) == pytest.approx([expected, 0.3])
    assert model.raw_one(index, value) == pytest.approx(expected)


def test_screening_and_calibration():
    rows = Rows.of([(np.array([0, 2] if k % 2 else [1, 2]), np.ones(2)) for k in range(60)])
    labels = np.arange(60) % 2 * 1.0
    assert screened(rows, labels, 4, 3.0).tolist()[:3] == [True, True, False]
    assert screened(Rows.of([]), np.zeros(0), 4, 3.0).tolist() == [False] * 4
    slope, offset = calibration(np.repeat([-2.0, 2.0], 50)[:, None], np.r_[np.zeros(45), np.ones(10), np.ones(45)])
    assert slope > 0
    assert calibration(np.ones((3, 2)), np.ones(3)).tolist() == [0.5, 0.5, 0.0]


def test_views_teach_each_other():
    """Few labels; the second view learns a feature it only sees beside rows the first one is sure of."""
    random = np.random.default_rng(2)
    n = 1200
    truth = random.integers(0, 2, n).astype(float)
    one = Rows.of([(np.array([int(t)]), np.array([4.0])) for t in truth])
    two = Rows.of([(np.array([2 * random.integers(0, 200) + int(t)]), np.array([1.0])) for t in truth])
    labels = np.where(np.arange(n) < 60, truth, -1)
    model = co_train(one, two, labels)
    unseen = np.arange(60, n)
    right = ((model.models[1].raw(two.take(unseen)) > 0) == truth[unseen]).mean()
    first = fit(two.take(np.arange(60)), truth[:60], 1 << 10)
    alone = ((first.raw(two.take(unseen)) > 0) == truth[unseen]).mean()
    assert right > 0.95 > alone


@pytest.mark.parametrize("handed_on", [3, 1000])
def test_training_and_scores_equal_a_version_on_plain_lists(spark, handed_on):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet").where("doc_id < 1500") for t in ("documents", "labels"))
    rows, given = ([tuple(r) for r in t.collect()] for t in (docs, labels.select("doc_id", "quality")))
    expected, taught = plain_quality(rows, given, handed_on)
    model = train(docs, labels, handed_on=handed_on)
    for own, other in zip(model.models, expected.models):
        assert own.bias == pytest.approx(other.bias) and own.weights == pytest.approx(other.weights, abs=1e-9)
    assert len(taught) == 2 and all(len(t) > 3 for t in taught)
    if handed_on == 1000:
        found = {r.doc_id: r.score for r in quality(docs, labels).collect()}
        assert found == pytest.approx(plain_scores(expected, rows), abs=1e-6)


def test_candidates_come_from_the_whole_corpus(documents, labels):
    """A view that is sure of everything hands on the rows that come first by hash, from all unlabelled ones."""
    sure = [fit(Rows.of([]), np.zeros(0), size) for size in (1 << 14, 1 << 10)]
    for model in sure:
        model.bias = 9.0
    ids = {r.doc_id for r in documents.collect()} - {r.doc_id for r in labels.where("quality IN (0, 1)").collect()}
    ids = sorted((i for i in ids if zlib.crc32(str(i).encode()) % 4 != 2), key=by_hash_of)
    found = certain_documents(documents, labels, tuple(sure), 9).collect()
    assert {r.doc_id for r in found} == set(ids[:9])


def test_toxicity_scores_equal_sums_over_pairs(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    model = train_toxicity(docs, labels)
    short = docs.where("length(text) < 300 AND doc_id < 3000").limit(60)
    found = {r.doc_id: r.score for r in toxicity(docs, labels).join(short.select("doc_id"), "doc_id").collect()}
    for doc_id, text in text_pairs(short):
        index = terms(text.encode())
        raw = model.bias + sum(model.weights[i] for i in index)
        raw += sum(float(model.factors[a] @ model.factors[b]) for k, a in enumerate(index) for b in index[:k])
        assert found[doc_id] == pytest.approx(float(sigmoid(raw)), abs=1e-9)


def test_a_pair_of_words_that_look_alike_to_each_class_is_learned():
    """Neither word tells the classes apart; both together, or none of them, do."""
    random = np.random.default_rng(0)
    both = random.integers(0, 2, (1200, 2))
    noise = random.integers(100, 400, (1200, 6))
    index = [np.unique(np.r_[np.flatnonzero(b), 50, n]).astype(np.int32) for b, n in zip(both, noise)]
    labels = (both[:, 0] == both[:, 1]).astype(float)
    model = learn(index[:800], labels[:800])
    raw = model.raw(Rows.of([(i, np.ones(len(i))) for i in index[800:]]))
    assert ((sigmoid(raw) >= 0.5) == labels[800:]).mean() > 0.97
    assert not model.factors[450:].any()


@pytest.mark.parametrize(("score", "label", "least"), [(quality, "quality", 0.97), (toxicity, "toxic", 0.95)])
def test_held_out_accuracy(spark, score, label, least):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    held = score(docs, labels).where("held_out").join(labels, "doc_id")
    found = held.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("predicted") == F.col(label)).cast("double")).alias("right")).first()
    assert found.n > 500 and found.right >= least
    clean = held.where(F.col(label) == (1 if label == "quality" else 0))
    assert clean.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0] >= 0.99


@pytest.mark.parametrize("score", [quality, toxicity])
def test_odd_and_empty_tables(odd, empty, documents, labels, no_labels, score):
    rows = score(odd, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in text_pairs(odd))
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.held_out for r in rows if r.doc_id is None)
    assert score(empty, labels).collect() == []
    alike = score(documents, no_labels).select("score").distinct().count()
    assert alike == 1
    one_kind = labels.where("quality = 1 AND toxic = 0")
    assert score(documents, one_kind).select("score").distinct().count() >= 1


def test_reruns_and_layouts_agree(documents, labels):
    for score in (quality, toxicity):
        again = score(documents.repartition(5), labels.repartition(3))
        assert rows_of(score(documents, labels)) == rows_of(again)


def test_toxicity_reads_nothing_but_the_text(documents, labels):
    changed = documents.withColumns({"lang": F.lit("zz"), "source": F.lit("zz"), "n_chars": F.lit(1).cast("long")})
    assert rows_of(toxicity(documents, labels)) == rows_of(toxicity(changed, labels))


def test_good_documents_are_those_with_the_score(documents, labels):
    wide = documents.withColumn("row", F.lit("x"))
    kept = good_documents(wide, labels)
    assert kept.columns == wide.columns
    good = quality(documents, labels).where("predicted = 1").select("doc_id")
    assert rows_of(kept.select("doc_id")) == rows_of(good)


def test_views_of_edge_texts():
    for text in (b"", b" ", b"$$$", "é ü".encode()):
        for index, value in (text_view(text), meta_view(text, None, None, None)):
            assert len(index) == len(value) and np.isfinite(value).all()
    assert terms(b"").tolist() == []
