"""The pipeline against a version that works on plain lists, stage by stage."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from strata.llm.packing import packed, piece_digests
from tests.conftest import SMALL, rows_of
from tests.llm.conftest import text_pairs
from tests.llm.plain import plain_copies, plain_exact, plain_good, plain_near


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(params=["documents", "odd"])
def docs(request):
    found = request.getfixturevalue(request.param)
    return found.where("length(text) < 4000") if request.param == "documents" else found


@pytest.fixture
def given(labels):
    return [(r.doc_id, r.quality) for r in labels.collect()]


STAGES = dict(corpus_pipeline.STAGES)


def test_stages_keep_the_columns_and_call_the_operators(spark, docs):
    assert list(STAGES) == ["quality", "exact_dedup", "near_dedup", "mix_sources", "pack"]
    for name in list(STAGES)[:-1]:
        assert STAGES[name](spark, docs, SMALL).columns == docs.columns


def test_quality_drops_what_scores_low(spark, docs, given):
    kept = rows(STAGES["quality"](spark, docs, SMALL))
    assert kept == Counter(plain_good([tuple(r) for r in docs.collect()], given))


def test_exact_dedup_keeps_the_largest_id_of_each_text(spark, docs):
    kept = text_pairs(STAGES["exact_dedup"](spark, docs, SMALL))
    assert Counter(kept) == Counter((r[0], r[1] or "") for r in plain_exact([tuple(r) for r in docs.collect()]))


def test_near_dedup_keeps_one_row_of_each_group(spark, docs):
    kept = rows(STAGES["near_dedup"](spark, docs, SMALL))
    assert kept == Counter(plain_near([tuple(r) for r in docs.collect()]))


def test_mix_repeats_whole_documents(spark, docs):
    assert rows(STAGES["mix_sources"](spark, docs, SMALL)) == plain_copies([tuple(r) for r in docs.collect()])


def test_run_makes_the_decisions_of_plain_lists(spark, given):
    """The pieces of what the five decisions leave of the whole table."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    left = plain_near(plain_exact(plain_good([tuple(r) for r in docs.collect()], given)))
    left = spark.createDataFrame(list(plain_copies(left).elements()), docs.schema)
    expected = piece_digests(packed(left, public_tokenizers.path("word_bpe_49k.json")))
    assert rows_of(corpus_pipeline.run(spark, SMALL)) == rows_of(expected)
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == []
