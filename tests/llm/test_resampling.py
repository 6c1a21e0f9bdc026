from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm.common import numbered
from strata.llm.resampling import bracket, bucket_counts, drawn_documents, resampled
from tests.conftest import SMALL
from tests.llm.conftest import EXTRA, SCHEMA


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(docs, targets, percent=10, least=20):
    bucket = lambda w: zlib.crc32(w.encode()) % 10000
    s = Counter(bucket(w) for _, t in docs for w in words_of(t))
    t = Counter(bucket(w) for x in targets for w in words_of(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        words = words_of(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in map(bucket, words)]
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = sum(gain) + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(words), sum(gain), score))
    enough = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0], r[1:3]))
    drawn = enough[: percent * len(enough) // 100]
    rest = Counter(rows)
    rest.subtract(drawn)
    return Counter([(*r, k) for k, r in enumerate(drawn, 1)]) + Counter({(*r, None): n for r, n in rest.items() if n > 0})


def found(docs, target, **how):
    return Counter(map(tuple, resampled(docs, target, **how).collect()))


def expected(docs, target, **how):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    return brute_force(rows, [r.text for r in target.select("text").collect()], **how)


@pytest.mark.parametrize("percent", [10, 37, 100])
def test_documents(spark, documents, percent):
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert found(documents, target, percent=percent) == expected(documents, target, percent=percent)


@pytest.mark.parametrize("least, percent", [(0, 50), (1, 30), (20, 10)])
def test_odd_rows(odd, documents, least, percent):
    how = {"least_words": least, "percent": percent}
    assert found(odd, documents, **how) == expected(odd, documents, least=least, percent=percent)


def test_a_third_of_equal_rows(spark):
    """One document a third of all rows: equal ranks are cut through the middle of the copies."""
    text = "some words that come again and again " * 5
    rows = [(7, text, None, None, None) + EXTRA] * 300
    rows += [(k, f"{text} word{k % 50} other{k}", None, None, None) + EXTRA for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    target = spark.createDataFrame([("some other words", 1)], "text string, n int")
    assert found(docs, target, percent=40) == expected(docs, target, percent=40)


def test_empty_tables(empty, documents):
    assert resampled(empty, documents).collect() == []
    assert found(documents, empty) == expected(documents, empty)


def test_a_bracket_that_misses_is_widened(spark):
    scores = spark.range(10_000).select((F.col("id") % 1000).alias("score"))
    for wanted in (1, 100, 5_000, 10_000):
        low, high, above = bracket(scores, wanted, 10_000, margin=1e-9)
        at = 999 - (wanted - 1) // 10
        assert low <= at <= high
        assert above == 10 * (999 - high)


def test_places_follow_the_order(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("score"), "id")
    places = [r.id for r in numbered(rows, [F.desc("score"), F.asc("id")], "test").orderBy("place").collect()]
    assert places == sorted(range(1000), key=lambda k: (-(k % 7), k))


def test_counts_cover_all_rows(documents):
    texts = [r.text for r in documents.select("text").collect()]
    assert bucket_counts(documents).sum() == sum(len(words_of(t)) for t in texts)


def test_drawn_documents_keep_their_columns(documents):
    result = resampled(documents, documents)
    drawn = drawn_documents(documents, result)
    assert drawn.columns == documents.columns
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in result.where("rank IS NOT NULL").collect()}
