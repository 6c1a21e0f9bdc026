from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import suffix_family as module
from strata.llm.suffix_family import Family, removed, repeats, segments, sliding_min, without
from tests.llm.conftest import EXTRA, SCHEMA, text_pairs


def brute_force(pairs, length=200):
    texts = [(i, t.encode()) for i, t in pairs]
    counts = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    rows = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if counts[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        rows.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(rows)


def found(docs, **how):
    return Counter(map(tuple, repeats(docs, **how).collect()))


def planted(seed=3):
    """Passages of all lengths around the limit inside unlike texts, near copies, runs of one letter, periods."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh ié") for _ in range(draw.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [prose(draw.randrange(1, 200)) for _ in range(30)]
    for size in (150, 197, 198, 199, 200, 201, 202, 230, 400, 1500):
        passage = prose(size)[:size]
        texts += [prose(draw.randrange(0, 60)) + passage + prose(draw.randrange(0, 60)) for _ in range(3)]
    common = prose(40)[:215]
    texts += [prose(5) + common[:k] + prose(3) + common + prose(9) for k in range(0, 215, 7)]
    long = prose(500)
    for _ in range(6):
        words = long.split(" ")
        for _ in range(draw.randrange(0, 9)):
            words[draw.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += ["a" * 500, "a" * 199, "b" * 200 + "a" * 200, "ab" * 300, "abc" * 200, long, long, common, common + common, "é" * 150]
    return list(enumerate(texts))


@pytest.fixture
def docs(spark):
    rows = [(i, t, None, None, None) + EXTRA for i, t in planted()]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("batches, group", [(4, 64), (7, 1), (1, 3)])
def test_planted_repeats(docs, batches, group):
    assert found(docs, batches=batches, group=group) == brute_force(text_pairs(docs))


@pytest.mark.parametrize("length", [41, 60])
def test_other_lengths(docs, length):
    assert found(docs, length=length) == brute_force(text_pairs(docs), length)


def test_texts_longer_than_a_block(docs, monkeypatch):
    """Parts of a text end at different places of equal passages. Tasks of the session have the usual block."""
    monkeypatch.setattr(module, "BLOCK", 300)
    texts = [t.encode() for _, t in planted()]
    spans = segments(texts)
    covered = sorted((o, s + k) for o, s, n in zip(spans["owner"].tolist(), spans["start"].tolist(), spans["strings"].tolist()) for k in range(n))
    assert covered == [(o, k) for o, t in enumerate(texts) for k in range(len(t) - 199)]


def test_equal_strings_have_equal_beginnings():
    texts = [t.encode() for _, t in planted(5)]
    spans, at = segments(texts), {}
    for o, key, s, n, offset in zip(*(spans[c].tolist() for c in ("owner", "key", "start", "strings", "offset"))):
        for k in range(n):
            at.setdefault(texts[o][s + k : s + k + 200], set()).add((key, offset - k))
    assert all(len(keys) == 1 for keys in at.values())


def test_odd_rows(odd):
    assert found(odd) == brute_force(text_pairs(odd))


def test_documents(documents):
    some = documents.where("length(text) < 6000")
    assert found(some) == brute_force(text_pairs(some))


def test_empty_and_short_tables(spark, empty):
    assert repeats(empty).collect() == []
    short = spark.createDataFrame([(1, "short"), (2, "short"), (None, None)], "doc_id long, text string")
    assert found(short) == brute_force([(1, "short"), (2, "short"), (None, "")])


def test_kept_text_is_what_is_hashed(docs):
    rows = repeats(docs, keep_text=True).collect()
    assert any(r.n_removed for r in rows)
    assert all(hashlib.sha256(r.kept_text).hexdigest() == r.kept_sha256 and len(r.kept_text) == r.n_bytes - r.n_removed for r in rows)


def test_levels_are_digits_of_a_counter(docs, spark):
    family, sizes = Family(), []
    parts = docs.randomSplit([1.0] * 7, 3)
    for part in parts:
        family.add(part)
        sizes.append([level.batches for level in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    keys = Counter(r.key for level in family.levels for r in level.rows().collect())
    assert keys.keys() == set(segments([t.encode() for _, t in text_pairs(docs)])["key"].tolist())
    plan = module._merged(family.levels[0], family.levels[1], "full")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    family.drop()
    assert family.levels == []


def test_a_batch_is_matched_with_what_came_before(docs):
    parts, family, seen = docs.randomSplit([1.0] * 5, 1), Family(), Counter()
    for part in parts:
        keys = Counter(segments([t.encode() for _, t in text_pairs(part)])["key"].tolist())
        matched = {r.key for r in family.add(part).collect()}
        assert matched == {k for k, n in keys.items() if n > 1 or seen[k]}
        seen += keys
    family.drop()


def test_parts():
    values = np.random.default_rng(0).integers(0, 1 << 60, 57).astype(np.uint64)
    for width in (1, 5, 57):
        assert sliding_min(values, width).tolist() == [min(values[k : k + width].tolist()) for k in range(58 - width)]
    assert removed(np.array([30, 0, 10, 3]), np.array([5, 2, 1, 1]), 10) == [(0, 20), (30, 44)]
    assert removed(np.array([], int), np.array([], int), 10) == []
    assert without(b"0123456789", [(2, 4), (9, 10)]) == b"0145678"
