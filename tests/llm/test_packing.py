from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from strata.llm.packing import BITS, cut, hilbert, packed, piece_digests
from strata.llm.tokens import WordTokens
from tests.llm.conftest import text_pairs

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_every_id_lies_in_exactly_one_piece(request, tokenizer, name):
    docs = request.getfixturevalue(name)
    ids = Counter(
        (i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in text_pairs(docs)
    )
    rows = packed(docs, VOCABULARY).collect()
    open_rows, found = [r for r in rows], Counter()
    by_document = defaultdict(list)
    place = {(r.sequence_id, r.offset): r for r in open_rows}
    for r in open_rows:
        if r.start == 0:
            by_document[id(r)] = [r]
    for first in [r for r in open_rows if r.start == 0]:
        r, whole = first, first.ids
        while len(whole) < 4 * first.doc_tokens:
            r = place[(r.sequence_id + 1, 0)]
            assert (r.doc_id, r.start, r.doc_tokens) == (first.doc_id, len(whole) // 4, first.doc_tokens)
            whole += r.ids
        found[(first.doc_id, whole)] += 1
    assert found == ids
    filled = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id] and r.length == len(r.ids) // 4 > 0
        filled[r.sequence_id] += r.length
    assert sorted(filled) == list(range(len(filled)))
    sizes = [filled[k] for k in sorted(filled)]
    assert all(s == 4096 or s & (s - 1) == 0 and s < 4096 for s in sizes)


def test_digests(documents):
    ids = {(r.doc_id, r.start): r.ids for r in packed(documents, VOCABULARY).collect()}
    rows = piece_digests(packed(documents, VOCABULARY)).collect()
    assert {(r.doc_id, r.start): r.ids_crc32 for r in rows} == {k: zlib.crc32(v) for k, v in ids.items()}


def test_neighbours_on_the_curve_are_neighbours_in_space():
    points = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    order = np.argsort(hilbert(points, 3))
    assert sorted(hilbert(points, 3)) == list(range(512))
    assert (np.abs(np.diff(points[order], axis=0)).sum(1) == 1).all()
    assert hilbert(np.zeros((0, 4), int), BITS).shape == (0,)


def test_copies_lie_next_to_each_other(spark):
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choices("abcdefghij", k=5)) for _ in range(200)) for _ in range(40)]
    rows = [(k, texts[k % 40], "en", "a", 1) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    place = {r.doc_id: r.sequence_id * 4096 + r.offset for r in packed(docs, VOCABULARY).where("start = 0").collect()}
    order = sorted(place, key=place.get)
    assert sum(a % 40 == b % 40 for a, b in zip(order, order[1:])) >= 30


@pytest.mark.parametrize("total", [1, 4095, 4096, 4097, 9000, 3 * 4096])
def test_cut_covers_the_stream(total):
    at, used = 0, defaultdict(int)
    for n in [1, 2, 4095, 1, 3000, 10**6]:
        n = min(n, total - at)
        for start, size, sequence, offset in cut(at, n, total, 4096):
            assert offset == used[sequence]
            used[sequence] += size
        at += n
    assert sum(used.values()) == total


def test_ids_equal_the_library(tokenizer):
    words = WordTokens(VOCABULARY)
    odd = ["'ll's're!!'s --'t", "a\x0bb\x1cc d　e ﬁ ß İ", "\x00\x7f", "क्षि é", "x<|startoftext|>y <|", "a" * 300]
    odd += [a + chr(c) + b for c in range(0x20, 0x180) for a, b in (("", ""), ("a", "b"), ("1", "'s"))]
    for text in odd:
        assert np.frombuffer(words.ids(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(monkeypatch, tokenizer):
    from strata.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    words, text = WordTokens(VOCABULARY), "a b c d e f a b c d a e g h i a"
    assert np.frombuffer(words.ids(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_table(empty):
    assert packed(empty, VOCABULARY).collect() == []
