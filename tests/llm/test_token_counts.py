from __future__ import annotations

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.token_counts import LongestMatch, ranked_entries, token_counts, word_counts
from tests.conftest import rows_of
from tests.llm.conftest import LONG, text_pairs

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def greedy(word, entries, longest):
    """Pieces by trying every length from the longest; -1 if stuck."""
    at = n = 0
    while at < len(word):
        for size in range(min(longest, len(word) - at), 0, -1):
            if word[at : at + size] in entries:
                break
        else:
            return -1
        at, n = at + size, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12), st.data())
def test_counts_equal_greedy_matching(entries, data):
    word = bytes(97 + x % 3 for x in data.draw(st.binary(max_size=30)))
    assert LongestMatch(entries).count(word) == greedy(word, entries, 5)


@pytest.fixture(scope="module")
def entries():
    with open(VOCABULARY) as file:
        return set(ranked_entries(file))


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_documents_equal_greedy_matching(request, entries, name):
    docs = request.getfixturevalue(name)
    known, longest, out = {}, max(map(len, entries)), []
    for doc_id, text in text_pairs(docs):
        words = text.encode().split()
        for w in words:
            if w not in known:
                known[w] = greedy(b" " + w, entries, longest)
        counts = [known[w] for w in words]
        out.append((doc_id, len(words), sum(map(abs, counts)), sum(c < 0 for c in counts), max(map(abs, counts), default=0)))
    assert rows_of(token_counts(docs, VOCABULARY)) == sorted(out, key=repr)


def test_unknown_words_count_once_and_long_words_are_not_remembered():
    match, known = LongestMatch([b" a", b"a", b"b", b"ab"]), {}
    assert word_counts([b"ab", b"x", b"a" * 300, b"ab"], match, known, b" ") == [2, -1, 300, 2]
    assert set(known) == {b"ab", b"x"}


def test_work_grows_linearly_with_a_word():
    """Words made to pop as often as possible take a bounded number of steps per byte."""

    class Counted(dict):
        looked = 0

        def get(self, key):
            Counted.looked += 1
            return super().get(key)

    match = LongestMatch([b"a" * k for k in range(1, 40)] + [b"a" * 60 + b"b"])
    match.children = [Counted(c) for c in match.children]
    steps = []
    for n in (2000, 4000):
        Counted.looked = 0
        assert match.count(b"a" * n) == greedy(b"a" * n, {b"a" * k for k in range(1, 40)}, 39)
        steps.append(Counted.looked)
    assert steps[1] <= 2.1 * steps[0]


def test_empty_table(empty):
    assert token_counts(empty, VOCABULARY).collect() == []
