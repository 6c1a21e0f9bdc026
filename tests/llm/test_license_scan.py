from __future__ import annotations

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.license_scan import (
    LEAST_WORDS,
    LicenseScanner,
    SuffixAutomaton,
    all_chains,
    best_chain,
    cut,
    default_scanner,
    license_scan,
    words_of,
)
from strata.llm.license_texts import PASSAGES, PHRASES
from tests.conftest import rows_of
from tests.llm.conftest import text_pairs

words = st.lists(st.integers(0, 2), max_size=9)


@settings(max_examples=400, deadline=None)
@given(st.lists(words, min_size=1, max_size=4))
def test_automaton_knows_exactly_the_stretches_and_their_ends(sequences):
    automaton = SuffixAutomaton(sequences)
    stretches = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a, len(s) + 1)}
    for size in range(5):
        for k in range(3**size):
            stretch = tuple(k // 3**d % 3 for d in range(size))
            state = 0
            for word in stretch:
                state = automaton.next[state].get(word) if state is not None else None
            assert (state is not None) == (stretch in stretches or not stretch)
            if state:
                ends = {(n, e) for n, s in enumerate(sequences) for e in range(size, len(s) + 1) if tuple(s[e - size : e]) == stretch}
                assert automaton.ends[state] == ends


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=4), min_size=1, max_size=4))
def test_phrases_are_found_at_all_places(text, phrases):
    phrases = {" ".join(p): f"L{k}" for k, p in enumerate(phrases)}
    found = LicenseScanner(phrases, {"p": "a b a b c c a b"}).scan(" ".join(text).encode())
    expected = sorted(
        (k, label) for phrase, label in phrases.items() for k in range(len(text)) if text[k : k + len(phrase.split())] == phrase.split()
    )
    assert sorted(found.places) == expected


def brute_force(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(found)) if found[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return (len(found), len(places), min(starts, default=None), max(starts, default=None), labels)


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_base_columns_equal_brute_force(request, name):
    docs = request.getfixturevalue(name)
    rows = license_scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert rows_of(rows) == sorted(((i, *brute_force(t)) for i, t in text_pairs(docs)), key=repr)


@pytest.mark.parametrize("label", list(PASSAGES))
def test_passages_are_found_through_changes(label):
    draw, passage = random.Random(1), PASSAGES[label].split()
    around = [f"filler{k}" for k in range(300)]
    changed = list(passage)
    for k in range(11, len(changed) - 6, 17):
        changed[k] = "edited"
    scan = default_scanner().scan(" ".join([*around, *changed, *around]).encode())
    spans = {name: (a, b, share) for a, b, name, share in scan.spans}
    a, b, share = spans[label]
    assert share >= 0.5 and 300 <= a and b <= 300 + len(words_of(" ".join(changed).encode()))
    draw.shuffle(changed)
    assert label not in {name for *_, name, _ in default_scanner().scan(" ".join(changed).encode()).spans}


def test_score_is_the_share_covered(spark):
    half = " ".join(PASSAGES["isc"].split()[:20])
    rows = [(1, "the MIT License"), (2, PASSAGES["isc"]), (3, half), (4, "nothing"), (5, None)]
    found = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [round(found[k].score, 2) for k in (1, 2, 4, 5)] == [1.0, 1.0, 0.0, 0.0]
    assert 0.5 <= found[3].score < 1
    assert [found[k].labels for k in (1, 2, 3, 4)] == ["mit", "isc", "isc", ""]
    assert found[2].base_labels == "" and found[2].spans.startswith("isc:0:")


def test_chain_keeps_the_order_of_text_and_passage():
    assert best_chain([(0, 5, 5), (5, 9, 20), (9, 14, 12), (14, 20, 19)], 20) == (16, 0, 20)
    assert best_chain([(0, 6, 20), (6, 12, 6)], 20) == (6, 0, 6)


def test_empty_table(empty):
    assert license_scan(empty).collect() == []


@pytest.mark.parametrize("label", list(PASSAGES))
def test_every_copy_of_a_passage_has_its_span(label):
    passage = PASSAGES[label].split()
    size = len(words_of(PASSAGES[label].encode()))
    first, second = list(passage), list(passage)
    first[len(passage) * 3 // 4], second[len(passage) // 4] = "edited", "edited"
    for between in ([], ["filler"] * 400):
        scan = default_scanner().scan(" ".join([*first, *between, *second, *between, *passage]).encode())
        spans = sorted((a, b) for a, b, name, _ in scan.spans if name == label)
        assert len(spans) == 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert all(b - a <= size + 2 for a, b in spans)


def test_scattered_fragments_make_no_span():
    words = words_of(PASSAGES["isc"].encode())
    parts = [words[k : k + 5] + [b"filler"] * 1000 for k in range(0, len(words) - 4, 5)]
    assert default_scanner().scan(b" ".join(w for p in parts for w in p)).spans == []


def one_after_another(found, size, gap, least):
    """The heaviest chain of the whole text, then the same before and after it."""
    covered, begin, end = best_chain(found, size, gap)
    if not covered or covered < least:
        return []
    last = max(b for _, b, _ in found)
    return [(covered, begin, end), *one_after_another(cut(found, 0, begin), size, gap, least), *one_after_another(cut(found, end, last), size, gap, least)]


@pytest.mark.parametrize("seed", range(300))
def test_chains_settled_on_the_way_are_the_heaviest_one_after_another(seed):
    """Copies of a passage with words left out, changed, moved or repeated, side by side or far apart."""
    draw = random.Random(seed)
    size, text, found, at = draw.randrange(12, 60), [], [], 0
    for _ in range(draw.randrange(1, 9)):
        a, at = 0, at + draw.choice((0, 0, 1, 3, size // 2, size, 2 * size))
        while a < size:
            n = draw.randrange(1, 25)
            b = min(size, a + n)
            if b - a >= LEAST_WORDS and draw.random() < 0.9:
                found.append((at, at + b - a, b))
            at += b - a + draw.choice((0, 1, 1, 4))
            a = b + draw.choice((0, 1, 1, 4, -3 if b < size else 0))
    expected = one_after_another(found, size, size, 0.5 * size)
    assert sorted(all_chains(found, size, size, 0.5 * size)) == sorted(expected)


@pytest.mark.parametrize("label", list(PASSAGES))
def test_many_copies_take_time_in_proportion(label):
    words = words_of(PASSAGES[label].encode())
    edited = [w if k % 13 else b"edited" for k, w in enumerate(words, 1)]
    for copy in (words, edited):
        text = b" ".join(copy * (400_000 // len(words)))
        started = time.perf_counter()
        spans = [s for s in default_scanner().scan(text).spans if s[2] == label]
        assert time.perf_counter() - started < 60
        assert len(spans) == 400_000 // len(words)
