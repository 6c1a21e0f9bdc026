from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.private_data import (
    FINDERS,
    KINDS,
    NAMED,
    REWRITE,
    Rewritten,
    clear_spans,
    disguised_spans,
    is_disguised,
    joined,
    personal_data,
    redact,
)
from tests.conftest import rows_of
from tests.llm.conftest import text_pairs

#: The patterns as they are defined, tried by the library from left to right.
DEFINED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return 10 <= len(digits) <= 15 if kind == "phone" else True


def defined(text):
    return sorted(
        (m.start(), k, m.end()) for k, kind in enumerate(KINDS) for m in re.finditer(DEFINED[kind], text) if holds(kind, m[0])
    )


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a.@-+0159 ()é%", max_size=40))
def test_clear_spans_equal_the_patterns(text):
    assert clear_spans(text) == defined(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111-1111 1111", "1.2.3.4", "999.1.1.1", "+1 (555) 123-4567", "a@b.c", "@", "x@y", ".z", " ", "7", "-", "+", "é"]), max_size=8))
def test_clear_spans_of_joined_parts(parts):
    text = "".join(parts)
    assert clear_spans(text) == defined(text)


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("write to john dot doe at example dot com now", "email", "john dot doe at example dot com"),
        ("john [at] example.com", "email", "john [at] example.com"),
        ("mail: a_b (at) mail (dot) example (dot) org!", "email", "a_b (at) mail (dot) example (dot) org"),
        ("jоhn@exаmple.com ok", "email", "jоhn@exаmple.com"),
        ("call plus one five five five one two three four five six seven please", "phone", "plus one five five five one two three four five six seven"),
        ("card four one one one one one one one one one one one one one one one end", "card", "four one one one one one one one one one one one one one one one"),
        ("at 10 dot 0 dot 0 dot 1 end", "ip", "10 dot 0 dot 0 dot 1"),
        ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("reach john.doe @ example dot com today", "email", "john.doe @ example dot com"),
        ("reach john @ example.com today", "email", "john @ example.com"),
        ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
        ("a@b[.]com", "email", "a@b[.]com"),
        ("ab​c@d.com x", "email", "ab​c@d.com"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, span):
    found = [(KINDS[k], text[a:b]) for a, k, b in disguised_spans(text, clear_spans(text))]
    assert found == [(kind, span)]
    for before in ("", "é ", "x y. "):
        shifted = disguised_spans(before + text, clear_spans(before + text))
        assert [(a - len(before), k, b - len(before)) for a, k, b in shifted] == disguised_spans(text, clear_spans(text))


@pytest.mark.parametrize(
    "text",
    [
        "meet me at home.Then go",
        "he was at one two three four places dot dot dot",
        "one of the two at the dots in three four five words",
        "a.b@c.de and 1.2.3.4",
        "plain text without anything",
        "two for @ 5 . and then . so on",
        "ends here . Another one @ last",
        "",
    ],
)
def test_clean_and_clear_texts_gain_nothing(text):
    assert disguised_spans(text, clear_spans(text)) == []


def test_clear_spans_stay_beside_disguised_ones():
    text = "a@b.co and c at d dot com"
    clear = clear_spans(text)
    assert joined(sorted({*clear, *disguised_spans(text, clear)})) == "email:0:6,email:11:25"
    assert redact(text) == "[email] and [email]"


def test_work_grows_linearly_with_runs():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1((" * 75_000, "a@" * 150_000, "one " * 60_000, "x at y " * 40_000 + " dot ", "a dot b" + " " * 200_000 + "dot" + "\t" * 200_000):
        clear_spans(text)
        disguised_spans(text, [])


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_documents_equal_the_patterns(request, name):
    docs = request.getfixturevalue(name)
    out = []
    for doc_id, text in text_pairs(docs):
        clear = defined(text)
        counts = [sum(k == kind for _, k, _ in clear) for kind in range(4)]
        added = disguised_spans(text, clear)
        digest = hashlib.sha256(joined(clear).encode()).hexdigest()
        out.append((doc_id, *counts, digest, joined(sorted({*clear, *added})), len(added)))
    assert rows_of(personal_data(docs)) == sorted(out, key=repr)


def test_empty_table(empty):
    assert personal_data(empty).collect() == []


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("call plus 1 415 555 0100", "phone", "plus 1 415 555 0100"),
        ("card four,one,one,one,one,one,one,one,one,one,one,one,one,one,one,one end", "card", "four,one,one,one,one,one,one,one,one,one,one,one,one,one,one,one"),
        ("card four\n" + "\t".join(["one"] * 15), "card", "four\n" + "\t".join(["one"] * 15)),
        ("card 4111 1111 1111 11 one one end", "card", "4111 1111 1111 11 one one"),
        ("fıve five five ſix", None, None),
    ],
)
def test_a_disguise_is_found_on_its_own(text, kind, span):
    found = [(KINDS[k], text[a:b]) for a, k, b in disguised_spans(text, clear_spans(text))]
    assert found == ([(kind, span)] if kind else [])
    beside = text + " ; [.]"
    assert [(KINDS[k], beside[a:b]) for a, k, b in disguised_spans(beside, clear_spans(beside))] == found


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(["one", "ſix", "FİVE", "plus", "at", "dot", "DOT", "@", ".", "[", ")", "x", " ", "\n", ",", "-", "1", "е", "K"]), max_size=7))
def test_the_quick_look_asks_for_no_more_than_the_transducer(parts):
    text = "".join(parts)
    assert is_disguised(text) == (REWRITE.search(text) is not None)


def spans_of_the_whole(text, clear):
    """The transducer over the whole text at once."""
    rewritten, added = Rewritten(text), set()
    for kind, name in enumerate(KINDS):
        for span in FINDERS[name](rewritten.text):
            begin, end, changed = rewritten.source(*span)
            while end > begin and text[end - 1].isspace():
                end -= 1
            named = kind > 0 or NAMED.search(rewritten.text, *span)
            if changed and named and not any(k == kind and a <= begin and end <= b for a, k, b in clear):
                added.add((begin, kind, end))
    return sorted(added)


PARTS = ["one", "ſix", "FİVE", "fünf", "zéro", "uno", "plus", "at", "dot", "DOT", "@", ".", "[", "]", "(", ")", "x", "ab", "word", " ", "  ", "\n", ",", "-", "+", "1", "41", "4111 1111", "е", "K", "é", "com", "a@b.c", "1.2.3", "\u200b", "_"]


@settings(max_examples=4000, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30))
def test_windows_give_what_the_whole_text_gives(parts):
    text = "".join(parts)
    assert disguised_spans(text, clear_spans(text)) == spans_of_the_whole(text, clear_spans(text))


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([*PARTS, "four one one one", "example dot com", "one nine two dot one", "john at", "+ 1 (555)", "plus one five five five"]), max_size=25))
def test_windows_of_spaced_parts(parts):
    text = " ".join(parts)
    assert disguised_spans(text, clear_spans(text)) == spans_of_the_whole(text, clear_spans(text))


@pytest.mark.parametrize(
    "digits",
    [
        "vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins",
        "quatre un un un un un un un un un un un un un un un",
        "cuatro uno uno uno uno uno uno uno uno uno uno uno uno uno uno uno",
    ],
)
def test_spelled_digits_of_other_languages(digits):
    text = f"so {digits} da"
    assert [(KINDS[k], text[a:b]) for a, k, b in disguised_spans(text, [])] == [("card", digits)]


def test_documents_give_what_the_whole_text_gives(documents):
    for _, text in text_pairs(documents):
        assert disguised_spans(text, clear_spans(text)) == spans_of_the_whole(text, clear_spans(text))
