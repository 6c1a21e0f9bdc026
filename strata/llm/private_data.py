"""Personal data in whole texts, in the clear and in disguise, with spans in the source text.

The clear kinds are found by their patterns. For disguised ones a transducer rewrites the text: look-alike
letters and foreign digits become plain ones, invisible characters vanish, spelled digits become digits,
and spelled or bracketed "at" and "dot" become signs. It remembers for every stretch of its output where it
came from, so what the same patterns find in the output maps back to spans of the source. Only stretches
round something to rewrite are read by it: they end where no pattern can go on, so the result is that of the
whole text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import pieces, whole_text

#: The kinds in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def emails(text: str) -> Iterator[Span]:
    """Anchored on the signs, so a long run of letters is read once: left to the run's begin, right by pattern."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def ips(text: str) -> Iterator[Span]:
    for found in IP.finditer(text):
        parts = (part.lstrip("0") or "0" for part in found[0].split("."))
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            yield found.span()


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for k, v in enumerate(values)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 14:
            digits = found[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for found in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, found[0])) <= 15:
                yield found.span()


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))


def clear_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what stands in the clear, in order."""
    if "@" not in text and not DIGIT.search(text):
        return []
    return sorted((a, k, b) for k, kind in enumerate(KINDS) for a, b in FINDERS[kind](text))


#: Letters that look like plain ones, each above its plain form.
LOOKALIKE = "АВЕКМНОРСТХаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονı"
PLAINFORM = "ABEKMHOPCTXaeopcyxijsdqwABEZHIKMNOPTYXovi"
INVISIBLE = "​‌‍⁠﻿­"
FULLWIDTH = {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}
FOREIGN_DIGITS = {chr(zero + d): str(d) for zero in (0x660, 0x6F0, 0x966, 0x9E6, 0x1D7CE, 0x1D7EC) for d in range(10)}
CHARACTERS = dict(zip(LOOKALIKE, PLAINFORM)) | dict.fromkeys(INVISIBLE, "") | FULLWIDTH | FOREIGN_DIGITS
#: Spelled digits in English, German, French and Spanish, from 0 to 9.
SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
NUMBERS = {word: str(digit) for words in SPELLED for digit, word in enumerate(words.split())}

ODD = re.compile("[%s]" % re.escape("".join(CHARACTERS)))
NUMBER = "(?:%s)" % "|".join(NUMBERS)
# Blanks are read from the begin of their run only, so long runs are read once.
BRACKETED = r"(?<!\s)\s*[\[({{<]\s*(?:{})\s*[\])}}>]\s*"
DOT = rf"(?:{BRACKETED.format(r'dot|\.')}|(?<!\s)\s+dot\s+)"
SIGNED = re.compile(r"[\[({<]\s*(?:at|@|dot|\.)\s*[\])}>]|\s@\s", re.I)
#: Words that the transducer may rewrite; re.I also takes the long s and the i's without or with a dot.
WORDS, FOLDED = ("dot", "plus", *NUMBERS), str.maketrans("ſıİ", "sii")
UNICODE_WORD = re.compile(r"[^\W\d_]+")
#: Words that go on to what stands before and after them.
LINKS = frozenset(("at", *WORDS))
LAST_WORD, FIRST_WORD = re.compile(r"[^\W\d_]{2,8}\Z"), re.compile(r"[^\W\d_]{2,8}(?![^\W\d_])")
#: Characters after or before which a pattern may go on through blanks: always, or if both sides are such.
SIGNS, NUMERIC = frozenset("[](){}<>@"), frozenset("0123456789().-+,") | CHARACTERS.keys()
#: What the transducer rewrites, tried in this order at every place.
REWRITE = re.compile(
    rf"(?P<at>{BRACKETED.format('at|@')}|(?<=[a-z0-9])\s+at\s+(?=[a-z0-9.-]+{DOT}[a-z0-9-])"
    rf"|(?<=[a-z0-9])\s+@\s+(?=[a-z0-9-]+(?:\.|{DOT})[a-z]{{2}}))"
    rf"|(?P<dot>{DOT})"
    rf"|(?P<plus>\bplus\s+(?=[0-9]|{NUMBER}\b))"
    rf"|(?P<number>\b{NUMBER}\b(?P<gap>[\s,-]+(?={NUMBER}\b))?)"
    rf"|(?P<odd>(?-i:{ODD.pattern}))",
    re.I,
)


NAMED = re.compile(r"\.[A-Za-z]{2,}\Z")


def is_disguised(text: str) -> bool:
    """Whether the transducer would rewrite anything."""
    return any(REWRITE.search(text, *window) for window in windows(text))


def anchors(text: str) -> list[int]:
    """Places of all that the transducer may rewrite, in order: whole words, signs and odd characters."""
    places, words = [], _words(text)
    low = text.translate(FOLDED).lower() if words else ""
    for word in words:
        at = low.find(word)
        while at >= 0:
            if not _in_word(text, at - 1) and not _in_word(text, at + len(word)):
                places.append(at)
            at = low.find(word, at + len(word))
    if "@" in text or any(map(text.__contains__, "[({<")):
        places += [found.start() for found in SIGNED.finditer(text)]
    if not text.isascii():
        places += [found.start() for found in ODD.finditer(text)]
    return sorted(places)


#: Lower-cases A-Z and turns every other ASCII character that no word holds into a blank.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b == 95 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
ENCODED, REWRITTEN = {word.encode(): word for word in WORDS}, frozenset(WORDS)


def _words(text: str) -> set[str]:
    """Which of the words stand in a text as words of their own, or a few more."""
    words = set(text.encode("utf-8", "surrogatepass").translate(PLAIN).split())
    found = {ENCODED[w] for w in ENCODED.keys() & words}
    if not text.isascii():
        odd = b" ".join(w for w in words if not w.isascii())
        found |= REWRITTEN.intersection(UNICODE_WORD.findall(odd.decode("utf-8", "surrogatepass").translate(FOLDED).lower()))
    return found


def _in_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def windows(text: str) -> Iterator[Span]:
    """Stretches between blanks that no pattern crosses, each with something to rewrite, in order."""
    done = 0
    for place in anchors(text):
        if place >= done:
            begin = end = place
            while begin := _token_begin(text, begin):
                before = begin
                while before and text[before - 1].isspace():
                    before -= 1
                if not before:
                    begin = 0
                elif not _goes_on(text, before, begin):
                    break
                else:
                    begin = before
            while (end := _token_end(text, end)) < len(text):
                after = end
                while after < len(text) and text[after].isspace():
                    after += 1
                if after < len(text) and not _goes_on(text, end, after):
                    break
                end = after
            yield begin, end
            done = end


def _token_begin(text: str, at: int) -> int:
    while at and not text[at - 1].isspace():
        at -= 1
    return at


def _token_end(text: str, at: int) -> int:
    while at < len(text) and not text[at].isspace():
        at += 1
    return at


def _goes_on(text: str, end: int, begin: int) -> bool:
    """Whether a pattern may go on from the token that ends at ``end`` to the one that begins at ``begin``."""
    left, right = text[end - 1], text[begin]
    if left in SIGNS or right in SIGNS or (left in NUMERIC and right in NUMERIC):
        return True
    # Of a word that stands at the joint, with at most one sign between.
    last = LAST_WORD.search(text, max(0, end - 12), end if left.isalpha() else end - 1)
    first = FIRST_WORD.match(text, begin if right.isalpha() else begin + 1, begin + 12)
    return any(found is not None and found[0].translate(FOLDED).lower() in LINKS for found in (last, first))


class Rewritten:
    """Output of the transducer and where its stretches came from."""

    def __init__(self, text: str, begin: int = 0, end: int | None = None) -> None:
        parts: list[str] = []
        # Output and source positions at which stretches begin; rewritten stretches also keep their source end.
        self.outs: list[int] = []
        self.sources: list[tuple[int, int | None]] = []
        size, done, end = 0, begin, len(text) if end is None else end

        def put(part: str, source: int, end: int | None) -> None:
            nonlocal size
            if part:
                self.outs.append(size)
                self.sources.append((source, end))
                parts.append(part)
                size += len(part)

        for found in REWRITE.finditer(text, begin, end):
            put(text[done : found.start()], done, None)
            put(self._form(found), *found.span())
            done = found.end()
        put(text[done:end], done, None)
        self.text = "".join(parts)

    @staticmethod
    def _form(found: re.Match) -> str:
        kind = found.lastgroup if found.lastgroup != "gap" else "number"
        if kind == "number":
            return NUMBERS[re.match(r"[^\W\d_]+", found["number"].translate(FOLDED).lower())[0]]
        if kind == "odd":
            return CHARACTERS.get(found[0], found[0])
        return {"at": "@", "dot": ".", "plus": "+"}[kind]

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of an output span, and whether anything in it was rewritten."""
        first, last = bisect_right(self.outs, start) - 1, bisect_right(self.outs, end - 1) - 1
        begin, ended = self.sources[first]
        if ended is None:
            begin += start - self.outs[first]
        origin, stop = self.sources[last]
        if stop is None:
            stop = origin + end - self.outs[last]
        changed = any(self.sources[k][1] is not None for k in range(first, last + 1))
        hidden = any(
            a[1] != b[0] if a[1] is not None else a[0] + (self.outs[k + 1] - self.outs[k]) != b[0]
            for k, (a, b) in enumerate(zip(self.sources[first:last], self.sources[first + 1 : last + 1]), first)
        )
        return begin, stop, changed or hidden


def disguised_spans(text: str, clear: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what only the rewritten text shows; parts of clear spans are left out."""
    added: set[tuple[int, int, int]] = set()
    for window in windows(text):
        rewritten = Rewritten(text, *window)
        for kind, name in enumerate(KINDS):
            found = [(*rewritten.source(*span), span) for span in FINDERS[name](rewritten.text)]
            known = [(a, b) for a, k, b in clear if k == kind and a < window[1] and b > window[0]] if found else []
            for begin, end, changed, span in found:
                while end > begin and text[end - 1].isspace():
                    end -= 1
                if kind == 0 and not NAMED.search(rewritten.text, *span):
                    continue  # a spelled-out address names its top domain
                if changed and not any(a <= begin and end <= b for a, b in known):
                    added.add((begin, kind, end))
    return sorted(added)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for begin, kind, end in spans)


FIELDS = ("n_email", "n_ip", "n_card", "n_phone")
SCHEMA = "doc_id long, " + ", ".join(f"{f} long" for f in FIELDS) + ", base_sha256 string, spans string, n_added long"


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    for batch in batches:
        for part in pieces(batch):
            rows = []
            for text in part.column("text").to_pylist():
                clear = clear_spans(text)
                added = disguised_spans(text, clear)
                counts = [sum(k == kind for _, k, _ in clear) for kind in range(len(KINDS))]
                digest = hashlib.sha256(joined(clear).encode()).hexdigest()
                rows.append((*counts, digest, joined(sorted({*clear, *added})), len(added)))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data in every row's whole text.

    n_email, n_ip, n_card and n_phone count what stands in the clear and base_sha256 digests its spans;
    ``spans`` also holds the ``n_added`` disguised ones. Spans are kind:start:end in code points, end
    exclusive, by start and then kind. Null counts as empty and gives zeros, the digest of the empty string
    and no spans; repeated rows give repeated results; rows without an id keep it null; an empty table gives
    an empty result; columns other than doc_id and text are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(_found, SCHEMA)


def redact(text: str) -> str:
    """The text with every span, clear or disguised, replaced by its kind in brackets."""
    clear = clear_spans(text)
    out, done = [], 0
    for begin, kind, end in sorted({*clear, *disguised_spans(text, clear)}):
        if begin >= done:
            out += [text[done:begin], f"[{KINDS[kind]}]"]
            done = end
        else:
            done = max(done, end)
    return "".join(out) + text[done:]
