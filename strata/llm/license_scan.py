"""Licence scan with a generalised suffix automaton of licence words.

One automaton holds every stretch of words of all phrases and passages. A text streams through it word by
word; the state always stands for the longest stretch that ends at the current word (the matching
statistics). A phrase ends where its state lies on the state's chain of suffixes. Long matches that cannot
be extended are chained, in the order of both text and passage, into spans that cover a passage.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import pieces, utf8, whole_text
from strata.llm.license_texts import PASSAGES, PHRASES

#: Words of a match that may become part of a chain, and the share of a passage that a chain must cover.
LEAST_WORDS, LEAST_COVER = 5, 0.5
#: Lengths of the passage that a chain may leave out of the text between two matches. From one copy into the next
#: is at least one, so a chain stays within a copy.
MOST_GAP = 1

#: Lower-cases A-Z and turns every other ASCII character but letters and digits into a blank.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class SuffixAutomaton:
    """All stretches of several word sequences; state 0 is the empty stretch."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: Where stretches of a state end: (sequence, words before the end).
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((number, at + 1))
        # Longer stretches end wherever their suffixes end too.
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, before: int, word: int) -> int:
        """The state of exactly one word more than ``before``, split off if it is shared by longer stretches."""
        below = self.next[before][word]
        if self.length[below] == self.length[before] + 1:
            return below
        copy = self._state(self.length[before] + 1)
        self.next[copy], self.link[copy] = dict(self.next[below]), self.link[below]
        self.link[below] = copy
        while before >= 0 and self.next[before].get(word) == below:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # another sequence has this stretch already
            return self._split(last, word)
        state, before = self._state(self.length[last] + 1), last
        while before >= 0 and word not in self.next[before]:
            self.next[before][word] = state
            before = self.link[before]
        if before >= 0:
            self.link[state] = self._split(before, word)
        return state

    def suffixes(self, state: int) -> Iterator[int]:
        while state > 0:
            yield state
            state = self.link[state]


@dataclass
class Scan:
    """What one text holds."""

    n_words: int
    places: list[tuple[int, str]] = field(default_factory=list)
    spans: list[tuple[int, int, str, float]] = field(default_factory=list)


class LicenseScanner:
    """Phrases and passages by label, compiled into one automaton."""

    def __init__(self, phrases: dict[str, str], passages: dict[str, str]) -> None:
        phrase_words = [words_of(p.encode()) for p in phrases]
        passage_words = [words_of(p.encode()) for p in passages.values()]
        vocabulary = sorted({w for sequence in phrase_words + passage_words for w in sequence})
        self.number = {w: k for k, w in enumerate(vocabulary)}
        coded = [[self.number[w] for w in sequence] for sequence in phrase_words + passage_words]
        self.automaton = SuffixAutomaton(coded)
        self.passages = {len(phrase_words) + k: (label, len(passage_words[k])) for k, label in enumerate(passages)}
        at_state: dict[int, list[tuple[int, str]]] = {}
        for sequence, label in zip(coded, phrases.values()):
            state = 0
            for word in sequence:
                state = self.automaton.next[state][word]
            at_state.setdefault(state, []).append((len(sequence), label))
        #: Phrases that may end at a state: (words, label).
        self.phrases = [
            tuple(p for s in self.automaton.suffixes(state) for p in at_state.get(s, ()))
            for state in range(len(self.automaton.next))
        ]

    def scan(self, text: bytes) -> Scan:
        words = words_of(text)
        result, matches = Scan(len(words)), []
        step, link, length_of = self.automaton.next, self.automaton.link, self.automaton.length
        state = length = 0
        for at, word in enumerate(map(self.number.get, words)):
            if word is None:
                if length:
                    if length >= LEAST_WORDS:
                        matches.append((at - length, at, state))
                    state = length = 0
                continue
            below = step[state].get(word)
            if below is None:
                if length >= LEAST_WORDS:
                    matches.append((at - length, at, state))
                while state and below is None:
                    state = link[state]
                    length = length_of[state]
                    below = step[state].get(word)
            if below is None:
                length = 0
                continue
            state, length = below, length + 1
            for size, label in self.phrases[state]:
                if size <= length:
                    result.places.append((at + 1 - size, label))
        if length >= LEAST_WORDS:
            matches.append((len(words) - length, len(words), state))
        if matches:
            result.spans = self._chains(matches)
        return result

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
        """(start, end, label, share of the passage) of all chains that cover enough of a passage."""
        by_passage: dict[int, list[tuple[int, int, int]]] = {}
        for start, end, state in matches:
            for number, stop in self.automaton.ends[state]:
                if number in self.passages:
                    by_passage.setdefault(number, []).append((start, end, stop))
        spans = []
        for number, found in sorted(by_passage.items()):
            label, size = self.passages[number]
            spans += [(begin, end, label, covered / size) for covered, begin, end in all_chains(found, size, MOST_GAP * size, LEAST_COVER * size)]
        return spans


Match = tuple[int, int, int]
Chain = tuple[int, int, int]


def by_end(found: list[Match]) -> list[Match]:
    return sorted(found, key=lambda m: (m[1], m[0], m[2]))


def cut(found: list[Match], begin: int, end: int) -> list[Match]:
    """The parts of matches inside a stretch of the text that still are long enough."""
    parts = [(max(a, begin), min(b, end), b, stop) for a, b, stop in found]
    return [(a, b, stop - (was - b)) for a, b, was, stop in parts if b - a >= LEAST_WORDS]


def all_chains(found: list[Match], size: int, gap: int, least: float) -> list[Chain]:
    """(words covered, start, end) of chains of at least ``least`` words: the heaviest, then the heaviest before and after it.

    A text is read once from left to right: a chain is settled as soon as no match to come can join a
    chain that overlaps it, which is a bounded stretch behind it, however many copies the text has.
    """
    chains, waiting = [], [by_end(found)]
    while waiting:
        rest = waiting.pop()
        soonest = [m[0] for m in rest]  # the first start from a match on
        for k in range(len(rest) - 2, -1, -1):
            soonest[k] = min(soonest[k], soonest[k + 1])
        first = after = 0
        while first < len(rest):
            (covered, begin, end), read = _heaviest(rest, soonest, first, after, size, gap)
            if not covered:
                break
            if covered >= least:
                chains.append((covered, begin, end))
                before = cut(rest[first:read], after, begin)
                if before:
                    waiting.append(by_end(before))
            after = end
            while first < len(rest) and rest[first][1] <= after:
                first += 1
    return chains


def best_chain(found: list[Match], size: int, gap: int | None = None) -> Chain:
    """(words covered, start, end) of the heaviest chain of (start, end, end in the passage).

    Matches of a chain follow each other without overlap in text and passage, and with less than ``gap`` words
    of text between them.
    """
    rest, endless = by_end(found), [-1] * len(found)
    return _heaviest(rest, endless, 0, 0, size, gap)[0]


def _heaviest(rest: list[Match], soonest: list[int], first: int, after: int, size: int, gap: int | None) -> tuple[Chain, int]:
    """The heaviest chain among matches from ``first`` on, read from ``after`` on until it is settled, and how many were read.

    ``best`` holds, per place of the passage, the chains that end there among matches that end before the
    current one begins: heavier ones first, and after them lighter ones that end later.
    """
    best: list[deque[Chain]] = [deque() for _ in range(size + 1)]
    waiting: list[tuple[int, int, Chain]] = []
    top, ready = (0, -1, -1), 0
    #: Where no chain so far can be carried on any more, and no chain that overlaps the heaviest one.
    everything = overlapping = 0
    for k in range(first, len(rest)):
        if top[0] and gap is not None and (top[0] == size or max(after, soonest[k]) >= overlapping):
            return top, k
        start, end, stop = rest[k]
        if start < after:
            start = after
            if end - start < LEAST_WORDS:
                continue
        while ready < len(waiting) and waiting[ready][0] <= start:
            _, place, chain = waiting[ready]
            while best[place] and best[place][-1][:2] <= chain[:2]:
                best[place].pop()
            best[place].append(chain)
            ready += 1
        before = (0, -1, -1)
        for chains in best[: max(0, stop - (end - start)) + 1]:
            while gap is not None and chains and start - chains[0][2] >= gap:
                chains.popleft()
            if chains and chains[0][:2] > before[:2]:
                before = chains[0]
        chain = (before[0] + end - start, before[1] if before[0] else start, end)
        waiting.append((end, stop, chain))
        expires = end + (gap or 0) if stop + LEAST_WORDS <= size else end
        everything = max(everything, expires)
        if chain[0] > top[0]:
            top, overlapping = chain, everything
        elif chain[1] < top[2]:
            overlapping = max(overlapping, expires)
    return top, len(rest)


@functools.cache
def default_scanner() -> LicenseScanner:
    return LicenseScanner(PHRASES, PASSAGES)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans string"
)


def _row(scan: Scan) -> tuple:
    starts = [start for start, _ in scan.places]
    base = {label for _, label in scan.places}
    labels = base | {label for _, _, label, _ in scan.spans}
    score = 1.0 if base else max((share for *_, share in scan.spans), default=0.0)
    return (
        scan.n_words,
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
        ",".join(f"{label}:{start}:{end}" for start, end, label, _ in sorted(scan.spans)),
    )


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = default_scanner()
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.string()]
    for batch in batches:
        for part in pieces(batch):
            rows = [_row(scanner.scan(text)) for text in utf8(part.column("text"))]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)


def license_scan(docs: DataFrame) -> DataFrame:
    """Licence phrases and passages of every row's whole text, in words from 0.

    n_base, first_word, last_word and base_labels tell where the phrases of PHRASES stand; labels adds the
    passages of which a chain of matches covers at least LEAST_COVER, ``spans`` says where (label:start:end,
    end exclusive, every copy of a passage on its own, less than MOST_GAP passages of other text between matches),
    and score is the largest share covered, 1 for a phrase. Null counts as empty and gives
    zeros, null positions and empty labels; repeated rows give repeated results; rows without an id keep
    it null; an empty table gives an empty result; columns other than doc_id and text are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(_scanned, SCHEMA)
