"""Token counts by a linear longest-match automaton.

Greedy word pieces take, again and again, the longest vocabulary entry that begins the rest of a word. The
automaton finds how many pieces that gives without building or re-reading any: it is the trie of the
vocabulary, and every node has a failure link to the node reached after the pieces that must be popped
when no entry continues, together with their precomputed number. One pass over a word follows children
and links, so time grows linearly with its length.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import pieces, utf8, whole_text

#: Words whose counts a worker remembers.
REMEMBERED = 400_000
#: Longer words are counted but not remembered.
LONGEST = 256
SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long, longest_word_tokens long"


class LongestMatch:
    """Greedy longest-match piece counts over byte strings.

    A word that greedy matching cannot cover counts as one unknown token, as in word-piece vocabularies.
    """

    def __init__(self, entries: Iterable[bytes]) -> None:
        self.children: list[dict[int, int]] = [{}]
        entry = [False]
        for word in entries:
            node = 0
            for byte in word:
                below = self.children[node].get(byte)
                if below is None:
                    below = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    entry.append(False)
                node = below
            entry[node] = bool(word)
        self._link(entry)

    def _link(self, entry: list[bool]) -> None:
        """Failure links and popped-piece counts, nodes nearer to the root first; -1 means no way on."""
        n = len(self.children)
        self.fail, self.popped = [-1] * n, [0] * n
        level = [0]
        while level:
            following = []
            for node in level:
                for byte, child in self.children[node].items():
                    following.append(child)
                    if entry[child]:
                        self.fail[child], self.popped[child] = 0, 1
                        continue
                    z, count = self.fail[node], self.popped[node]
                    while z >= 0 and byte not in self.children[z]:
                        count += self.popped[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[child], self.popped[child] = self.children[z][byte], count
            level = following

    def count(self, word: bytes) -> int:
        """Number of pieces, or -1 if greedy matching cannot cover the word."""
        children, fail, popped = self.children, self.fail, self.popped
        node = total = 0
        for byte in word:
            while (below := children[node].get(byte)) is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = below
        while node:
            total += popped[node]
            node = fail[node]
            if node < 0:
                return -1
        return total


def ranked_entries(lines: Iterable[str]) -> list[bytes]:
    """Entries of a rank file: one base64 text and its rank per line."""
    return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@functools.cache
def automaton(path: str) -> tuple[LongestMatch, dict[bytes, int]]:
    """The automaton of a vocabulary file and the word counts found so far, once per worker process."""
    with open(path, encoding="ascii") as file:
        return LongestMatch(ranked_entries(file)), {}


def word_counts(words: list[bytes], match: LongestMatch, known: dict[bytes, int], marker: bytes) -> list[int]:
    missing = set(words).difference(known)
    if len(known) + len(missing) > REMEMBERED:
        known.clear()
        missing = set(words)
    known.update((word, match.count(marker + word)) for word in missing)
    counts = list(map(known.__getitem__, words))
    for word in missing:
        if len(word) > LONGEST:
            del known[word]
    return counts


def _counted(path: str, marker: bytes):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match, known = automaton(path)
        for batch in batches:
            for part in pieces(batch):
                rows = []
                for text in utf8(part.column("text")):
                    counts = np.array(word_counts(text.split(), match, known, marker), np.int64)
                    unknown = int((counts < 0).sum())
                    rows.append((len(counts), int(np.abs(counts).sum()), unknown, int(np.abs(counts).max(initial=0))))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                names = [field.split()[0] for field in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    return counted


def token_counts(docs: DataFrame, vocabulary: str, marker: bytes = b" ") -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown and longest_word_tokens for every row.

    Words are runs of characters other than blank, tab, newline and their kin; each is matched with the
    vocabulary's word-start marker before it. An unknown word counts as one token. Null counts as empty and
    gives zeros; repeated rows give repeated results; rows without an id keep it null; an empty table gives
    an empty result; columns other than doc_id and text are not read. ``vocabulary`` is a rank file that
    every worker can open.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(_counted(vocabulary, marker), SCHEMA)
