"""Token ids of whole texts with a vocabulary file of the ``tokenizers`` library.

Words repeat, so the ids of a word are computed once per worker and then looked up. The words of plain
Latin text are cut here exactly as the vocabulary's own rules cut them; any text that holds other
characters goes, word by word, through the library itself.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np

#: Words a worker remembers, twice, and the longest of them.
REMEMBERED, LONGEST = 200_000, 64
#: The vocabulary's rule for cutting words, over lower-case plain text.
PIECE = re.compile(r"[a-zß-öø-ÿ]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
#: Characters that normalisation leaves alone but for plain lower-casing.
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
CHUNK = re.compile(r"[^ \t\n\r]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write visible bytes as themselves and the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Known(dict):
    """Ids by word: computed where missing; when full, words not met since the last time are dropped."""

    def __init__(self, compute) -> None:
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self.compute(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


class WordTokens:
    """Ids as little-endian 16-bit integers; the vocabulary must have fewer than 65,536 entries."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        if self.tokenizer.get_vocab_size() >= 1 << 16:
            raise ValueError("ids of this vocabulary do not fit into 16 bits")
        self.letters = _byte_letters()
        self.known = _Known(self._word)

    def _word(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("H", [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, PIECE.findall(text.lower())))

    def _other(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u2").tobytes()

    def ids(self, text: str) -> bytes:
        """Ids of the whole text, as the library gives them without added special tokens."""
        if PLAIN.fullmatch(text) and "<|" not in text:
            return self._plain(text)
        chunks = CHUNK.findall(text)
        return b"".join(
            self._plain(c) if PLAIN.fullmatch(c) and "<|" not in c else self._other(c) for c in chunks
        )


@functools.cache
def word_tokens(vocabulary: str) -> WordTokens:
    """One per worker process and vocabulary, so later tasks find the words of earlier ones."""
    return WordTokens(vocabulary)
