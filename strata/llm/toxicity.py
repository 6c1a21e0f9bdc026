"""Toxicity scores by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings, so inflected forms share evidence. Besides a weight per
term the model has a short factor per term; the inner product of two factors is the weight of the pair, so
an insult next to a group mention can count for more than both alone. A term is learned if it differs between
the classes, or if a pair with it explains labels that the terms on their own leave unexplained.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from strata.llm.common import pieces, utf8, whole_text
from strata.llm.learning import Factorization, Rows, bounded, fit, held_out, sample, screened, sigmoid

#: Hashed term buckets and factors of each.
BUCKETS, FACTORS = 1 << 16, 4
#: Bytes of the beginnings that are terms of their own.
BEGINNINGS = (4, 5)
#: Labelled rows learned from, at most.
ROWS = 12000
THRESHOLD = 0.3
#: Standard errors by which a term must differ between the classes to be learned.
LEAST_ERRORS = 3.0
#: Most frequent terms whose pairs are tested; the standard errors by which the labels of a pair's rows must differ from
#: what is expected of them, and in how many rows of the sample it must stand.
PAIRED, PAIR_ERRORS, PAIR_ROWS = 2048, 6.0, 10
#: Passes over the sample, and the step size.
EPOCHS, RATE = 30, 0.2
#: Toxic rows are few: how often each counts in learning.
EMPHASIS = 4.0
#: Words whose buckets a worker remembers.
REMEMBERED = 300_000

#: Lower-cases A-Z and turns every other ASCII character but letters and digits into a blank.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


@functools.cache
def _buckets_of() -> dict[bytes, tuple[int, ...]]:
    return {}


def _buckets(word: bytes) -> tuple[int, ...]:
    begins = (b"^%d" % n + word[:n] for n in BEGINNINGS if len(word) >= n)
    return tuple(xxh32_intdigest(term) % BUCKETS for term in (word, *begins))


def terms(text: bytes) -> np.ndarray:
    """Distinct buckets of a whole text's terms, in order."""
    words = set(text.translate(WORDS).split())
    known = _buckets_of()
    missing = words.difference(known)
    if len(known) + len(missing) > REMEMBERED:
        known.clear()
        missing = words
    for word in missing:
        known[word] = _buckets(word)
    found = set().union(*map(known.__getitem__, words))
    return np.sort(np.fromiter(found, np.int32, len(found)))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            found = [terms(text).tobytes() for text in utf8(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(found, pa.binary())],
                names=["doc_id", "label", "terms"],
            )


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Factorization:
    """The model of ``labels.toxic``; without labels of both kinds it scores every text alike."""
    featured = sample(docs, labels, "toxic", rows).select("doc_id", "label", "text")
    found = bounded(featured.mapInArrow(_featured, "doc_id long, label int, terms binary"), ["terms"])
    return learn([np.frombuffer(r.terms, np.int32) for r in found], np.array([r.label for r in found], float))


def learn(index: list[np.ndarray], labels: np.ndarray) -> Factorization:
    """Fit on terms that differ between the classes, and then on those that do in pairs; all others count nothing."""
    rows = Rows.of([(i, np.ones(len(i))) for i in index])
    wanted = screened(rows, labels, BUCKETS, LEAST_ERRORS)
    model = _fitted(rows, labels, wanted)
    paired = paired_terms(rows, labels, sigmoid(model.raw(rows))) & ~wanted
    return _fitted(rows, labels, wanted | paired) if paired.any() else model


def _fitted(rows: Rows, labels: np.ndarray, wanted: np.ndarray) -> Factorization:
    model = fit(rows.only(wanted), labels, BUCKETS, FACTORS, epochs=EPOCHS, rate=RATE, emphasis=EMPHASIS)
    model.weights[~wanted] = 0
    model.factors[~wanted] = 0
    return model


def paired_terms(rows: Rows, labels: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Terms of the pairs whose rows have labels unlike what is expected of them."""
    found = np.zeros(BUCKETS, bool)
    counts = np.bincount(rows.index, minlength=BUCKETS)
    often = np.argsort(-counts, kind="stable")[:PAIRED]
    often = often[counts[often] >= PAIR_ROWS]
    if not len(often) or not 0 < labels.mean() < 1:
        return found
    place = np.full(BUCKETS, -1)
    place[often] = np.arange(len(often))
    owner = np.repeat(np.arange(len(rows)), np.diff(rows.start))
    column, wrong, share = place[rows.index], (labels - expected).astype(np.float32), labels.mean()
    shift, there = (np.zeros((len(often), len(often)), np.float32) for _ in range(2))
    for first in range(0, len(rows), PAIRED):
        here = (owner >= first) & (owner < first + PAIRED) & (column >= 0)
        x = np.zeros((min(PAIRED, len(rows) - first), len(often)), np.float32)
        x[owner[here] - first, column[here]] = 1
        shift += (x * wrong[first : first + PAIRED, None]).T @ x
        there += x.T @ x
    errors = np.abs(shift) / np.sqrt(np.maximum(there, 1) * share * (1 - share))
    odd = (errors >= PAIR_ERRORS) & (there >= PAIR_ROWS)
    np.fill_diagonal(odd, False)
    found[often[odd.any(axis=1)]] = True
    return found


def _scored(model: Factorization):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = map(terms, utf8(part.column("text")))
                raw = model.raw(Rows.of([(i, np.ones(len(i))) for i in found]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(sigmoid(raw))],
                    names=["doc_id", "held_out", "score"],
                )

    return scored


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Null and wordless texts score as the share of toxic labels suggests. Repeated rows get equal scores and
    rows without an id are never held out. An empty table of documents gives an empty result. Only the text
    is an input of a score; columns other than doc_id and text are not read for scoring.
    """
    model = train(docs, labels, rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), whole_text().alias("text"))
    scored = texts.mapInArrow(_scored(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
