"""Quality scores by co-training a text view and a page-metadata view.

The text view reads what is written: words, the punctuation that sticks to them and repetition. The
metadata view reads what the page looks like from outside: language, source, length, lines and shares of
character classes. Each view starts from the labelled rows. In every round both views score all unlabelled
documents in Spark tasks; of those that a view is certain of, some of either class, chosen by hash from the whole
corpus, are labelled for the other view, and both are fitted again. Each view is then calibrated on
labelled rows it has not learned from; the same rows say how much the log odds of each view count in a
document's score.
"""

from __future__ import annotations

import functools
import math
import operator
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from strata.llm.common import pieces, stored, utf8, whole_text
from strata.llm.learning import (
    Factorization,
    Rows,
    bounded,
    by_hash,
    calibration,
    fit,
    held_out,
    known_labels,
    sample,
    sigmoid,
    whole_rows,
)

TEXT_BUCKETS, META_BUCKETS = 1 << 14, 1 << 10
#: Labelled rows learned from, at most.
LABELLED = 6000
#: Rounds of co-training, the certainty with which a view labels a row for the other, and rows it hands on per class.
ROUNDS, CERTAIN, HANDED_ON = 2, 0.97, 1000
#: Of the labelled rows, one in so many calibrates.
CALIBRATE = 4
THRESHOLD = 0.5
REMEMBERED = 100_000

LETTERS = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
UPPER, DIGITS, BLANKS = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A)), b" \t\n\r\x0b\x0c"


@functools.cache
def _known() -> dict[bytes, int]:
    return {}


def _bucket(term: bytes, buckets: int) -> int:
    return xxh32_intdigest(term) % buckets


def text_view(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a whole text's content."""
    words = text.lower().split()
    marks = Counter(text.translate(None, LETTERS).split())
    counts, known = Counter(words), _known()
    missing = set(counts).difference(known)
    if len(known) + len(missing) > REMEMBERED:
        known.clear()
        missing = set(counts)
    for word in missing:
        known[word] = _bucket(word, TEXT_BUCKETS)
    found = np.fromiter(map(known.__getitem__, counts), np.int32, len(counts))
    tf = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    tf /= max(1e-9, float(np.sqrt((tf * tf).sum())))
    n = max(1, len(words))
    again = sum(map(operator.eq, words, words[1:])) / n
    extra = [(_bucket(b"\0mark" + m, TEXT_BUCKETS), 3.0 * min(1.0, k / n)) for m, k in sorted(marks.items()) if k * 50 >= n]
    extra += [(_bucket(b"\0again", TEXT_BUCKETS), 4.0 * again), (_bucket(b"\0distinct", TEXT_BUCKETS), len(counts) / n)]
    extra += [(_bucket(b"\0marks", TEXT_BUCKETS), 2.0 * min(2.0, sum(marks.values()) / n))]
    index = np.concatenate([found, np.array([i for i, _ in extra], np.int32)])
    return index, np.concatenate([tf, [v for _, v in extra]])


def meta_view(text: bytes, lang: str | None, source: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of what is known without reading a text's words."""
    size = max(1, len(text))
    length = math.log1p(max(0, n_chars if n_chars is not None else len(text)))
    lines = text.count(b"\n") + 1
    left = len(text.translate(None, LETTERS))
    blanks = size - len(text.translate(None, BLANKS))
    shares = {
        b"symbols": 8.0 * max(0, left - blanks) / size,
        b"digits": 8.0 * (size - len(text.translate(None, DIGITS))) / size,
        b"upper": 8.0 * (size - len(text.translate(None, UPPER))) / size,
        b"blanks": 4.0 * blanks / size,
        b"line": math.log1p(size / lines) / 8,
        b"lines": math.log1p(lines) / 8,
        b"length": length / 10,
    }
    # Symbols and blanks are coarsely binned as well, because both too few and too many are odd.
    named = [b"lang:%s" % (lang or "").encode(), b"source:%s" % (source or "").encode(), b"bin:%d" % int(length)]
    named += [b"%s bin:%d" % (k, int(shares[k] * 8)) for k in (b"symbols", b"blanks", b"upper")]
    terms = [(name, value) for name, value in shares.items()] + [(name, 0.5) for name in named]
    return np.array([_bucket(t, META_BUCKETS) for t, _ in terms], np.int32), np.array([v for _, v in terms])


def views(part: pa.RecordBatch) -> Iterator[tuple[tuple, tuple]]:
    columns = (part.column(c).to_pylist() for c in ("lang", "source", "n_chars"))
    for text, lang, source, n_chars in zip(utf8(part.column("text")), *columns):
        text = text or b""
        yield text_view(text), meta_view(text, lang, source, n_chars)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            found = [[x.tobytes() for view in pair for x in view] for pair in views(part)]
            columns = [pa.array(c, pa.binary()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), *columns],
                names=["doc_id", "label", "ti", "tv", "mi", "mv"],
            )


Models = tuple[Factorization, Factorization]
#: Rows of both views, and what each view says of every row: 0, 1 or -1 for not certain.
Taught = tuple[Rows, Rows, np.ndarray]


def said(models: Models, text: Rows, meta: Rows) -> np.ndarray:
    """What each view is certain of, a column a view."""
    p = np.column_stack([sigmoid(m.raw(r)) for m, r in zip(models, (text, meta))])
    return np.where(p >= CERTAIN, 1, np.where(p <= 1 - CERTAIN, 0, -1))


@dataclass
class CoTrained:
    models: Models
    calibrations: tuple[np.ndarray, np.ndarray]
    combination: np.ndarray

    def scores(self, text: Rows, meta: Rows) -> np.ndarray:
        """Combined scores and those of both views, a column each."""
        raw = [m.raw(r) for m, r in zip(self.models, (text, meta))]
        odds = [slope * x + offset for x, (slope, offset) in zip(raw, self.calibrations)]
        *shares, offset = self.combination
        combined = sum((share * x for share, x in zip(shares, odds)), offset)
        return sigmoid(np.column_stack([combined, *odds]))


def co_train(text: Rows, meta: Rows, labels: np.ndarray, teach: Callable[[Models], Taught] | None = None) -> CoTrained:
    """Fit both views on rows in a fixed order; ``teach`` gives the unlabelled rows the models are certain of.

    Labels are 0, 1 or -1 for rows without one, which are the unlabelled rows if there is no ``teach``.
    """
    sizes, rows = (TEXT_BUCKETS, META_BUCKETS), (text, meta)
    known = np.flatnonzero(labels >= 0)
    kept_back = known[CALIBRATE - 1 :: CALIBRATE]
    learned = np.setdiff1d(known, kept_back)
    free = [r.take(np.flatnonzero(labels < 0)) for r in rows]

    def fitted(view: int, taught: Taught | None) -> Factorization:
        use, given = rows[view].take(learned), labels[learned]
        if taught is not None:
            by_other = taught[2][:, 1 - view]
            use = use.and_also(taught[view].take(np.flatnonzero(by_other >= 0)))
            given = np.r_[given, by_other[by_other >= 0]]
        return fit(use, given, sizes[view], epochs=20, rate=0.3)

    models = fitted(0, None), fitted(1, None)
    for _ in range(ROUNDS if len(np.unique(labels[learned])) > 1 else 0):
        taught = teach(models) if teach else (*free, said(models, *free))
        models = fitted(0, taught), fitted(1, taught)
    raw = [m.raw(r.take(kept_back)) for m, r in zip(models, rows)]
    fits = [calibration(x[:, None], labels[kept_back]) for x in raw]
    odds = np.column_stack([slope * x + offset for x, (slope, offset) in zip(raw, fits)])
    return CoTrained(models, tuple(fits), calibration(odds, labels[kept_back]))


FEATURES = ["ti", "tv", "mi", "mv"]


def _collected(texts: DataFrame) -> tuple[list, Rows, Rows]:
    """Rows of bounded number with their features, in the order of ids."""
    schema = "doc_id long, label int, " + ", ".join(f"{f} binary" for f in FEATURES)
    found = bounded(texts.mapInArrow(_featured, schema), FEATURES)
    text = Rows.of([(np.frombuffer(r.ti, np.int32), np.frombuffer(r.tv)) for r in found])
    return found, text, Rows.of([(np.frombuffer(r.mi, np.int32), np.frombuffer(r.mv)) for r in found])


def _rows_of(part: pa.RecordBatch) -> tuple[Rows, Rows]:
    pairs = list(views(part))
    return Rows.of([text for text, _ in pairs]), Rows.of([meta for _, meta in pairs])


def _certain(models: Models):
    def certain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                opinions = said(models, *_rows_of(part))
                sure = np.flatnonzero((opinions >= 0).any(axis=1))
                columns = [part.column("doc_id").take(pa.array(sure)), *map(pa.array, opinions[sure].T.astype(np.int32).copy())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "by_text", "by_meta"])

    return certain


def certain_documents(docs: DataFrame, labels: DataFrame, models: Models, handed_on: int = HANDED_ON) -> DataFrame:
    """Ids (doc_id, label null) of unlabelled documents that a view is certain of: per view and class as many as it hands on.

    Every unlabelled document outside the held-out fold is scored; documents sharing an id count once.
    """
    scored = _inputs(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    sure = scored.mapInArrow(_certain(models), "doc_id long, by_text int, by_meta int")
    sure = sure.join(known_labels(labels, "quality").select("doc_id"), "doc_id", "left_anti")
    sure = stored(sure.groupBy("doc_id").agg(F.min("by_text").alias("by_text"), F.min("by_meta").alias("by_meta")), "certain")
    strata = [by_hash(sure.where(F.col(view) == label).select("doc_id"), handed_on) for view in ("by_text", "by_meta") for label in (0, 1)]
    return functools.reduce(DataFrame.unionByName, strata).distinct().withColumn("label", F.lit(None).cast("int"))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, handed_on: int = HANDED_ON) -> CoTrained:
    """The model of ``labels.quality``; without labels of both kinds it scores every document alike."""

    def teach(models: Models) -> Taught:
        _, text, meta = _collected(whole_rows(docs, certain_documents(docs, labels, models, handed_on)))
        return text, meta, said(models, text, meta)

    found, text, meta = _collected(sample(docs, labels, "quality", labelled))
    return co_train(text, meta, np.array([r.label for r in found], float), teach)


def _inputs(docs: DataFrame, *more: Column) -> DataFrame:
    """What the views read of every row."""
    fields = ["lang", "source", F.col("n_chars").cast("long").alias("n_chars")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *fields, *more)


def _scored(model: CoTrained):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = model.scores(*_rows_of(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), *map(pa.array, found.T.copy())],
                    names=["doc_id", "held_out", "score", "text_score", "metadata_score"],
                )

    return scored


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, text_score, metadata_score and predicted (1: good) for every row.

    Nulls: a text counts as empty, lang and source as the empty name, n_chars as the text's length in
    bytes; rows without an id are scored but never held out. Repeated rows get equal scores. An empty
    table of documents gives an empty result; other columns are not read.
    """
    model = train(docs, labels)
    schema = "doc_id long, held_out boolean, score double, text_score double, metadata_score double"
    scored = _inputs(docs, held_out().alias("held_out")).mapInArrow(_scored(model), schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of at least the threshold, with all their columns."""
    model = train(docs, labels)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                inputs = part.column("row").flatten()
                names = [part.column("row").type.field(k).name for k in range(len(inputs))]
                good = model.scores(*_rows_of(part))[:, 0] >= THRESHOLD
                yield pa.RecordBatch.from_arrays(inputs, names=names).filter(pa.array(good, pa.bool_()))

    return _inputs(docs, F.struct(*docs.columns).alias("row")).mapInArrow(kept, docs.schema)
