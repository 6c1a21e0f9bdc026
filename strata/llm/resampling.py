"""Importance resampling towards a target distribution, with Gumbel keys and a bracketed cutoff.

Words hash to buckets; a bucket's gain is the log ratio of its share in the target to its share in the
corpus, and a document weighs the sum of its words' gains. Weights are computed for whole Arrow batches as
one array operation. Adding a Gumbel number drawn from the id makes the highest scores a sample without
replacement.

The cutoff is found without sorting all scores: a quantile sketch brackets it, exact counts on both sides
of the bracket say whether it holds the cutoff, and widen it if not; only the rows inside are sorted.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from strata.llm.common import numbered, pieces, stored, utf8, whole_text

#: Feature buckets, seed of the draw, words of the least document, and percent drawn.
BUCKETS, SEED, LEAST_WORDS, PERCENT = 10_000, 2024, 20, 10
#: Items a level of the quantile sketch keeps, and the share of ranks first put on either side of the cutoff.
SKETCH, MARGIN = 200, 0.02
#: Words whose buckets a worker remembers.
REMEMBERED = 300_000

#: Lower-cases A-Z and turns every other ASCII character but letters and digits into a blank.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class Buckets(dict):
    """Bucket of a word, remembered for as many words as a worker may hold."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = crc32(word) % BUCKETS
        return found


def _bucketed(texts: list[bytes], buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words one after another, and the words of each text."""
    words = [text.translate(WORDS).split() for text in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    found = (buckets[word] for text in words for word in text)
    return np.fromiter(found, np.int64, int(sizes.sum())), sizes


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets, counts = Buckets(), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in pieces(batch):
            counts += np.bincount(_bucketed(utf8(part.column("text")), buckets)[0], minlength=BUCKETS)
    present = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(present), pa.array(counts[present])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Words per bucket over all rows; every task sums its own, so at most ``BUCKETS`` rows a task are shuffled."""
    partial = texts.select(whole_text().alias("text")).mapInArrow(_counted, "bucket long, n long")
    counts = np.zeros(BUCKETS, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the corpus) per bucket."""
    all_s, all_t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = ((t + 1.0) * all_s / ((s + 1.0) * all_t) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def gumbel(doc_id: int | None) -> int:
    """The draw of an id, in thousandths; rows without an id draw as the empty id."""
    name = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{SEED}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(gain: np.ndarray):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            for part in pieces(batch):
                found, sizes = _bucketed(utf8(part.column("text")), buckets)
                sums = np.concatenate([[0], np.cumsum(gain[found])])
                ends = np.cumsum(sizes)
                weight = sums[ends] - sums[ends - sizes]
                draws = np.fromiter(map(gumbel, part.column("doc_id").to_pylist()), np.int64, len(sizes))
                columns = [part.column("doc_id"), *map(pa.array, (sizes, weight, weight + draws))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "weight", "score"])

    return scored


def _order() -> list[Column]:
    """The order of a draw: highest score first, then the smaller id. ``_row`` makes it total, so that rows with
    equal scores and ids can be cut anywhere."""
    return [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("_row")]


def bracket(scores: DataFrame, wanted: int, rows: int, margin: float = MARGIN) -> tuple[int, int, int]:
    """Scores low and high around the ``wanted``-th highest, and how many lie above high.

    The sketch proposes ranks ``margin`` to either side. Exact counts of the rows above and of those not
    below decide: as long as the cutoff lies outside, the margin doubles; the whole range always holds it.
    """
    sketch = F.kll_sketch_agg_bigint("score", F.lit(SKETCH))
    share = 1 - wanted / rows
    while True:
        low, high = max(0.0, share - margin), min(1.0, share + margin)
        ends = scores.agg(sketch.alias("s"), F.min("score").alias("least"), F.max("score").alias("most")).select(
            F.when(F.lit(low == 0), F.col("least")).otherwise(F.kll_sketch_get_quantile_bigint("s", F.lit(low))).alias("low"),
            F.when(F.lit(high == 1), F.col("most")).otherwise(F.kll_sketch_get_quantile_bigint("s", F.lit(high))).alias("high"),
        )
        low, high = ends.first()
        above, inside = scores.agg(
            F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))
        ).first()
        if above < wanted <= above + inside:
            return low, high, above
        margin *= 2


def cutoff(eligible: DataFrame, wanted: int, rows: int) -> Row:
    """The last row that is drawn."""
    low, high, above = bracket(eligible, wanted, rows)
    inside = numbered(eligible.where(F.col("score").between(low, high)), _order(), "bracket")
    return inside.where(F.col("place") == wanted - above).first()


def _drawn(last: Row) -> Column:
    """Whether a row comes no later than ``last`` in the order of a draw."""
    result = F.lit(True)
    for name in reversed(["n_features", "weight", "_row"]):
        result = (F.col(name) < last[name]) | ((F.col(name) == last[name]) & result)
    if last.doc_id is None:
        by_id = F.col("doc_id").isNull() & result
    else:
        by_id = F.col("doc_id").isNull() | (F.col("doc_id") < last.doc_id) | ((F.col("doc_id") == last.doc_id) & result)
    return F.coalesce((F.col("score") > last.score) | ((F.col("score") == last.score) & by_id), F.lit(False))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) for every row of ``docs``.

    Counts cover all rows of ``docs`` and of ``target``. A null text has no words and weight 0. A null doc_id
    draws as the empty id and comes first among ties. Repeated rows are documents of their own with
    equal scores; rows equal in all results are interchangeable, so which of them gets which rank does
    not show. Without documents the result is empty; without a target all words of the corpus only lose.
    Columns other than doc_id and text are not read.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    scored = texts.mapInArrow(_scored(gain), "doc_id long, n_features long, weight long, score long")
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "resampling-scores")
    enough = F.col("n_features") >= least_words
    eligible = scored.where(enough)
    rows = eligible.count()
    wanted = percent * rows // 100
    results = ["doc_id", "n_features", "weight", "score", "rank"]
    unranked = scored.withColumn("rank", F.lit(None).cast("long"))
    if not wanted:
        return unranked.select(results)
    chosen = enough & _drawn(cutoff(eligible, wanted, rows))
    ranked = numbered(scored.where(chosen), _order(), "drawn", "rank")
    return unranked.where(~chosen).select(results).unionByName(ranked.select(results))


def drawn_documents(docs: DataFrame, result: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, with all their columns; ids are expected to be unique."""
    ids = result.where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, docs["doc_id"] == ids["_drawn"], "left_semi")
