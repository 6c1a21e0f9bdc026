"""Small models over hashed terms, fitted on a bounded sample of labelled rows.

The sample's features are computed by Spark tasks and only they reach the driver: at most ``ROWS`` labelled
rows and ``SAMPLE_BYTES`` bytes of features, in the order of a hash of their id, whatever the input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from strata.llm.common import forget, stored, whole_text

#: Rows of a fold that are never learned from: crc32 of the id as text, modulo FOLDS.
FOLDS, HELD_OUT = 4, 2
#: Bounds of a sample: labelled rows, and bytes of their features.
ROWS, SAMPLE_BYTES = 6000, 64 << 20
SEED = 7


def held_out(column: str = "doc_id") -> Column:
    """Whether the row belongs to the fold that no model learns from; rows without an id do not."""
    fold = F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from.

    Labels other than 0 and 1 and rows of the held-out fold are left out; repeated labels of an id count
    as their largest. Null ids never match.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    return known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def by_hash(rows: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows, by a hash of their id; every layout of the table gives the same ones."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = ROWS) -> DataFrame:
    """At most ``rows`` labelled documents: doc_id, label, text, lang, source, n_chars; labels without one do not count."""
    known = known_labels(labels, label).join(docs.select("doc_id"), "doc_id", "left_semi")
    return whole_rows(docs, by_hash(known, rows))


def whole_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """What a model reads of the documents with the chosen ids, few by a bound; repeated ones as their smallest row."""
    fields = F.struct(whole_text().alias("text"), "lang", "source", "n_chars")
    matched = docs.select("doc_id", fields.alias("row")).join(F.broadcast(chosen), "doc_id")
    others = [c for c in chosen.columns if c != "doc_id"]
    return matched.groupBy("doc_id").agg(*(F.first(c).alias(c) for c in others), F.min("row").alias("row")).select(
        "doc_id", *others, "row.*"
    )


def bounded(featured: DataFrame, features: list[str], most: int = SAMPLE_BYTES) -> list[Row]:
    """Rows by the hash of their id until their features reach ``most`` bytes, in the order of ids."""
    featured = stored(featured, "sample-features")
    size = sum((F.octet_length(c).cast("long") for c in features), F.lit(0).cast("long"))
    # Ids and sizes of a sample whose rows are bounded.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fits = featured.select("doc_id", F.sum(size).over(order).alias("so_far")).where(F.col("so_far") <= most)
    found = featured.join(F.broadcast(fits.select("doc_id")), "doc_id").collect()
    forget(featured)
    return sorted(found, key=lambda r: r.doc_id)


@dataclass
class Rows:
    """Sparse rows: the entries of row k are at start[k] to start[k + 1]."""

    index: np.ndarray
    value: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        sizes = [len(i) for i, _ in rows]
        if not rows:
            return cls(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64))
        return cls(
            np.concatenate([i for i, _ in rows]).astype(np.int32),
            np.concatenate([v for _, v in rows]).astype(np.float32),
            np.concatenate([[0], np.cumsum(sizes)]),
        )

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, which: np.ndarray) -> Rows:
        bounds = [(self.start[k], self.start[k + 1]) for k in which]
        return Rows.of([(self.index[a:b], self.value[a:b]) for a, b in bounds])

    def and_also(self, other: Rows) -> Rows:
        starts = np.concatenate([self.start, other.start[1:] + self.start[-1]])
        return Rows(np.concatenate([self.index, other.index]), np.concatenate([self.value, other.value]), starts)

    def only(self, wanted: np.ndarray) -> Rows:
        """The entries whose index is wanted."""
        owner = np.repeat(np.arange(len(self)), np.diff(self.start))
        keep = wanted[self.index]
        sizes = np.bincount(owner[keep], minlength=len(self))
        return Rows(self.index[keep], self.value[keep], np.concatenate([[0], np.cumsum(sizes)]))


def screened(rows: Rows, labels: np.ndarray, size: int, least: float) -> np.ndarray:
    """Which entries differ between the classes by at least so many standard errors."""
    if not len(labels):
        return np.zeros(size, bool)
    owner, share = np.repeat(np.arange(len(rows)), np.diff(rows.start)), labels.mean()
    shift = np.bincount(rows.index, (labels - share)[owner] * rows.value, size)
    spread = np.bincount(rows.index, rows.value**2, size) * share * (1 - share)
    return np.abs(shift) >= least * np.sqrt(np.maximum(spread, 1e-12))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Factorization:
    """bias + linear terms + pairwise interactions by inner products of factors; without factors, logistic."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: Rows) -> np.ndarray:
        owner = np.repeat(np.arange(len(rows)), np.diff(rows.start))
        out = self.bias + np.bincount(owner, self.weights[rows.index] * rows.value, len(rows))
        for v in self.factors.T:
            x = v[rows.index] * rows.value
            out += 0.5 * (np.bincount(owner, x, len(rows)) ** 2 - np.bincount(owner, x * x, len(rows)))
        return out

    def raw_one(self, index: np.ndarray, value: np.ndarray) -> float:
        x = self.factors[index] * value[:, None]
        pairs = (x.sum(0) ** 2 - (x * x).sum(0)).sum() / 2
        return float(self.bias + self.weights[index] @ value + pairs)


def fit(
    rows: Rows, labels: np.ndarray, size: int, n_factors: int = 0, epochs: int = 12, rate: float = 0.1,
    decay: float = 1e-4, batch: int = 256, emphasis: float = 1.0,
) -> Factorization:
    """Minibatch Adagrad on the logistic loss, where label 1 counts ``emphasis`` times.

    The same rows in the same order give the same model.
    """
    random = np.random.default_rng(SEED)
    batch = max(8, min(batch, len(rows) // 16))  # small samples need steps, too
    share = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    model = Factorization(
        float(np.log(share / (1 - share))),
        np.zeros(size),
        random.normal(0, 0.02, (size, n_factors)),
    )
    if len(np.unique(labels)) < 2:
        return Factorization(model.bias, model.weights, np.zeros((size, 0)))
    seen_w, seen_v, seen_b = np.full(size, 1e-2), np.full((size, n_factors), 1e-2), 1e-2
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            which = order[at : at + batch]
            part = rows.take(which)
            owner = np.repeat(np.arange(len(part)), np.diff(part.start))
            sums = [np.bincount(owner, v[part.index] * part.value, len(part)) for v in model.factors.T]
            wrong = (sigmoid(model.raw(part)) - labels[which]) / len(which)
            wrong *= np.where(labels[which] > 0, emphasis, 1.0)
            pull = wrong[owner] * part.value
            g = np.bincount(part.index, pull, size) + decay * model.weights
            seen_w += g * g
            model.weights -= rate * g / np.sqrt(seen_w)
            for f, s in enumerate(sums):
                v = model.factors[:, f]
                g = np.bincount(part.index, pull * (s[owner] - v[part.index] * part.value), size) + decay * v
                seen_v[:, f] += g * g
                model.factors[:, f] -= rate * g / np.sqrt(seen_v[:, f])
            g = wrong.sum()
            seen_b += g * g
            model.bias -= rate * g / np.sqrt(seen_b)
    return model


def calibration(raw: np.ndarray, labels: np.ndarray, steps: int = 50) -> np.ndarray:
    """Slopes per column and an offset that turn raw scores into log odds (Platt), with smoothed targets.

    Without labels of both kinds the columns are averaged as they are.
    """
    start = np.r_[np.full(raw.shape[1], 1 / raw.shape[1]), 0.0]
    up, down = labels.sum(), len(labels) - labels.sum()
    if not up or not down:
        return start
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x, theta = np.column_stack([raw, np.ones(len(raw))]), start.copy()
    for _ in range(steps):
        p = sigmoid(x @ theta)
        bend = (x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(len(theta))
        theta -= np.clip(np.linalg.solve(bend, x.T @ (p - target) + 1e-2 * (theta - start)), -0.5, 0.5)
    return np.r_[np.maximum(theta[:-1], 0), theta[-1]]
