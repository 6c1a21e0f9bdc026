"""Exact deduplication with counting quotient filters and byte verification.

A 64-bit fingerprint is split into a quotient (its upper bits) and a remainder. Every input
partition builds its own counting filter: per quotient the sorted distinct remainders and how often
each occurred. Filters of the same quotient merge without loss, because merging sorted remainders and
adding their counters gives exactly the filter of the united input. A group of copies of any size
enters the shuffle as one remainder per input partition.

Only fingerprints with a count above one go on: their texts are grouped by the bytes themselves, so
two different texts with one fingerprint stay apart. All other rows are unique by proof.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored, whole_text

FILTER_SCHEMA = "quotient int, remainders binary, counts binary"
#: Fingerprints a partition gathers before it hands on its filter; bounds a task's memory.
FLUSH = 1 << 20


def counted(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints with the sums of their counts."""
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.r_[True, fingerprints[1:] != fingerprints[:-1]])
    return fingerprints[first], np.add.reduceat(counts, first)


def filter_rows(fingerprints: np.ndarray, quotient_bits: int) -> pa.RecordBatch:
    """The filter of these fingerprints: one row per occupied quotient."""
    values, counts = counted(fingerprints, np.ones(len(fingerprints), np.int64))
    shift = np.uint64(64 - quotient_bits)
    quotients, remainders = values >> shift, values & ((np.uint64(1) << shift) - np.uint64(1))
    first = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
    bounds = [*zip(first, [*first[1:], len(values)])]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(quotients[first].astype(np.int32)),
            pa.array([remainders[a:b].tobytes() for a, b in bounds], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in bounds], pa.binary()),
        ],
        names=["quotient", "remainders", "counts"],
    )


def build_filters(quotient_bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += batch.num_rows
            if size >= FLUSH:
                yield filter_rows(np.concatenate(held), quotient_bits)
                held, size = [], 0
        if size:
            yield filter_rows(np.concatenate(held), quotient_bits)

    return build


def merge_filters(quotient_bits: int):
    shift = np.uint64(64 - quotient_bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for quotient, same in groupby(rows, key=lambda row: row[0]):
            parts = [(np.frombuffer(r, np.uint64), np.frombuffer(c, np.int64)) for _, r, c in same]
            remainders, counts = counted(*(np.concatenate(x) for x in zip(*parts)))
            repeated = counts > 1
            if repeated.any():
                values = (np.uint64(quotient) << shift) | remainders[repeated]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(counts[repeated])], names=["fingerprint", "n"]
                )

    return merge


def repeated_fingerprints(fingerprints: DataFrame, quotient_bits: int = 12) -> DataFrame:
    """Fingerprints (first column, long) that occur more than once, with their exact counts."""
    filters = fingerprints.mapInArrow(build_filters(quotient_bits), FILTER_SCHEMA)
    return (
        filters.repartition("quotient")
        .sortWithinPartitions("quotient")
        .mapInArrow(merge_filters(quotient_bits), "fingerprint long, n long")
    )


def repeated_texts(docs: DataFrame, quotient_bits: int = 12) -> DataFrame:
    """Texts that occur more than once: text_sha256, keep_id (largest doc_id), group_size."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    repeated = stored(repeated_fingerprints(texts.select(F.xxhash64("text")), quotient_bits), "dedup-filter")
    routed = texts.withColumn("fingerprint", F.xxhash64("text")).join(
        repeated.select("fingerprint"), "fingerprint", "left_semi"
    )
    return (
        routed.groupBy("text")  # the bytes decide, not the fingerprint
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )


def exact_groups(docs: DataFrame, quotient_bits: int = 12) -> DataFrame:
    """One row per document: the group of equal texts it belongs to and which row stays.

    Texts are equal when identical; null counts as empty. The row with the largest doc_id stays. Rows
    with a null doc_id stay only when no other row of the group has an id. Repeated rows count, and all
    rows repeating the id that stays are marked as kept. An empty table gives an empty result; columns
    other than doc_id and text are not read.
    """
    members = docs.select("doc_id", F.sha2(whole_text(), 256).alias("text_sha256"))
    single = F.col("group_size").isNull()
    return members.join(repeated_texts(docs, quotient_bits), "text_sha256", "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Of rows repeating the id that stays together with its text, the one whose JSON form comes first stays.
    Which groups have such rows is found from ids and digests alone; usually none, and then whole rows are
    shuffled once, to meet their groups.
    """
    rows = docs.select("doc_id", F.sha2(whole_text(), 256).alias("text_sha256"), F.struct(*docs.columns).alias("row"))
    groups = stored(repeated_texts(docs), "dedup-groups")
    is_kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    kept = rows.select("doc_id", "text_sha256").join(groups, "text_sha256").where(is_kept)
    per_group = kept.groupBy("text_sha256", "keep_id").agg(F.count(F.lit(1)).alias("rows"))
    # Written, so that its size is known before the rows are joined to it.
    several = stored(per_group.where("rows > 1").select("text_sha256", "keep_id"), "dedup-repeated-ids")
    marked = groups.join(several.select("text_sha256", F.lit(True).alias("several")), "text_sha256", "left")
    joined = rows.join(marked, "text_sha256", "left")
    once = joined.where(F.col("group_size").isNull() | (is_kept & F.col("several").isNull())).select("row")
    repeats = rows.join(several, "text_sha256").where(is_kept)
    first = repeats.groupBy("text_sha256").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.unionByName(first).select("row.*")
