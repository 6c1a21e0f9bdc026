"""Removal of byte strings that repeat anywhere, by a logarithmic family of suffix arrays.

Suffixes are sampled by content: of every ``LENGTH`` bytes in a row, the suffix whose first ``HEAD`` bytes hash
lowest is kept (the leftmost of equals), so two equal strings of that length keep a suffix at the same
place. The strings that keep one suffix start next to each other; together they are its segment. A
suffix array holds the kept suffixes of a batch of documents, sorted by the hash of their first bytes instead
of the bytes themselves, which brings equal beginnings together as well, with the least and the largest digest of
the segments found there.

Arrays form levels, as the digits of a binary counter: a new batch gets an array, which is merge-scanned
against all levels for common beginnings, and two levels of equal size merge into one of twice the size. They
are written in buckets of sorted keys, so scans and merges join them without a shuffle.

A beginning that occurs once has no repeated string in its segment. If all segments of a beginning are equal, all
their strings repeat. Only segments that share a beginning and differ are compared, string by string, by
their bytes.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from strata.config import shared_dir
from strata.llm.common import forget, pieces, stored, utf8, whole_text
from strata.sources.files import remove_path

#: Bytes of a string that must not repeat, and of the beginning of a suffix.
LENGTH, HEAD = 200, 40
#: Batches into which documents fall by a hash of their text.
BATCHES = 4
#: Bytes hashed at once, so that running sums stay in a processor's cache; a longer text is hashed in overlapping parts.
BLOCK = 1 << 17
#: Different segments of one beginning that a task compares; those of a beginning with more are taken apart.
GROUP = 64
#: Neighbouring strings that a busy beginning's segments are first compared by.
STEP = 16

#: Odd multipliers of the two running hashes, and of the last mixing step.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
LOW = np.uint64(0xFFFFFFFF)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """A random number for each byte value, for both hashes."""
    return tuple(np.random.default_rng(11).integers(0, 1 << 64, (2, 256), np.uint64))


@functools.cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    found = []
    for factor in (base, pow(base, -1, 1 << 64)):
        row = np.full(n, factor, np.uint64)
        row[0] = 1
        found.append(np.multiply.accumulate(row))
    return tuple(found)


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in MIX:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of all substrings of some bytes, from running sums."""

    def __init__(self, codes: np.ndarray, which: int):
        size = 1 << max(10, int(len(codes)).bit_length())
        powers, self.inverse = _powers(BASES[which], size)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_tables()[which][codes] * powers[: len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def of_all(self, length: int) -> np.ndarray:
        """Of every substring of that length."""
        found = self.sums[length:] - self.sums[:-length]
        return found * self.inverse[: len(found)]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row: of the rest of a block and the beginning of the next."""
    blocks = -(-len(values) // width)
    padded = np.full((blocks, width), np.iinfo(np.uint64).max, np.uint64)
    padded.ravel()[: len(values)] = values
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


#: Of a segment: number of its text, hash of the suffix's beginning, digest, first start, strings, suffix from there.
SEGMENT = ("owner", "key", "digest", "start", "strings", "offset")


def segments(texts: list[bytes], length: int = LENGTH, head: int = HEAD) -> dict[str, np.ndarray]:
    """All segments of some texts, as arrays named by SEGMENT; texts shorter than ``length`` have none."""
    found = [_of_parts(*group, length, head) for group in _parts(texts, length)]
    return {name: np.concatenate([f[name] for f in found] or [np.zeros(0, np.int64)]) for name in SEGMENT}


def _parts(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Owner, first byte and bytes of parts that hold about BLOCK bytes together."""
    group, held = ([], [], []), 0
    for owner, text in enumerate(texts):
        for first in range(0, len(text) - length + 1, BLOCK):
            part = text[first : first + BLOCK + length - 1]
            for column, value in zip(group, (owner, first, part)):
                column.append(value)
            held += len(part)
            if held >= BLOCK:
                yield group
                group, held = ([], [], []), 0
    if held:
        yield group


def _of_parts(owners: list[int], firsts: list[int], parts: list[bytes], length: int, head: int) -> dict[str, np.ndarray]:
    codes = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    places = np.concatenate([[0], np.cumsum(sizes)])
    heads = _mixed(Rolling(codes, 0).of_all(head))
    order = (heads & ~LOW) | np.arange(len(heads), dtype=np.uint64)
    lowest = (sliding_min(order, length - head + 1) & LOW).astype(np.int64)
    inside = np.ones(len(lowest), bool)  # strings that do not run into the next part
    for end in places[1:-1]:
        inside[max(0, end - length + 1) : end] = False
    starts = np.flatnonzero(inside)
    suffix = lowest[starts]
    cuts = np.flatnonzero(np.diff(suffix, prepend=-1))
    first, last, suffix = starts[cuts], starts[np.r_[cuts[1:], len(starts)] - 1], suffix[cuts]
    shape = ((suffix - first) << 32 | (last - first + 1)).astype(np.uint64)
    digest = _mixed(Rolling(codes, 1).of(first, last + length) ^ _mixed(shape))
    unit = np.searchsorted(places, first, "right") - 1
    return {
        "owner": np.array(owners)[unit],
        "key": heads[suffix].view(np.int64),
        "digest": digest.view(np.int64),
        "start": np.array(firsts)[unit] + first - places[unit],
        "strings": last - first + 1,
        "offset": suffix - first,
    }


# The family


def _entries(length: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = segments(utf8(part.column("text")), length)
                yield pa.RecordBatch.from_arrays([pa.array(found["key"]), pa.array(found["digest"])], names=["key", "digest"])

    return entries


def _largest(a: Column, b: Column, least: Column) -> Column:
    """The larger digest, null where it is the least one too: most beginnings have one segment."""
    return F.nullif(F.greatest(a, b), least).alias("most")


class Level:
    """A suffix array over ``batches`` batches: key, least and most digest, and whether the key occurs again."""

    def __init__(self, rows: DataFrame, batches: int):
        self.spark, self.batches = rows.sparkSession, batches
        self.name, self.path = f"strata_level_{uuid.uuid4().hex}", shared_dir(rows.sparkSession, "level")
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = rows.write.format("parquet").bucketBy(buckets, "key").sortBy("key")
        writer.option("path", self.path).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        remove_path(self.spark, self.path)


class Family:
    """Levels of suffix arrays; at most one of each size, as in a binary counter."""

    def __init__(self, length: int = LENGTH):
        self.length, self.levels = length, []

    def add(self, texts: DataFrame) -> DataFrame:
        """Take up a batch (text): beginnings (key, least, most) that occur twice in it, or in it and a level."""
        return self.add_suffixes(texts.select(whole_text().alias("text")).mapInArrow(_entries(self.length), "key long, digest long"))

    def add_suffixes(self, entries: DataFrame) -> DataFrame:
        """The same for the kept suffixes (key, digest) of a batch."""
        rows = entries.groupBy("key").agg(
            F.min("digest").alias("least"), F.max("digest").alias("_most"), (F.count(F.lit(1)) > 1).alias("again")
        )
        new = Level(rows.select("key", "least", _largest(F.col("_most"), F.col("_most"), F.col("least")), "again"), 1)
        found = [stored(new.rows().where("again").select("key", "least", "most"), "matches")]
        found += [stored(_merged(new, level, "inner").select("key", "least", "most"), "matches") for level in self.levels]
        while self.levels and self.levels[-1].batches == new.batches:
            level = self.levels.pop()
            merged = Level(_merged(new, level, "full"), 2 * new.batches)
            new.drop()
            level.drop()
            new = merged
        self.levels.append(new)
        return functools.reduce(DataFrame.unionByName, found)

    def drop(self) -> None:
        while self.levels:
            self.levels.pop().drop()


def _merged(a: Level, b: Level, how: str) -> DataFrame:
    """Two sorted arrays read side by side."""
    left, right = (x.rows().select("key", *(F.col(c).alias(f"{c}_{n}") for c in ("least", "most", "again"))) for x, n in ((a, "a"), (b, "b")))
    least = F.least("least_a", "least_b")
    most = _largest(F.coalesce("most_a", "least_a"), F.coalesce("most_b", "least_b"), least)
    again = F.coalesce("again_a", F.lit(False)) | F.coalesce("again_b", F.lit(False))
    both = F.col("least_a").isNotNull() & F.col("least_b").isNotNull()
    return left.join(right, "key", how).select("key", least.alias("least"), most, (again | both).alias("again"))


def repeated_beginnings(suffixes: DataFrame, batches: int) -> DataFrame:
    """(key, differ) of all beginnings that occur more than once, and whether their segments differ.

    ``suffixes`` has key, digest and the number of its batch.
    """
    family = Family()
    matches = [family.add_suffixes(suffixes.where(F.col("batch") == k).select("key", "digest")) for k in range(batches)]
    rows = functools.reduce(DataFrame.unionByName, matches)
    found = rows.groupBy("key").agg(F.min("least").alias("least"), F.max(F.coalesce("most", "least")).alias("most"))
    found = stored(found.select("key", (F.col("least") != F.col("most")).alias("differ")), "beginnings")
    family.drop()
    return found


# Documents


def _named(texts: list[bytes]) -> list[pa.Array]:
    """Two numbers that name a text."""
    names = np.frombuffer(b"".join(map(xxh3_128_digest, texts)), np.int64).reshape(-1, 2)
    return [pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy())]


def _located(length: int):
    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 4 << 20):
                texts = utf8(part.column("text"))
                found, names = segments(texts, length), _named(texts)
                owner = pa.array(found["owner"])
                columns = [part.column("batch").take(owner), *(n.take(owner) for n in names)]
                columns += [pa.array(found[c]) for c in ("key", "digest")] + [pa.array(found[c].astype(np.int32)) for c in ("start", "strings")]
                yield pa.RecordBatch.from_arrays(columns, names=["batch", "t1", "t2", "key", "digest", "start", "strings"])

    return located


def suffixes_of(texts: DataFrame, length: int, batches: int) -> DataFrame:
    """All kept suffixes with the names of their texts, written by batch: a text falls into one by its hash."""
    batch = F.pmod(F.xxhash64("text"), F.lit(batches)).cast("int").alias("batch")
    schema = "batch int, t1 long, t2 long, key long, digest long, start int, strings int"
    path = shared_dir(texts.sparkSession, "suffixes")
    texts.select("text", batch).mapInArrow(_located(length), schema).write.partitionBy("batch").parquet(path)
    return texts.sparkSession.read.schema(schema).parquet(path)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part in pieces(batch):
            texts = utf8(part.column("text"))
            columns = [part.column("doc_id"), *_named(texts), pa.array([len(t) for t in texts], pa.int64()), pa.array([pack.compress(t) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "t1", "t2", "n_bytes", "packed"])


PACKED = "doc_id long, t1 long, t2 long, n_bytes long, packed binary"
#: Runs of starting places of repeated strings: first place and number.
RUNS = "array<struct<start: int, strings: int>>"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _unpacked(packed: pa.Array) -> Iterator[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return (unpack.decompress(value.as_py()) for value in packed)


def removed(starts: np.ndarray, strings: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes (start, end) covered by strings that start in the given runs of places."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts = starts[order].astype(np.int64)
    ends = np.maximum.accumulate(starts + strings[order] - 1 + length)
    new = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    return list(zip(starts[new].tolist(), ends[np.r_[new[1:], len(ends)] - 1].tolist()))


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    bounds = [0, *(place for span in spans for place in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))


def _finished(length: int, keep_text: bool):
    """Rows (doc_id, n_bytes, packed, runs) become results."""

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1 << 20, "packed"):
                rows, runs = [], part.column("runs").fill_null([])
                starts, strings = (np.asarray(c) for c in runs.flatten().flatten())
                ends = np.cumsum(np.asarray(pc.list_value_length(runs)))
                for text, a, b in zip(_unpacked(part.column("packed")), np.r_[0, ends[:-1]], ends):
                    spans = removed(starts[a:b], strings[a:b], length)
                    kept = without(text, spans)
                    rows.append((len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                columns = [list(c) for c in zip(*rows)]
                arrays = [part.column("doc_id"), part.column("n_bytes"), *map(pa.array, columns[:3])]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if keep_text:
                    arrays, names = [*arrays, pa.array(columns[3], pa.binary())], [*names, "kept_text"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return finished


# Segments that share a beginning and differ


def _contexts(length: int, with_bytes: bool):
    """The open segments of rows (t1, t2, packed, open), with their bytes or with the text's name."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1 << 20, "packed"):
                texts = list(_unpacked(part.column("packed")))
                found = segments(texts, length)
                wanted = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(part.column("open")))) << 32
                wanted |= np.asarray(part.column("open").flatten())
                which = np.isin(found["owner"] << 32 | found["start"], wanted)
                found = {name: values[which] for name, values in found.items()}
                columns = [pa.array(found["key"]), pa.array(found["digest"]), *(pa.array(found[c].astype(np.int32)) for c in ("strings", "offset"))]
                if with_bytes:
                    ends = found["start"] + found["strings"] - 1 + length
                    cut = [texts[o][a:b] for o, a, b in zip(found["owner"].tolist(), found["start"].tolist(), ends.tolist())]
                    names = ["key", "digest", "strings", "offset", "bytes"]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.binary())], names=names)
                else:
                    owner = pa.array(found["owner"])
                    columns = [*columns[:2], part.column("t1").take(owner), part.column("t2").take(owner), pa.array(found["start"].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "t1", "t2", "start"])

    return contexts


def _runs(places: list[int]) -> list[dict[str, int]]:
    found: list[dict[str, int]] = []
    for place in places:
        if found and place == found[-1]["start"] + found[-1]["strings"]:
            found[-1]["strings"] += 1
        else:
            found.append({"start": place, "strings": 1})
    return found


RESOLVED = f"key long, digest long, runs {RUNS}"
RUNS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("strings", pa.int32())]))


def _resolved(rows: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(list(map(_runs, columns[2])), RUNS_TYPE)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "digest", "runs"])


def _compared(length: int):
    """Segments sorted by key: which strings of each occur in another one of its key."""

    def group(rows: list[dict]) -> Iterator[tuple[int, int, list[int]]]:
        counts = Counter(r["bytes"][k : k + length] for r in rows for k in range(r["strings"]))
        for r in rows:
            again = [k for k in range(r["strings"]) if r["n"] > 1 or counts[r["bytes"][k : k + length]] > 1]
            if again:
                yield r["key"], r["digest"], again

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for part in pieces(batch, column="bytes"):
                found = []
                for row in part.to_pylist():
                    if held and held[0]["key"] != row["key"]:
                        found += group(held)
                        held = []
                    held.append(row)
                yield _resolved(found)
        yield _resolved(list(group(held)))

    return compared


def _blocks(length: int):
    """The strings of segments in blocks of ``STEP``, counted from the suffix, so that they lie alike in all segments of a
    key. A block has a hash of all its bytes and one of its core, which every string of a whole block holds."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1 << 18, "bytes"):
                owners, places, alls, cores = [], [], [], []
                for owner, (text, strings, offset) in enumerate(zip(*(part.column(c).to_pylist() for c in ("bytes", "strings", "offset")))):
                    number = (offset - np.arange(strings)) // STEP
                    firsts = np.flatnonzero(np.diff(number, prepend=-1))
                    for first, last in zip(firsts.tolist(), [*(firsts[1:] - 1).tolist(), strings - 1]):
                        block = int(number[first])
                        core = offset - block * STEP
                        owners.append(owner)
                        places.append((block, first, last - first + 1))
                        alls.append(text[first : last + length])
                        cores.append(text[core : core - STEP + 1 + length])
                columns = [part.column(c).take(pa.array(owners, pa.int64())) for c in ("key", "digest", "n")]
                columns += [pa.array(c, pa.int32()) for c in zip(*places)] + _named(alls) + _named(cores)
                yield pa.RecordBatch.from_arrays(columns, names=BLOCK_NAMES)

    return blocks


BLOCK_NAMES = ["key", "digest", "n", "block", "start", "strings", "b1", "b2", "c1", "c2"]
BLOCKS = "key long, digest long, n long, block int, start int, strings int, b1 long, b2 long, c1 long, c2 long"
#: What equal blocks have in common.
SAME = ["key", "block", "strings", "b1", "b2"]


def _strings(length: int):
    """Every string of the wanted blocks of a segment with a 128-bit hash."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1 << 16, "bytes"):
                sizes = part.column("strings").to_numpy()
                owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                places = np.concatenate([np.arange(a, a + n, dtype=np.int32) for a, n in zip(part.column("start").to_pylist(), sizes)])
                texts = part.column("bytes").to_pylist()
                cut = [texts[k][a : a + length] for k, a in zip(owner.to_pylist(), places.tolist())]
                columns = [*(part.column(c).take(owner) for c in ("key", "digest", "n")), pa.array(places), *_named(cut)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "n", "place", "w1", "w2"])

    return strings


def _busy(contexts: DataFrame, length: int) -> DataFrame:
    """(key, digest, start, strings) of repeated strings among the segments of busy keys, however many a key has.

    Equal blocks repeat as a whole. Of blocks that differ, only those whose core another one shares can have a common
    string; each is taken apart once, for all the segments that hold it.
    """
    blocks = stored(contexts.mapInArrow(_blocks(length), BLOCKS), "busy-blocks")
    once = blocks.groupBy(*SAME, "c1", "c2").agg(
        F.sum("n").alias("n"), F.min(F.struct("digest", "start")).alias("at")
    )
    once = stored(once.select(*SAME, "c1", "c2", "n", "at.digest", "at.start"), "busy-once")
    whole = once.where("n > 1").select(*SAME)
    found = blocks.join(whole, SAME, "left_semi").select("key", "digest", "start", "strings")
    cores = once.groupBy("key", "block", "c1", "c2").count().where("count > 1").drop("count")
    wanted = once.join(cores, ["key", "block", "c1", "c2"], "left_semi").select("key", "digest", "start", "strings", "n")
    apart = wanted.join(contexts.select("key", "digest", "bytes"), ["key", "digest"])
    apart = apart.mapInArrow(_strings(length), "key long, digest long, n long, place int, w1 long, w2 long")
    again = apart.groupBy("key", "w1", "w2").agg(F.sum("n").alias("all")).where(F.col("all") > 1)
    # A block that stands alone belongs to one segment; the others are whole.
    single = apart.where("n = 1").join(again, ["key", "w1", "w2"], "left_semi")
    return found.unionByName(single.select("key", "digest", F.col("place").alias("start"), F.lit(1).alias("strings")))


def compared(contexts: DataFrame, length: int, group: int = GROUP) -> DataFrame:
    """(key, digest, runs): the strings of each differing segment that occur in another place.

    ``contexts`` holds every different segment once: key, digest, strings, offset, bytes, n. The few segments of an
    ordinary key meet in a task.
    """
    busy = stored(contexts.groupBy("key").count().where(F.col("count") > group).select("key"), "busy-beginnings")
    few = contexts.join(busy, "key", "left_anti").repartition("key").sortWithinPartitions("key", "digest")
    found = few.mapInArrow(_compared(length), RESOLVED)
    many = _busy(contexts.join(busy, "key", "left_semi"), length)
    run = F.struct("start", "strings")
    return found.unionByName(many.groupBy("key", "digest").agg(F.sort_array(F.collect_list(run)).alias("runs")))


def repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, keep_text: bool = False, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row; with ``keep_text`` also the bytes kept.

    A byte goes if it lies in a string of ``length`` bytes that starts anywhere else as well. A null text is
    empty; texts shorter than ``length`` lose nothing. Repeated rows and equal texts are each other's repeats, whatever
    their ids; rows without an id are kept as they are. An empty table gives an empty result. Cuts may part a
    character, so what is kept is bytes. Columns other than doc_id and text are not read. Two different segments are
    told apart by 128 bits of hashes.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    suffixes = suffixes_of(texts, length, batches)
    beginnings = repeated_beginnings(suffixes, batches)
    # A set: all copies of a text name the same segments.
    flagged = suffixes.drop("batch", "digest").join(beginnings, "key").groupBy("t1", "t2").agg(
        F.collect_set(F.when(~F.col("differ"), F.struct("start", "strings"))).alias("runs"),
        F.collect_set(F.when(F.col("differ"), F.col("start"))).alias("open"),
    )
    flagged = stored(flagged, "flagged")
    forget(beginnings)
    rows = texts.mapInArrow(_packed, PACKED).join(flagged, ["t1", "t2"], "left")
    rows = stored(rows.withColumn("open", F.coalesce("open", F.array().cast("array<int>"))), "repeat-rows")
    forget(flagged)
    closed, pending = rows.where(F.size("open") == 0), rows.where(F.size("open") > 0)
    contexts = pending.select("packed", "open").mapInArrow(_contexts(length, True), "key long, digest long, strings int, offset int, bytes binary")
    contexts = contexts.groupBy("key", "digest").agg(
        F.first("strings").alias("strings"), F.first("offset").alias("offset"), F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")
    )
    contexts = stored(contexts, "contexts")
    resolved = stored(compared(contexts, length, group), "resolved")
    forget(contexts)
    places = pending.select("t1", "t2", "packed", "open").mapInArrow(_contexts(length, False), "key long, digest long, t1 long, t2 long, start int")
    moved = F.transform("runs", lambda r: F.struct((r["start"] + F.col("start")).alias("start"), r["strings"].alias("strings")))
    more = places.join(resolved, ["key", "digest"]).groupBy("t1", "t2").agg(F.flatten(F.collect_set(moved)).alias("more"))
    joined = pending.join(more, ["t1", "t2"], "left")
    both = F.concat(F.coalesce("runs", F.array().cast(RUNS)), F.coalesce("more", F.array().cast(RUNS)))
    fields = ["doc_id", "n_bytes", "packed"]
    all_rows = closed.select(*fields, "runs").unionByName(joined.select(*fields, both.alias("runs")))
    return all_rows.mapInArrow(_finished(length, keep_text), RESULT + ", kept_text binary" * keep_text)

