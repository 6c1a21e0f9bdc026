"""Near copies by the similarity of their five-word shingles, all of them.

Two texts are near copies when their sets of shingles have a Jaccard similarity of ``SIMILARITY`` or more, or
when their fingerprints (``simhash``) lie within its radius. The first kind is joined by prefixes: with the
shingles of every text in one order, texts that similar share one of their first fifth. The order puts
shingles rare in a sample first, so what many texts hold in common is seldom in a prefix; any order finds the
same pairs. Candidates are verified by their whole sets.

Texts that share a shingle are first linked along a chain, as their sizes follow each other, and then, from one
connected set to another, with a few that follow. Only then all pairs that are not yet connected are compared: by a
brief sketch where they meet, and by their whole sets if that leaves them. So a group of near copies costs pairs in
proportion to its size.

Sets of shingles take more room than the texts, so they are never written as a whole: they are made again from
the texts of candidates that a short sketch per text could not rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest, xxh64_intdigest

from strata.llm.common import forget, pieces, stored, utf8, whole_text
from strata.llm.components import components
from strata.llm.simhash import SEED, STRIP, TILE, fingerprint, links_within

WORDS_PER_SHINGLE = 5
#: Numerator and denominator, so that comparisons are exact.
SIMILARITY = (4, 5)
#: One of so many texts is in the sample that tells common shingles, and so many of these are remembered.
SAMPLE, COMMON = 50, 50_000
#: Bits, at least, of the sketch that rules out most candidates before their sets are made again. Larger sets have
#: larger sketches, of half their size or more: with fewer bits two unlike sets would differ in too few of them.
SKETCH = 512
#: Following texts of a list that each text is tried with before all pairs are.
SPAN = 8
#: Pairs whose brief sketches are compared at once.
COMPARED = 1 << 16
#: Bytes of text whose shingles a task holds at once.
PART = 2 << 20
#: Bytes of lists whose members a task holds at once.
LISTED = 1 << 20
#: Pairs and texts a task remembers not to hand on again.
REMEMBERED = 1 << 20
#: What the hashes of a shingle's words are multiplied by.
FACTOR = np.uint64(0x9E3779B97F4A7C15)



def shingles(text: bytes, size: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than ``size`` are one shingle, no words none.

    A shingle's hash is made of those of its words in their order, so every word is hashed once.
    """
    words = text.lower().split()  # on bytes both touch ASCII only
    if len(words) < size:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    hashes = np.frombuffer(b"".join(map(xxh64_digest, words, repeat(SEED))), np.uint64)
    n = len(words) - size + 1
    found = hashes[:n].copy()
    for k in range(1, size):
        found ^= found >> np.uint64(32)
        found *= FACTOR
        found += hashes[k : k + n]
    # Every bit counts in the low ones, which a sketch takes, and in the high ones, which the order follows.
    for _ in range(2):
        found ^= found >> np.uint64(32)
        found *= FACTOR
    found ^= found >> np.uint64(32)
    found.sort()
    return found[np.r_[True, found[1:] != found[:-1]]]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    top, bottom = SIMILARITY
    common = len(np.intersect1d(a, b, assume_unique=True))
    return bottom * common >= top * (len(a) + len(b) - common)


def node_of(values: np.ndarray) -> int:
    """Number that stands for a set of shingles."""
    return xxh64_intdigest(values.tobytes(), SEED)


def sketch(values: np.ndarray) -> bytes:
    """Per bit whether an odd number of shingles falls on it: sketches differ in no more bits than sets in shingles."""
    size = max(SKETCH, 1 << max(0, (len(values) - 1).bit_length() - 1))
    places = (values % np.uint64(size)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=size) & 1).tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded, its size being a power of two times the other's."""
    left, right = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(left) > len(right):
        left = left[: len(left) // 2] ^ left[len(left) // 2 :]
    while len(right) > len(left):
        right = right[: len(right) // 2] ^ right[len(right) // 2 :]
    return int(np.bitwise_count(left ^ right).sum(dtype=np.int64))


def brief(bits: bytes) -> bytes:
    """The sketch folded to ``SKETCH`` bits; it still differs in no more bits than sets in shingles."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, SKETCH // 64)).tobytes()


def _briefs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [brief(bits.as_buffer()) for bits in batch.column("bits")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(values, pa.binary())], names=["node", "brief"])


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, PART):
            texts = utf8(part.column("text"))
            prints = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
            rows = [(node_of(values), len(values), sketch(values)) for values in map(shingles, texts)]
            nodes, sizes, bits = zip(*rows)
            columns = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("name"), pa.array(prints), *columns],
                names=["doc_id", "name", "fp", "node", "size", "bits"],
            )


DESCRIBED = "doc_id long, name binary, fp long, node long, size long, bits binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, PART):
            sets = [shingles(text) for text in utf8(part.column("text"))]
            nodes = np.array(list(map(node_of, sets)), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"]
            )


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, PART):
            for text in utf8(part.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text).view(np.int64))], names=["shingle"])


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample in order, and how many of its texts hold them."""
    sample = texts.where(F.pmod(F.xxhash64("name"), F.lit(SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(_single, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where("n > 2").orderBy(F.desc("n"), "shingle").limit(COMMON).collect()
    values = np.array([r.shingle for r in found], np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], np.array([r.n for r in found], np.int64)[order]


def _prefixes(common: np.ndarray, counts: np.ndarray):
    top, bottom = SIMILARITY

    def prefix(values: np.ndarray) -> np.ndarray:
        size = len(values) + (-top * len(values)) // bottom + 1
        if not len(common):
            return values[:size]
        place = np.minimum(np.searchsorted(common, values), len(common) - 1)
        weight = np.where(common[place] == values, counts[place], 0)
        return values[np.argsort(weight, kind="stable")[:size]]

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in pieces(batch, PART):
                if len(seen) > REMEMBERED:
                    seen.clear()
                nodes, sizes, firsts = [], [], []
                for values in map(shingles, utf8(part.column("text"))):
                    node = node_of(values)
                    if len(values) and node not in seen:  # of many equal sets a task hands on one
                        seen.add(node)
                        nodes.append(node)
                        sizes.append(len(values))
                        firsts.append(prefix(values))
                if not nodes:
                    continue
                taken = [len(f) for f in firsts]
                nodes = np.repeat(np.array(nodes, np.uint64).view(np.int64), taken)
                places = np.concatenate([np.arange(n) for n in taken])
                columns = [np.concatenate(firsts).view(np.int64), np.repeat(sizes, taken), nodes, places]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=MEMBER[:4])

    return prefixes


#: A text in the list of a shingle: size of its set, node, place of the shingle in the prefix, component so far.
MEMBER = ["shingle", "size", "node", "place", "root"]
MEMBERS = ", ".join(f"{name} long" for name in MEMBER[:4])
#: Numbers of a member, without and with its brief sketch.
PLAIN, SKETCHED = len(MEMBER), len(MEMBER) + SKETCH // 64


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    """Members as rows of numbers; a sixth column holds brief sketches."""
    rows = np.column_stack([batch.column(k).to_numpy() for k in range(PLAIN)]).astype(np.int64)
    if batch.num_columns == PLAIN:
        return rows
    sketches = np.frombuffer(b"".join(batch.column(PLAIN).to_pylist()), np.int64)
    return np.column_stack([rows, sketches.reshape(len(rows), -1)])


def _lists(size: int, width: int):
    """Members sorted by shingle become tiles of ``size``; a shingle whose members are of one component is left out
    unless the next or previous task may hold more of it."""

    def tiles(groups: list[np.ndarray]) -> pa.RecordBatch:
        columns = [[g[0, 0] for g in groups], [g[0, 1] for g in groups], [g[-1, 1] for g in groups], [g[0, 2] for g in groups]]
        arrays = [pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([g.tobytes() for g in groups], pa.binary())], names=LIST)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cut = np.empty((0, width), np.int64), True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, _rows(batch)])
            new = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 2] != rows[:-1, 2])
            rows = rows[np.r_[True, new]]  # tasks may hand on the same text
            starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
            ends, out = np.r_[starts[1:], len(rows)], []
            several = np.minimum.reduceat(rows[:, 4], starts) != np.maximum.reduceat(rows[:, 4], starts)
            for k in np.flatnonzero(several | ((starts == 0) & cut)):
                if k < len(starts) - 1:  # the last one may go on
                    out += [rows[at : min(at + size, ends[k])] for at in range(starts[k], ends[k], size)]
            held, cut = rows[starts[-1] :], cut and len(starts) == 1
            while len(held) > size:
                out.append(held[:size])
                held, cut = held[size:], True
            if out:
                yield tiles(out)
        if len(held):
            yield tiles([held])

    return lists


LIST = ["shingle", "low", "high", "first", "members"]


def lists_of(members: DataFrame, name: str) -> DataFrame:
    order, width = ["shingle", "size", "node"], SKETCHED if "brief" in members.columns else PLAIN
    sorted_members = members.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(
        sorted_members.mapInArrow(_lists(TILE, width), "shingle long, low long, high long, first long, members binary"), name
    )


def _members(value: bytes, width: int = SKETCHED) -> np.ndarray:
    return np.frombuffer(value, np.int64).reshape(-1, width)


def _listed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members of many lists together, and for each the number of its list: most lists are short."""
    for batch in batches:
        for part in pieces(batch, LISTED, batch.schema.names[0]):
            values = part.column(0).to_pylist()
            sizes = [len(value) // (8 * width) for value in values]
            yield _members(b"".join(values), width), np.repeat(np.arange(len(sizes)), sizes)


def _exploded(width: int):
    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _listed(batches, width):
            columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(4)]
            if width > PLAIN:
                sketches = rows[:, PLAIN:].tobytes()
                ends = np.arange(len(rows) + 1, dtype=np.int32) * (SKETCH // 8)
                columns.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(sketches)]))
            yield pa.RecordBatch.from_arrays(columns, names=[*MEMBER[:4], "brief"][: len(columns)])

    return exploded


def _possible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which members, by sizes and places, may be similar when this is the first shingle they share."""
    top, bottom = SIMILARITY
    left = np.minimum(a[..., 1] - a[..., 3], b[..., 1] - b[..., 3])
    return (a[..., 4] != b[..., 4]) & ((top + bottom) * left >= top * (a[..., 1] + b[..., 1]))


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of members their brief sketches do not rule out."""
    top, bottom = SIMILARITY
    unlike = (a[:, PLAIN:] ^ b[:, PLAIN:]).astype(np.uint64)  # of signed numbers the bits of the absolute value would count
    differ = np.bitwise_count(unlike).sum(axis=1, dtype=np.int64)
    return (top + bottom) * differ <= (bottom - top) * (a[:, 1] + b[:, 1])


def _handed_on(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes, most of them once."""
    seen: set[tuple[int, int]] = set()
    for pairs in found:
        if len(seen) > REMEMBERED:
            seen.clear()
        new = {(min(a, b), max(a, b)) for a, b in pairs.tolist()} - seen
        if new:
            seen |= new
            ends = np.array(sorted(new), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[np.ndarray]:
        for rows, lists in _listed(batches, PLAIN):
            a, b = rows[:-1], rows[1:]
            may = (lists[:-1] == lists[1:]) & _possible(a, b)
            yield np.column_stack([a[may, 2], b[may, 2]])

    return _handed_on(found())


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of members up to ``SPAN`` places apart; per list and distance one for every two components."""

    def found() -> Iterator[np.ndarray]:
        for rows, lists in _listed(batches, SKETCHED):
            for step in range(1, min(SPAN + 1, len(rows))):
                may = np.flatnonzero((lists[:-step] == lists[step:]) & _possible(rows[:-step], rows[step:]))
                may = may[_alike(rows[may], rows[may + step])]
                a, b = rows[may], rows[may + step]
                roots = np.sort(np.column_stack([a[:, 4], b[:, 4]]), axis=1)
                first = np.unique(np.column_stack([lists[may], roots]), axis=0, return_index=True)[1]
                yield np.column_stack([a[first, 2], b[first, 2]])

    return _handed_on(found())


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[np.ndarray]:
        for batch in batches:
            for left, right, same in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = _members(left), _members(right)
                for at in range(0, len(a), STRIP):
                    may = _possible(a[at : at + STRIP, None], b[None])
                    if same:
                        may &= np.arange(len(b))[None] > np.arange(at, at + len(may))[:, None]
                    i, j = np.nonzero(may)
                    for part in range(0, len(i), COMPARED):
                        x, y = a[at + i[part : part + COMPARED]], b[j[part : part + COMPARED]]
                        may = _alike(x, y)
                        yield np.column_stack([x[may, 2], y[may, 2]])

    return _handed_on(found())


def _not_ruled_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    top, bottom = SIMILARITY
    for batch in batches:
        for part in pieces(batch, column="ba"):
            differ = map(differing_bits, part.column("ba").to_pylist(), part.column("bb").to_pylist())
            sizes = part.column("na").to_numpy() + part.column("nb").to_numpy()
            keep = (top + bottom) * np.fromiter(differ, np.int64, part.num_rows) <= (bottom - top) * sizes
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, column="sa"):  # similar sets are about as large as each other
            sets = zip(part.column("sa"), part.column("sb"))
            keep = [similar(*(np.frombuffer(s.as_buffer(), np.uint64) for s in pair)) for pair in sets]
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def similar_links(texts: DataFrame, nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Links (a, b) of nodes that, with the known ones, connect what all pairs of similar sets connect.

    ``texts`` has name and text of all rows; ``nodes`` has every set once: node, size, bits and the name of a text.
    """
    members = texts.mapInArrow(_prefixes(*common_shingles(texts)), MEMBERS).withColumn("root", F.col("node"))
    lists = lists_of(members, "prefix-lists")
    shared = lists.select("members").mapInArrow(_exploded(PLAIN), MEMBERS)
    small = [nodes.select(F.col("node").alias(c), F.col("size").alias(f"n{c}"), F.col("bits").alias(f"b{c}")) for c in "ab"]

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = pairs.distinct().join(small[0], "a").join(small[1], "b").select("a", "b", "na", "nb", "ba", "bb")
        pairs = stored(pairs.mapInArrow(_not_ruled_out, "a long, b long"), f"{name}-candidates")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes, "node").select("name")
        sets = texts.join(stored(wanted, f"{name}-names"), "name", "left_semi").select("text")
        sets = sets.mapInArrow(_sets, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))
        sets = stored(sets, f"{name}-sets")
        ends = [sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab"]
        both = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "sa", "sb")
        links = stored(both.mapInArrow(_verified, "a long, b long"), name)
        forget(pairs, sets)
        return links

    chained = verified(lists.select("members").mapInArrow(_chained, "a long, b long"), "chained")
    roots = stored(components(known.unionByName(chained)), "chained-roots")
    briefs = nodes.select("node", "bits").mapInArrow(_briefs, "node long, brief binary")
    marks = briefs.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "brief")
    first, lists = lists, lists_of(shared.join(marks, "node").select(*MEMBER, "brief"), "chained-lists")
    forget(first)
    followed = verified(lists.select("members").mapInArrow(_followed, "a long, b long"), "followed")
    roots = stored(components(known.unionByName(chained).unionByName(followed)), "followed-roots")
    shared = lists.select("members").mapInArrow(_exploded(SKETCHED), f"{MEMBERS}, brief binary")
    rooted = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first, lists = lists, lists_of(rooted.select(*MEMBER, "brief"), "rooted-lists")
    forget(first)
    others = lists.toDF("shingle", "low_b", "high_b", "first_b", "b")
    top, bottom = SIMILARITY
    # A list lies in tiles in the order of sizes and nodes.
    tiles = lists.join(others, "shingle").where(
        f"(low < low_b OR low = low_b AND first <= first_b) AND {bottom} * high >= {top} * low_b"
    )
    tiles = tiles.select(F.col("members").alias("a"), "b", F.expr("low = low_b AND first = first_b").alias("same"))
    paired = verified(tiles.mapInArrow(_paired, "a long, b long"), "paired")
    forget(lists)
    return chained.unionByName(followed).unionByName(paired)


def _rooted(docs: DataFrame) -> DataFrame:
    """doc_id, name of the text and root for every row; equal roots are near copies."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_name().alias("name"), whole_text().alias("text"))
    rows = stored(texts.mapInArrow(_described, DESCRIBED), "near-rows")
    nodes = rows.groupBy("node").agg(*(F.min(c).alias(c) for c in ("size", "bits", "name")))
    nodes = stored(nodes, "near-nodes")
    prints = stored(rows.select("fp", "node").distinct(), "near-prints")
    first = stored(prints.groupBy("fp").agg(F.min("node").alias("first")), "near-first")
    same = prints.join(first, "fp").select(F.col("node").alias("a"), F.col("first").alias("b"))
    ends = [first.select(F.col("fp").alias(c), F.col("first").alias(f"first_{c}")) for c in "ab"]
    within = links_within(first.select("fp")).join(ends[0], "a").join(ends[1], "b")
    known = stored(same.unionByName(within.select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))), "near-known")
    links = known.unionByName(similar_links(texts.select("name", "text"), nodes, known))
    roots = stored(components(links), "near-roots")
    ids = rows.select("doc_id", "name", "node").join(roots, "node", "left")
    return stored(ids.select("doc_id", "name", F.coalesce("root", "node").alias("root")), "near-ids")


def text_name() -> Column:
    """128 bits that name a whole text."""
    return F.unhex(F.md5(whole_text()))


def near_copy_groups(docs: DataFrame) -> DataFrame:
    """doc_id and component_id (smallest doc_id reachable by links of either kind) for every row.

    Null and wordless texts are near copies of each other. Rows with a null doc_id take part in linking but
    never name a component; a component without any id has a null component_id. Repeated rows give repeated
    results. An empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    ids = _rooted(docs)
    smallest = stored(ids.groupBy("root").agg(F.min("doc_id").alias("component_id")), "near-names")
    return ids.join(smallest, "root").select("doc_id", "component_id")


def without_similar(docs: DataFrame) -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest id, rows without an id coming last.

    Among rows of that id, or without any, the text that comes first by its name stays, and among rows equal in both
    the one whose columns come first. Names are 128-bit hashes.
    """
    ids = _rooted(docs)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "name")
    # Counted, because only rows equal in id and text leave a choice.
    rows = ids.groupBy("root", "doc_id", "name").agg(F.count(F.lit(1)).alias("copies"))
    chosen = rows.groupBy("root").agg(F.min_by(F.struct("doc_id", "name", "copies"), row).alias("row")).select("row.*")
    chosen = stored(chosen.toDF("chosen_id", "chosen_name", "copies"), "near-chosen")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), text_name().alias("name"))
    kept = whole.join(chosen, (F.col("name") == F.col("chosen_name")) & F.col("id").eqNullSafe(F.col("chosen_id")))
    several = kept.where("copies > 1").groupBy("id", "name").agg(F.min("row").alias("row"))
    return kept.where("copies = 1").select("row").unionByName(several.select("row")).select("row.*")
