"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into cells by the population counts of their four 16-bit quarters. A
differing bit changes one of these counts by one, so two fingerprints within the radius lie in cells whose
counts differ by at most the radius in sum: all other tile pairs are skipped without being read. Cells
are cut into tiles of bounded size; for each pair of tiles that is left, numpy compares all pairs by
exclusive or and bit count. Nothing is missed and no bucket is capped.

Equal fingerprints are one node, and a tile pair hands on a spanning forest of its links, so a group of
near copies costs links in proportion to its size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from strata.llm.common import pieces, stored, utf8, whole_text
from strata.llm.components import components

SEED = 42
WORDS_PER_SHINGLE = 3
RADIUS = 3
#: Fingerprints in a tile: two tiles and their comparison stay within a few MB.
TILE = 2048
#: Rows of a tile compared at once.
STRIP = 256
#: Shingles hashed at once.
SHINGLES = 1 << 16
#: Linked fingerprints a task remembers to leave out links that connect nothing new.
REMEMBERED = 1 << 20


def fingerprint(text: bytes, size: int = WORDS_PER_SHINGLE) -> int:
    """64 bits, each set if over half of the shingle hashes have it; no words give 0."""
    words = text.lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    if len(words) < size:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(itertools.islice(words, k, None) for k in range(size)))), len(words) - size + 1
    hashes, ones = map(xxh64_intdigest, shingles, repeat(SEED)), np.zeros(64, np.int64)
    for done in range(0, n, SHINGLES):
        block = np.fromiter(itertools.islice(hashes, SHINGLES), "<u8", min(SHINGLES, n - done))
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            values = np.fromiter(map(fingerprint, utf8(part.column("text"))), np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"]
            )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long) for every row; null counts as an empty text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(_prints, "doc_id long, fp long")


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, fp) sorted by cell become rows (cell, tile)."""
    rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    for cell, same in itertools.groupby(rows, key=lambda row: row[0]):
        values = (fp for _, fp in same)
        while len(tile := np.fromiter(itertools.islice(values, TILE), np.int64)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([cell], pa.int32()), pa.array([tile[0]]), pa.array([tile.tobytes()], pa.binary())],
                names=["cell", "first", "tile"],
            )


def forest_of_pair(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links within the radius between two tiles, or inside one."""
    nodes = a if same else np.concatenate([a, b])
    labels, shift = np.arange(len(nodes)), 0 if same else len(a)
    for start in range(0, len(a), STRIP):
        near = np.bitwise_count(a[start : start + STRIP, None] ^ b[None, :]) <= radius
        if same:
            near &= np.arange(len(b))[None, :] > np.arange(start, start + len(near))[:, None]
        for row in np.flatnonzero(near.any(axis=1)):
            i, others = start + row, np.flatnonzero(near[row]) + shift
            found, where = np.unique(labels[others], return_index=True)
            new = found != labels[i]
            if new.any():
                for other in others[where[new]]:
                    yield int(nodes[i]), int(nodes[other])
                labels[np.isin(labels, found[new])] = labels[i]


class Forest:
    """Union-find over what a task has linked."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def joins(self, a: int, b: int) -> bool:
        """Whether the link connects two trees; they are one tree from then on."""
        if len(self.parent) > REMEMBERED:
            self.parent.clear()
        a, b = self.root(a), self.root(b)
        self.parent[a] = b
        return a != b

    def root(self, node: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = parent.setdefault(up, up)
            node = up
        return node


def _links(radius: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            found = []
            for a, b, same in zip(*(c.to_pylist() for c in batch.columns)):
                pairs = forest_of_pair(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), same, radius)
                found += [pair for pair in pairs if forest.joins(*pair)]
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    return links


def neighbour_offsets(radius: int) -> list[int]:
    """Differences between the numbers of cells within the radius; of each pair of cells one direction."""
    steps = itertools.product(range(-radius, radius + 1), repeat=4)
    numbers = (sum(s << (5 * k) for k, s in enumerate(step)) for step in steps if sum(map(abs, step)) <= radius)
    return sorted(n for n in numbers if n >= 0)


def links_within(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column fp) exactly as all pairs within the radius do."""
    # Five bits hold a count of 0 to 16 and keep steps over its ends from meeting another cell.
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(4)]
    cell = sum((F.shiftleft(c, 5 * k) for k, c in enumerate(counts)), F.lit(0)).cast("int")
    celled = prints.select(cell.alias("cell"), "fp")
    tiles = stored(
        celled.repartitionByRange("cell", "fp")
        .sortWithinPartitions("cell", "fp")
        .mapInArrow(_tiles, "cell int, first long, tile binary"),
        "tiles",
    )
    offsets = F.array(*map(F.lit, neighbour_offsets(radius)))
    left = tiles.select("first", "tile", F.explode(offsets).alias("step"), "cell").select(
        F.col("first").alias("first_a"), F.col("tile").alias("a"), "step", (F.col("cell") + F.col("step")).alias("cell")
    )
    pairs = left.join(tiles.select("cell", "first", F.col("tile").alias("b")), "cell").where(
        "step > 0 OR first_a <= first"
    )
    pairs = pairs.select("a", "b", F.expr("step = 0 AND first_a = first").alias("same"))
    return pairs.mapInArrow(_links(radius), "a long, b long")


def near_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint and component_id (smallest doc_id reachable) for every row.

    Null and wordless texts have fingerprint zero and link like any other. Rows with a null doc_id take
    part in linking but never name a component; a component without any id has a null component_id.
    Repeated rows give repeated results. An empty table gives an empty result. Columns other than doc_id
    and text are not read.
    """
    prints = stored(fingerprints(docs), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = components(links_within(nodes, radius)).withColumnRenamed("node", "fp")
    linked = nodes.join(roots, "fp")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("linked_id"))
    named = linked.join(smallest, "root").select("fp", "linked_id", F.lit(True).alias("linked"))
    ids = nodes.join(named, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("linked_id")).otherwise(F.col("first_id")).alias("component_id")
    )
    # Written, so that the join below reads two plain shuffles and a hot fingerprint can be split.
    ids = stored(ids, "simhash-ids")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(ids, "fp").select("doc_id", text.alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """Documents whose id is the smallest of their group, with all their columns.

    Rows repeating an id share its fate: they go only if no row of that id names its group. Rows without
    an id cannot be named in a group and stay.
    """
    ids = near_groups(docs).groupBy("doc_id").agg(F.max(F.expr("doc_id = component_id")).alias("stays"))
    gone = stored(ids.where("NOT stays").select(F.col("doc_id").alias("gone_id")), "near-copies")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
