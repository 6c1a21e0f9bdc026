"""Exact top-k inner products by branch and bound over ball trees.

The vectors are dealt into shards, each with a ball tree of its own. A node's centre c and radius r bound the
inner product of a query q with anything below it by q.c + |q| r. A first pass looks only into the leaf of each
group of shards that promises most and thereby finds, per query, a kth score that the result must reach at least;
that score is shared with all groups. The second pass visits the leaves whose bound reaches the current kth score.
Ties survive, because only smaller bounds are pruned.

Groups of shards and groups of query blocks form a grid. A task holds one cell: its shards, met by one block
after the other, so each byte is shuffled once per row or column of the grid, and not once per pair of shard and
block. Most leaves are scored for many queries by one matrix product, in single precision where that is exact.
Bounds are widened by their rounding; scores are whole numbers and exact, also where doubles no longer are.
"""

from __future__ import annotations

import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heapify, heapreplace
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

#: Vectors in a shard and in a leaf of its tree, and queries in a block.
SHARD, LEAF, BLOCK = 32768, 256, 512
#: Blocks that travel as one row, and queries of them that meet a leaf at once.
TOGETHER, CHUNK = 32, 1024
#: Bytes of a shard as doubles, and of the shards or the queries of a cell.
SHARD_BYTES, HELD_BYTES = 16 << 20, 64 << 20
#: Rows of a leaf whose largest score is looked at first.
STRIP = 32
K = 5
#: No score yet, and the largest one of a long; scores beyond stand as plus or minus this number.
NOTHING, LARGEST = -(2**63), 2**63 - 1


def wrapped(values: np.ndarray) -> np.ndarray:
    """Whole doubles modulo 2**64, as signed integers."""
    size = np.abs(np.fmod(values, 2.0**64)).astype(np.uint64).view(np.int64)
    return np.where(values < 0, -size, size)


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))


def inner(queries: np.ndarray, vectors: np.ndarray, room: np.ndarray | None = None) -> np.ndarray:
    """Exact inner products (queries, vectors) of whole doubles; those that a long cannot hold are cut to LARGEST.

    Doubles are exact while the product of the lengths is below 2**53. Above, they only tell whether a long holds
    the score, whose digits then follow modulo 2**64; pairs too near that limit to tell are summed as Python integers.
    Floats are given only where the product of the lengths is below 2**24, and the scores then are floats, in ``room``.
    """
    if queries.dtype == np.float32:
        n = len(queries) * len(vectors)
        room = np.empty(n, np.float32) if room is None or room.size < n else room[:n]
        return np.matmul(queries, vectors.T, out=room.reshape(len(queries), len(vectors)))
    scores = queries @ vectors.T
    lengths = np.sqrt((queries**2).sum(1))[:, None] * np.sqrt((vectors**2).sum(1))
    if lengths.max(initial=0.0) < 2.0**52:
        return scores.astype(np.int64)
    error = 4.0 * queries.shape[1] * 2.0**-53 * lengths
    exact = wrapped(queries) @ wrapped(vectors).T
    exact = np.where(np.abs(scores) - error >= 2.0**63, np.where(scores > 0, LARGEST, -LARGEST), exact)
    for i, j in zip(*np.nonzero(np.abs(np.abs(scores) - 2.0**63) <= error + 2.0**12)):
        score = sum(int(a) * int(b) for a, b in zip(queries[i].tolist(), vectors[j].tolist()))
        exact[i, j] = max(-LARGEST, min(score, LARGEST))
    return exact


class Balls:
    """Bounds of the balls (centres, radii); ``rows`` of the ``leaves``, each of which is below one of the ``roots``."""

    def __init__(self, centres: np.ndarray, radii: np.ndarray, leaves: np.ndarray, roots: np.ndarray, under: np.ndarray):
        self.centres, self.radii, self.leaves, self.roots, self.under = centres, radii, leaves, roots, under
        self.far = np.sqrt((self.centres**2).sum(1)) + self.radii
        self.wide: dict = {}

    def bounds(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Upper bounds (queries, nodes) of inner products, widened by what rounding may hide."""
        lengths = np.sqrt((queries**2).sum(1))[:, None]
        reach = queries @ self.centres[nodes].T + lengths * self.radii[nodes]
        return reach + 1e-9 * (np.abs(reach) + lengths * (self.far[nodes] + 1)) + 1e-6

    def reach(self, wide_queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """The same (nodes, queries) by one matrix product with rows (query, length), in their precision."""
        kind = wide_queries.dtype
        if kind not in self.wide:
            error = 4 * (self.centres.shape[1] + 16) * float(np.finfo(kind).eps)
            self.wide[kind] = np.column_stack([self.centres, self.radii + error * (self.far + 1)]).astype(kind)
        return self.wide[kind][nodes] @ wide_queries.T


class BallTree(Balls):
    """Balls over the rows of ``vectors``; leaves hold at most LEAF rows each."""

    def __init__(self, vectors: np.ndarray) -> None:
        children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        centres, radii = [], []
        todo = [np.arange(len(vectors))]
        while len(self.rows) < len(todo):
            rows = todo[len(self.rows)]
            points = vectors[rows]
            centre = points.mean(0)
            apart = ((points - centre) ** 2).sum(1)
            centres.append(centre)
            radii.append(np.sqrt(apart.max()))
            self.rows.append(rows)
            if len(rows) <= LEAF:
                children.append(None)
                continue
            far = points[apart.argmax()]
            other = points[((points - far) ** 2).sum(1).argmax()]
            order = np.argsort(points @ (other - far), kind="stable")
            half = len(rows) // 2
            children.append((len(todo), len(todo) + 1))
            todo += [rows[order[:half]], rows[order[half:]]]
        for node, below in enumerate(children):
            if below:
                self.rows[node] = np.zeros(0, np.int64)
        leaves = np.array([k for k, c in enumerate(children) if c is None])
        super().__init__(np.array(centres), np.array(radii), leaves, np.array([0]), np.zeros(len(leaves), np.int64))


class Forest(Balls):
    """The trees of the shards (ids, vectors, tree) of a cell, with vectors of one size."""

    def __init__(self, size: int, shards: list[tuple[bytes, bytes, bytes]]) -> None:
        ids = [np.frombuffer(i, np.int64) for i, _, _ in shards]
        self.ids = np.concatenate(ids)
        self.whole = [unpacked(v, len(i), size) for i, (_, v, _) in zip(ids, shards)]
        self.longest = max(lengths_of(v).max() for v in self.whole)
        self.kinds: dict = {}
        counts, centres, radii = zip(*(pickle.loads(tree) for _, _, tree in shards))
        ends = np.cumsum(np.concatenate(counts)).tolist()
        self.rows = [slice(a, b) for a, b in zip([0, *ends], ends)]
        super().__init__(
            np.concatenate([c[1:] for c in centres] + [c[:1] for c in centres]),
            np.concatenate([r[1:] for r in radii] + [r[:1] for r in radii]),
            np.arange(len(ends)),
            len(ends) + np.arange(len(shards)),
            np.repeat(np.arange(len(shards)), [len(c) for c in counts]),
        )

    def vectors(self, kind: type) -> np.ndarray:
        if kind not in self.kinds:
            self.kinds[kind] = np.concatenate([v.astype(kind) for v in self.whole])
        return self.kinds[kind]


class Best:
    """The k best (score, id) per query so far: larger scores first, then smaller ids."""

    def __init__(self, n: int, k: int, floor: np.ndarray) -> None:
        self.scores = np.full((n, k), NOTHING, np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = floor
        self.noted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.limits: dict = {}
        self.room = np.empty(0, np.float32)

    def kth(self, kind: type | None = None) -> np.ndarray:
        """The score to reach, as it is or rounded to ``kind``."""
        if kind not in self.limits:
            whole = self.limits[None] = np.maximum(self.scores[:, -1], self.floor)
            self.limits[kind] = whole if kind is None else whole.astype(kind)
        return self.limits[kind]

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.scores.shape[1]
        scores = np.concatenate([self.scores[which], np.asarray(scores).astype(np.int64)], axis=1)
        ids = np.concatenate([self.ids[which], np.broadcast_to(ids, (len(which), ids.shape[-1]))], axis=1)
        order = np.lexsort((ids, ~scores), axis=1)[:, :k]  # ~ turns the order round and cannot overflow
        self.scores[which] = np.take_along_axis(scores, order, 1)
        self.ids[which] = np.take_along_axis(ids, order, 1)
        self.limits = {}

    def note(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Single scores, a query each, that count when there are as many as queries, or when settled."""
        self.noted.append((which, scores.astype(np.int64), ids))
        self.waiting += len(which)
        if self.waiting >= len(self.scores):
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        which, scores, ids = (np.concatenate(x) for x in zip(*self.noted))
        self.noted, self.waiting, k = [], 0, self.scores.shape[1]
        order = np.lexsort((ids, ~scores, which))
        which, scores, ids = which[order], scores[order], ids[order]
        first = np.r_[True, which[1:] != which[:-1]]
        group = np.cumsum(first) - 1
        place = np.arange(len(which)) - np.flatnonzero(first)[group]
        top = place < k
        few = group[top], place[top]
        padded = np.full((group[-1] + 1, k), NOTHING, np.int64), np.full((group[-1] + 1, k), np.iinfo(np.int64).max)
        padded[0][few], padded[1][few] = scores[top], ids[top]
        self.add(which[first], *padded)


def look_into(
    tree: Balls, vectors: np.ndarray, ids: np.ndarray, best: Best, queries: np.ndarray, own: np.ndarray, leaf: int,
    which: np.ndarray,
) -> None:
    """Score one leaf for some of the queries; a query's own row takes no part."""
    rows, n, everyone = tree.rows[leaf], len(which), len(which) == len(queries)
    points = vectors[rows]
    if queries.dtype == np.float32 and best.room.size < len(points) * n:
        best.room = np.empty(len(points) * n, np.float32)
    scores = inner(points, queries if everyone else queries[which], best.room)
    kth = best.kth(np.float32 if scores.dtype == np.float32 else None)
    kth = kth if everyone else kth[which]
    whole = len(scores) - len(scores) % STRIP
    tops = scores[:whole].reshape(-1, STRIP, n).max(1)
    if whole < len(scores):
        tops = np.concatenate([tops, scores[whole:].max(0)[None]])
    strip, at = np.divmod(np.flatnonzero(tops >= kth), n)
    if not len(at):
        return
    near = scores.ravel().take((strip * STRIP * n + at)[:, None] + np.arange(STRIP) * n, mode="clip")
    hit, row = np.divmod(np.flatnonzero(near >= kth[at][:, None]), STRIP)
    score, row, at = near[hit, row], strip[hit] * STRIP + row, at[hit]
    inside = row < len(scores)
    which, found, score = which[at[inside]], ids[rows][row[inside]], score[inside]
    # Of equal scores the larger ids are no better than what is there.
    fit = (found != own[which]) & ((score != best.scores[which, -1]) | (found < best.ids[which, -1]))
    best.note(which[fit], score[fit], found[fit])


def widened(queries: np.ndarray) -> np.ndarray:
    """Rows (query, length) for ``Balls.reach``."""
    return np.column_stack([queries, lengths_of(queries)]).astype(queries.dtype)


def glimpse(tree: Balls, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """(queries, k): the k best scores in each query's most promising leaf, or NOTHING."""
    out = np.full((len(queries), k), NOTHING, np.int64)
    wide = widened(queries)
    first = np.concatenate([tree.reach(wide[a : a + CHUNK], tree.leaves).argmax(0) for a in range(0, len(queries), CHUNK)])
    order = np.argsort(first, kind="stable")
    for which in np.split(order, np.flatnonzero(np.diff(first[order])) + 1):
        rows = tree.rows[tree.leaves[first[which[0]]]]
        scores = inner(queries[which], vectors[rows])
        if scores.dtype == np.float32:
            scores = scores.astype(np.int64)
        scores[ids[rows] == own[which][:, None]] = NOTHING
        if scores.shape[1] > k:
            scores = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k:]
        out[which, : scores.shape[1]] = scores
    return out


def search(
    tree: Balls, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int
) -> Best:
    """Branch and bound for some queries; ``floor`` is the shared kth score."""
    best, wide, all_of_them = Best(len(queries), k, floor), widened(queries), np.arange(len(queries))
    alive = (tree.reach(wide, tree.roots) >= best.kth()).any(1)
    leaves = tree.leaves[alive[tree.under]]
    if not len(leaves):
        return best
    bounds = tree.reach(wide, leaves)
    # Queries without any kth score look into their most promising leaf before all others.
    fresh = np.flatnonzero(floor <= NOTHING)
    first = bounds[:, fresh].argmax(0)
    for at in np.unique(first):
        which = fresh[first == at]
        look_into(tree, vectors, ids, best, queries, own, int(leaves[at]), which)
        bounds[at, which] = -np.inf
    best.settle()
    for at in np.argsort(-bounds.max(1), kind="stable"):
        bound = bounds[at]
        live = np.flatnonzero((bound >= best.kth(bound.dtype.type)) & (bound > -np.inf))
        if not len(live):
            continue
        if 2 * len(live) > len(queries) and not len(fresh):
            live = all_of_them  # cheaper than to pick out their rows
        look_into(tree, vectors, ids, best, queries, own, int(leaves[at]), live)
    best.settle()
    return best


def needed(ids: list[int], k: int) -> int:
    """How many of the sorted ids of equal vectors can be among any query's k best, its own id left out."""
    seen: Counter = Counter()
    for n, one in enumerate(ids, 1):
        seen[one] += 1
        if n - max(seen.values()) >= k:
            return n
    return len(ids)


def without_surplus(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows that matter: of equal vectors only so many of the smallest ids as any query can ask for."""
    width = vectors.shape[1] * vectors.itemsize
    words = np.zeros((len(vectors), -(-width // 8) * 8), np.uint8)
    words[:, :width] = np.ascontiguousarray(vectors).view(np.uint8)
    factors = np.random.default_rng(0).integers(1, 2**63, words.shape[1] // 8, np.uint64) * np.uint64(2) + np.uint64(1)
    # Equal vectors have equal sums; only those of common sums are compared.
    _, which, counts = np.unique((words.view(np.uint64) * factors).sum(1), return_inverse=True, return_counts=True)
    common = np.flatnonzero(counts[which] > k)
    if not len(common):
        return np.arange(len(ids))
    whole = words[common].view(np.dtype((np.void, words.shape[1]))).ravel()
    _, group = np.unique(whole, return_inverse=True)
    order = np.lexsort((ids[common], group))
    bounds = np.r_[0, np.flatnonzero(np.diff(group[order])) + 1, len(order)]
    keep = np.ones(len(ids), bool)
    for g in np.flatnonzero(np.diff(bounds) > k):
        rows = common[order[bounds[g] : bounds[g + 1]]]
        keep[rows[needed(ids[rows].tolist(), k) :]] = False
    return np.flatnonzero(keep)


def _floors(lists: pa.Array) -> np.ndarray:
    """floor(256 x) of every component."""
    return np.floor(256.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))


def packed(vectors: np.ndarray) -> np.ndarray:
    """The same numbers in two bytes each, if they all fit."""
    small = vectors.size == 0 or max(vectors.max(), -vectors.min()) < 2**15
    return vectors.astype(np.int16) if small else vectors.astype(np.float64)


def unpacked(vectors: bytes, n: int, size: int) -> np.ndarray:
    """What ``packed`` made of n vectors, by their number of bytes."""
    return np.frombuffer(vectors, np.int16 if len(vectors) == 2 * n * size else np.float64).reshape(n, size)


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(256 x) of every component, as bytes of doubles."""
    for batch in batches:
        values = _floors(batch.column("embedding"))
        ends = np.cumsum(batch.column("size").to_numpy())[:-1]
        vectors = [part.tobytes() for part in np.split(values, ends)] if batch.num_rows else []
        yield pa.RecordBatch.from_arrays(
            [batch.column("size"), batch.column("vec_id"), pa.array(vectors, pa.binary())],
            names=["size", "vec_id", "vector"],
        )


def _row(kinds: dict[str, pa.DataType], *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds.values())], names=list(kinds))


def _shards(size_limit: int, k: int):
    """Rows (size, vec_id, embedding) become shards (size, weight, ids, vectors, tree), ordered by the tree's leaves."""
    kinds = {"size": pa.int32(), "weight": pa.int64(), "ids": pa.binary(), "vectors": pa.binary(), "tree": pa.binary()}

    def shard(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, vectors = (np.concatenate(x) for x in zip(*held))
        matter = without_surplus(ids, vectors, k)
        ids, vectors = ids[matter], vectors[matter]
        tree = BallTree(vectors.astype(np.float64))
        order = np.concatenate([tree.rows[leaf] for leaf in tree.leaves])
        nodes = np.r_[0, tree.leaves]
        kept = pickle.dumps(([len(tree.rows[leaf]) for leaf in tree.leaves], tree.centres[nodes], tree.radii[nodes]))
        ids, size, vectors = ids[order].tobytes(), vectors.shape[1], vectors[order].tobytes()
        return _row(kinds, size, len(ids) + len(vectors), ids, vectors, kept)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict = defaultdict(list)
        for batch in batches:
            sizes, ids, values = batch.column("size").to_numpy(), batch.column("vec_id").to_numpy(), _floors(batch.column("embedding"))
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                limit = min(size_limit, max(1, SHARD_BYTES // (8 * size)))
                mine = np.flatnonzero(sizes == size)
                for a in range(0, len(mine), limit):
                    some = mine[a : a + limit]
                    vectors = values[starts[some][:, None] + np.arange(size)]
                    room = limit - sum(len(i) for i, _ in held[size])
                    held[size].append((ids[some[:room]], packed(vectors[:room])))
                    if len(some) >= room:
                        yield shard(held.pop(size))
                        if len(some) > room:
                            held[size].append((ids[some[room:]], packed(vectors[room:])))
            if sum(v.nbytes for parts in held.values() for _, v in parts) > HELD_BYTES:
                yield from (shard(held.pop(size)) for size in list(held))
        yield from (shard(parts) for parts in held.values())

    return shards


def _blocks(limit: int):
    """Rows (size, vec_id, vector) sorted by size become blocks of queries (size, weight, own, queries)."""
    kinds = {"size": pa.int32(), "weight": pa.int64(), "own": pa.binary(), "queries": pa.binary()}

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        for size, same in groupby(rows, key=lambda row: row[0]):
            while some := list(islice(same, min(limit, max(1, SHARD_BYTES // (8 * size))))):
                own = np.array([r[1] for r in some], np.int64).tobytes()
                queries = packed(np.frombuffer(b"".join(r[2] for r in some))).tobytes()
                yield _row(kinds, size, len(own) + len(queries), own, queries)

    return blocks


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(block, forest, vectors, own, queries, floor) of a cell's blocks that meet vectors of their size."""
    shards: defaultdict = defaultdict(list)
    forests: dict[int, Forest] = {}
    for batch in batches:
        for is_block, key, size, ids, data, extra in zip(*(c for c in batch.columns)):
            size, ids, data, extra = size.as_py(), ids.as_buffer(), data.as_buffer(), extra.as_py()
            if not is_block.as_py():
                shards[size].append((ids.to_pybytes(), data.to_pybytes(), extra))
                continue
            if size in shards:
                forests[size] = Forest(size, shards.pop(size))
            if size not in forests:
                continue
            own, forest = np.frombuffer(ids, np.int64), forests[size]
            queries = unpacked(data, len(own), size)
            exact = lengths_of(queries).max() * forest.longest < 2.0**24 * 0.999
            kind = np.float32 if exact else np.float64
            floor = np.full(len(own), NOTHING, np.int64) if extra is None else np.frombuffer(extra, np.int64)
            yield key.as_py(), forest, forest.vectors(kind), own, queries.astype(kind), floor


def _glimpsed(k: int):
    kinds = {"key": pa.int64(), "scores": pa.binary()}

    def glimpsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, forest, vectors, own, queries, _ in _met(batches):
            yield _row(kinds, block, glimpse(forest, vectors, forest.ids, queries, own, k).tobytes())

    return glimpsed


def _shared(k: int):
    """Rows (block, scores) sorted by block become (block, floors): each query's kth best score of all."""
    kinds = {"key": pa.int64(), "floors": pa.binary()}

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*b.columns))
        for block, same in groupby(rows, key=lambda row: row[0].as_py()):
            top = np.zeros((0, k), np.int64)
            for _, scores in same:
                scores = np.frombuffer(scores.as_buffer(), np.int64).reshape(-1, k)
                top = np.sort(np.concatenate([top, scores], axis=1), axis=1)[:, -k:] if len(top) else np.sort(scores, axis=1)
            yield _row(kinds, block, np.ascontiguousarray(top[:, 0]).tobytes())

    return shared


FOUND = {"key": pa.int64(), "own": pa.binary(), "which": pa.binary(), "ids": pa.binary(), "scores": pa.binary()}


def _searched(k: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, forest, vectors, own, queries, floor in _met(batches):
            parts = []
            for a in range(0, len(own), CHUNK):
                b = a + CHUNK
                best = search(forest, vectors, forest.ids, queries[a:b], own[a:b], floor[a:b], k)
                which, place = np.nonzero(best.scores > NOTHING)
                parts.append(((which + a).astype(np.int32), best.ids[which, place], best.scores[which, place]))
            which, ids, scores = (np.concatenate(x).tobytes() for x in zip(*parts))
            yield _row(FOUND, block, own.tobytes(), which, ids, scores)

    return searched


def _merged(k: int):
    """Rows of FOUND sorted by block become the k best (query_id, vec_id, score) of every query."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*b.columns))
        for _, same in groupby(rows, key=lambda row: row[0].as_py()):
            best = None
            for _, own, which, ids, scores in same:
                if best is None:
                    own = np.frombuffer(own.as_buffer(), np.int64)
                    asked, best = own, Best(len(own), k, np.full(len(own), NOTHING))
                parts = [np.frombuffer(x.as_buffer(), t) for x, t in ((which, np.int32), (scores, np.int64), (ids, np.int64))]
                best.note(*parts)
                best.settle()
            which, place = np.nonzero(best.scores > NOTHING)
            for a in range(0, len(which), 10_000):
                w, p = which[a : a + 10_000], place[a : a + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked[w]), pa.array(best.ids[w, p]), pa.array(best.scores[w, p])],
                    names=["query_id", "vec_id", "score"],
                )

    return merged


def usable(vectors: DataFrame) -> DataFrame:
    """(size, vec_id, embedding) of every row that takes part: an id and only finite components."""
    taking_part = F.expr(
        "vec_id IS NOT NULL AND size(embedding) > 0 AND "
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    return vectors.where(taking_part).select(
        F.size("embedding").alias("size"), F.col("vec_id").cast("long").alias("vec_id"), "embedding"
    )


def quantised(vectors: DataFrame) -> DataFrame:
    """(size, vec_id, vector) of every row that takes part."""
    return usable(vectors).mapInArrow(_points, "size int, vec_id long, vector binary")


def dealt(weights: list[tuple[int, int]], groups: int) -> list[tuple[int, int]]:
    """(key, group) for every (key, weight), the groups about equally heavy."""
    heap = [(0, g) for g in range(groups)]
    heapify(heap)
    out = []
    for key, weight in sorted(weights, key=lambda x: (-x[1], x[0])):
        load, group = heap[0]
        heapreplace(heap, (load + weight, group))
        out.append((key, group))
    return out


def grid(shards: int, blocks: int, partitions: int) -> tuple[int, int]:
    """Groups of shards and of blocks, by their bytes in all.

    One cell per partition, but only so many that about twice the bytes are shuffled, and so many that none is too large.
    """
    shards, blocks = max(shards, 1), max(blocks, 1)
    cells = max(1, min(partitions, (shards + blocks) ** 2 // (shards * blocks)))
    few = max(1, round((cells * min(shards, blocks) / max(shards, blocks)) ** 0.5))
    many = -(-cells // few)
    rows, columns = (few, many) if shards < blocks else (many, few)
    return max(rows, -(-shards // HELD_BYTES)), max(columns, -(-blocks // HELD_BYTES))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k best other rows for each row (vec_id, embedding) of ``queries``.

    Scores are exact inner products of floor(256 x), ties go to the smaller vec_id; one among the k best that a long
    cannot hold is an error. Rows without an id,
    with a null or empty vector, or with null or non-finite components take no part on either side; vectors
    of different lengths never meet. Repeated rows of ``vectors`` are rows of their own, but none with the
    query's own id counts; of repeated query ids the smallest vector asks. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    shards = usable(vectors).mapInArrow(_shards(SHARD, k), "size int, weight long, ids binary, vectors binary, tree binary")
    shards = stored(shards.withColumn("key", F.monotonically_increasing_id()), "shards")
    asked = quantised(queries).groupBy("size", "vec_id").agg(F.min("vector").alias("vector"))
    blocks = asked.sortWithinPartitions("size").mapInArrow(_blocks(BLOCK * TOGETHER), "size int, weight long, own binary, queries binary")
    blocks = stored(blocks.withColumn("key", F.monotonically_increasing_id()), "queries")

    # One small row per shard and per block reaches the driver.
    weights = [[tuple(r) for r in x.select("key", "weight").collect()] for x in (shards, blocks)]
    sums = [sum(w for _, w in x) for x in weights]
    n_rows, n_columns = grid(*sums, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_rows, n_columns = max(1, min(n_rows, len(weights[0]))), max(1, min(n_columns, len(weights[1])))
    row_of, column_of = (
        F.broadcast(spark.createDataFrame(dealt(x, n), "key long, group int")) for x, n in zip(weights, (n_rows, n_columns))
    )
    every = {n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (n_rows, n_columns)}

    def in_cells(extra: DataFrame | None) -> DataFrame:
        """Shards and then blocks of each cell, a cell in a partition."""
        placed = shards.join(row_of, "key").withColumn("other", every[n_columns]).select(
            (F.col("group") * n_columns + F.col("other")).alias("cell"), F.lit(False).alias("is_block"),
            "key", "size", "ids", F.col("vectors").alias("data"), F.col("tree").alias("extra"),
        )
        asking = blocks.withColumn("floors", F.lit(None).cast("binary")) if extra is None else blocks.join(extra, "key", "left")
        asking = asking.join(column_of, "key").withColumn("other", every[n_rows]).select(
            (F.col("other") * n_columns + F.col("group")).alias("cell"), F.lit(True).alias("is_block"),
            "key", "size", F.col("own").alias("ids"), F.col("queries").alias("data"), F.col("floors").alias("extra"),
        )
        cells = placed.unionByName(asking).repartitionById(n_rows * n_columns, "cell")
        return cells.sortWithinPartitions("is_block", "key").drop("cell")

    glimpses = in_cells(None).mapInArrow(_glimpsed(k), "key long, scores binary")
    floors = glimpses.repartition("key").sortWithinPartitions("key").mapInArrow(_shared(k), "key long, floors binary")
    found = in_cells(stored(floors, "queries-kth")).mapInArrow(
        _searched(k), "key long, own binary, which binary, ids binary, scores binary"
    )
    found = found.repartition("key").sortWithinPartitions("key").mapInArrow(_merged(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    too_large = F.abs("score") == LARGEST
    refused = F.raise_error(F.concat(F.lit("a long cannot hold the score of vectors "), "query_id", F.lit(" and "), "vec_id"))
    return found.select(
        "query_id", "rank", "vec_id", F.when(too_large, refused.cast("long")).otherwise(F.col("score")).alias("score")
    )
