"""Packing documents into training sequences along a space-filling curve.

Token counts of a document are projected by hashed signs to a few dimensions; the Hilbert index of that
point is its place on the curve. Range partitions of (index, doc_id) hold the curve in pieces, every task
sums its piece, and one small row per task turns these sums into the position of every document in one
endless stream of tokens. The stream is cut every ``length`` tokens, so only its last stretch could need
padding; that is cut at powers of two instead, which need none.

Ids are computed once and written, compressed, to the shared folder; ordering moves only 40 bytes per
document, and the ids move once, to meet their positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import pieces, stored, whole_text
from strata.llm.tokens import word_tokens

LENGTH = 4096
END = 2
#: Dimensions of the curve and bits of each; their product is the length of the index.
DIMENSIONS, BITS = 4, 8
#: Length of the hashed document vectors that are projected.
BUCKETS = 1024
TOKENS_SCHEMA = "row long, doc_id long, curve long, n long, ids binary"
PIECES_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def mixed_bits(values: np.ndarray) -> np.ndarray:
    """A hash of integers whose bits are all usable."""
    x = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x


def hashed_signs() -> np.ndarray:
    """Rows of +1 and -1 per bucket of the document vectors, one column per dimension of the curve."""
    bits = mixed_bits(np.arange(BUCKETS))[:, None] >> np.arange(DIMENSIONS, dtype=np.uint64)
    return 2.0 * (bits & np.uint64(1)).astype(np.float64) - 1


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (n, dimensions) below 2**bits, by Skilling's transform."""
    x = points.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        for axis in x:
            flip = (axis & q) != 0
            swap = np.where(flip, 0, (x[0] ^ axis) & (q - 1))
            x[0] ^= np.where(flip, q - 1, 0)
            x[0] ^= swap
            axis ^= swap
        q >>= 1
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    twist = np.zeros(x.shape[1], np.int64)
    q = top
    while q > 1:
        twist ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= twist
    index = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | ((axis >> bit) & 1)
    return index


def place_on_curve(counted: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Curve index of projected counts; norms are those of the count vectors."""
    scaled = counted / np.maximum(norms, 1.0)[:, None]
    cells = (1 << BITS) / (1 + np.exp(-1.7 * scaled))  # near the normal distribution function
    return hilbert(np.minimum(cells.astype(np.int64), (1 << BITS) - 1))


def _tokenised(vocabulary: str):
    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, signs = word_tokens(vocabulary), zstandard.ZstdCompressor(level=1), hashed_signs()
        bucket = (mixed_bits(np.arange(1 << 16)) >> np.uint64(32)).astype(np.int64) % BUCKETS
        end, row = np.array([END], "<u2").tobytes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in pieces(batch, 4 << 20):
                n, packed = [], []
                vectors = np.zeros((part.num_rows, BUCKETS), np.float32)
                for k, text in enumerate(part.column("text").to_pylist()):
                    ids = words.ids(text) + end
                    values = np.frombuffer(ids, "<u2")
                    vectors[k] = np.bincount(bucket[values], minlength=BUCKETS)
                    n.append(len(values))
                    packed.append(packer.compress(ids))
                rows = np.arange(row, row + part.num_rows)
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows),
                        part.column("doc_id"),
                        pa.array(place_on_curve(vectors @ signs, np.sqrt((vectors**2).sum(1)))),
                        pa.array(n, pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["row", "doc_id", "curve", "n", "ids"],
                )

    return tokenised


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position of every row inside its range partition."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        ends = before + np.cumsum(n)
        if len(ends):
            before = int(ends[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(np.full(len(n), part)), pa.array(ends - n), batch.column("n")],
            names=["row", "part", "in_part", "n"],
        )


def _bounds(total: int, length: int) -> np.ndarray:
    """Where sequences of the last, incomplete stretch begin: its length as a sum of powers of two."""
    rest, begin, out = total % length, total - total % length, []
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            out.append(begin)
            begin += 1 << bit
    return np.array(out, np.int64)


def cut(begin: int, n: int, total: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of n tokens that begin at ``begin`` of the stream."""
    full, tails, at = total // length, _bounds(total, length), begin
    while at < begin + n:
        if at < full * length:
            sequence, offset, end = at // length, at % length, (at // length + 1) * length
        else:
            k = int(np.searchsorted(tails, at, "right")) - 1
            sequence, offset = full + k, at - int(tails[k])
            end = int(tails[k + 1]) if k + 1 < len(tails) else total
        end = min(end, begin + n)
        yield at - begin, end - at, sequence, offset
        at = end


def _cut(length: int):
    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        names = [field.split()[0] for field in PIECES_SCHEMA.split(", ")]
        for batch in batches:
            for part in pieces(batch, 2 << 20, "ids"):
                rows = []
                for doc_id, packed, n, begin, total in zip(*(c.to_pylist() for c in part.columns)):
                    ids = np.frombuffer(unpacker.decompress(packed), "<u2").astype("<u4")
                    for start, size, sequence, offset in cut(begin, n, total, length):
                        rows.append((doc_id, start, size, n, sequence, offset, ids[start : start + size].tobytes()))
                kinds = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names
                )

    return cut_rows


def packed(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, doc_tokens, sequence_id, offset and ids.

    ``ids`` are little-endian unsigned 32-bit integers; every document ends with id 2, so an empty or null
    text is one token. Repeated rows are packed as often as they occur, null ids are kept, documents equal
    in place and id may change places. A very long text spans sequences. An empty table gives an empty
    result; columns other than doc_id and text are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    tokens = stored(texts.mapInArrow(_tokenised(vocabulary), TOKENS_SCHEMA), "tokens")
    along = ("curve", "doc_id", "row")
    placed = stored(
        tokens.select(*along, "n")
        .repartitionByRange(*along)
        .sortWithinPartitions(*along)
        .mapInArrow(_running, "row long, part long, in_part long, n long"),
        "places",
    )
    sums = placed.groupBy("part").agg(F.sum("n").alias("size"))
    order = Window.orderBy("part")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: as many as shuffle partitions, whatever the input.
    parts = sums.select(
        "part",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"),
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    where = placed.join(F.broadcast(parts), "part").select(
        "row", (F.col("before") + F.col("in_part")).alias("begin"), "total"
    )
    located = tokens.select("row", "doc_id", "ids", "n").join(where, "row")
    return located.select("doc_id", "ids", "n", "begin", "total").mapInArrow(_cut(length), PIECES_SCHEMA)


def piece_digests(packed_pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 in place of their ids."""
    return packed_pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
