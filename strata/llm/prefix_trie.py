"""Prefix trie of conversations by the Euler-tour technique.

Conversations that begin with the same turns share a path of the trie. A prefix is named by its depth and by
the sum of hashes of its turns, each hashed together with its position: sums can be formed along a conversation
in slices, so one conversation of any length needs no task of its own.

Every node contributes an enter and an exit arc to a tour around the trie. Siblings are numbered next to
each other, so both neighbours of an arc follow from numbers of the node, its parent and its children. The
tour is ranked by contraction: in each round, arcs whose random number exceeds those of both neighbours are
taken out and their length is handed to the arc before; when few arcs are left they are ranked in one
task, and the others get their place from the arc behind them, round by round. Subtree sums are differences
of prefix sums at the exit and the enter arc.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import numbered, stored
from strata.operators.ordered import running_sum, with_slices

#: Conversations of so many ids share a beginning, of fewer turns than this.
FAMILY, MOST_SHARED = 100, 6
#: Arcs that one task ranks, whatever the size of the tour.
FEW_ARCS = 1 << 14
#: Places of a block of the tour that one window sums.
BLOCK = 1 << 16
#: Ids in a piece of a list that is hashed.
CHUNK = 1 << 16


def turn_hash() -> Column:
    """95 bits of a turn at its depth; sums of up to a thousand million of them fit a decimal."""
    fields = [F.col(c) for c in ("depth", "role", "text")]
    high = F.shiftrightunsigned(F.xxhash64(F.lit(1), *fields), 1).cast("decimal(19,0)")
    low = F.xxhash64(F.lit(2), *fields).bitwiseAND((1 << 32) - 1).cast("decimal(10,0)")
    return (high * F.lit(1 << 32).cast("decimal(10,0)") + low).cast("decimal(29,0)")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, hash, chars) of the rebuilt conversations, and (conv_id, turns) of all of them.

    A conversation takes the first h turns of the first one of its family, h drawn from its id, and then
    its own turns after its first h.
    """
    plain = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    plain = stored(plain.withColumn("_row", F.monotonically_increasing_id()), "trie-turns")
    order = ["turn", "role", "text", "_row"]
    own = running_sum(with_slices(plain, ["conv_id"], order), ["conv_id"], order, F.lit(1).cast("long"), "place")
    own = stored(own.select("conv_id", "place", "role", "text"), "trie-places")

    heads = own.groupBy("conv_id").agg(F.max("place").alias("turns"))
    heads = stored(heads.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED), "trie-heads")
    first = heads.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("first"), F.col("turns").alias("there"))
    heads = heads.withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY).join(first, "first", "left")
    heads = heads.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    heads = stored(
        heads.select("conv_id", "first", "h", "taken", (F.col("taken") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("turns")),
        "trie-shared",
    )
    # At most MOST_SHARED - 1 turns of a family's first conversation, for at most twice FAMILY conversations.
    shared = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < MOST_SHARED)).withColumnRenamed("conv_id", "first")
    shared = shared.join(heads.select("conv_id", "first", "taken"), "first").where("place <= taken")
    kept = own.join(heads.select("conv_id", "h", "taken"), "conv_id").where("place > h")
    turns = shared.select("conv_id", F.col("place").alias("depth"), "role", "text").unionByName(
        kept.select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "role", "text")
    )
    turns = turns.select("conv_id", "depth", turn_hash().alias("hash"), F.length("text").cast("long").alias("chars"))
    return stored(turns, "trie-rebuilt"), heads.select("conv_id", "turns")


def tour_arcs(nodes: DataFrame) -> DataFrame:
    """Arcs (id, prev, next, w) of the tour: 2 * place enters a node and 2 * place + 1 leaves it.

    ``nodes`` have place, parent_place, n_children, first_child (place) and first_sibling, siblings; children
    of a node have places that follow each other.
    """
    place, parent = F.col("place"), F.col("parent_place")
    has_children = F.col("n_children") > 0
    enter = F.struct(
        (2 * place).alias("id"),
        F.when(place > F.col("first_sibling"), 2 * (place - 1) + 1).otherwise(2 * parent).alias("prev"),
        F.when(has_children, 2 * F.col("first_child")).otherwise(2 * place + 1).alias("next"),
    )
    leave = F.struct(
        (2 * place + 1).alias("id"),
        F.when(has_children, 2 * (F.col("first_child") + F.col("n_children") - 1) + 1).otherwise(2 * place).alias("prev"),
        F.when(place + 1 < F.col("first_sibling") + F.col("siblings"), 2 * (place + 1)).otherwise(2 * parent + 1).alias("next"),
    )
    return nodes.select(F.explode(F.array(enter, leave)).alias("arc")).select("arc.*", F.lit(1).cast("long").alias("w"))


def _taken_out(turn: int) -> Column:
    """Whether an arc's random number of this round exceeds those of both neighbours; the ends stay."""
    own, before, after = (F.xxhash64(F.lit(turn), F.col(c)) for c in ("id", "prev", "next"))
    return F.coalesce((own > before) & (own > after) & F.col("prev").isNotNull() & F.col("next").isNotNull(), F.lit(False))


def _contracted(arcs: DataFrame, turn: int) -> DataFrame:
    """The arcs that stay, linked past those taken out: one shuffle on the id, no key of which has over three rows."""
    out = arcs.where(_taken_out(turn))
    none, told = F.lit(None).cast("long"), F.lit(True).alias("told")
    stays = arcs.where(~_taken_out(turn)).select("id", "prev", "next", "w", F.lit(False).alias("told"))
    backward = out.select(F.col("prev").alias("id"), none.alias("prev"), "next", "w", told)
    forward = out.select(F.col("next").alias("id"), "prev", none.alias("next"), F.lit(0).cast("long").alias("w"), told)

    def newest(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("told"), F.col(name))), F.max(F.when(~F.col("told"), F.col(name)))).alias(name)

    rows = stays.unionByName(backward).unionByName(forward)
    return rows.groupBy("id").agg(newest("prev"), newest("next"), F.sum("w").alias("w"))


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    after = {r["id"]: r for batch in batches for r in batch.to_pylist()}
    at, place, places = next((i for i, r in after.items() if r["prev"] is None), None), 0, []
    if at is None:
        return
    while at is not None:
        places.append((at, place))
        place += after[at]["w"]
        at = after[at]["next"]
    ids, found = np.array(places, np.int64).T
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found)], names=["id", "rank"])


def list_ranks(arcs: DataFrame, few: int = FEW_ARCS) -> DataFrame:
    """(id, rank) of the arcs of one list, rank from 0 at the arc without a predecessor."""
    rounds = [stored(arcs, "tour-0")]
    while rounds[-1].count() > few:
        rounds.append(stored(_contracted(rounds[-1], len(rounds)), f"tour-{len(rounds)}"))
    ranks = stored(rounds[-1].repartition(1).mapInArrow(_walked, "id long, rank long"), "ranks")
    for turn in range(len(rounds) - 1, 0, -1):
        out = rounds[turn - 1].where(_taken_out(turn)).select("id", "next", "w")
        behind = ranks.select(F.col("id").alias("next"), F.col("rank").alias("behind"))
        found = out.join(behind, "next").select("id", (F.col("behind") - F.col("w")).alias("rank"))
        ranks = stored(ranks.unionByName(found), f"ranks-{turn}")
    return ranks


def subtree_sums(ranks: DataFrame, values: DataFrame, names: list[str]) -> DataFrame:
    """(place, names): sums over subtrees of values (place, names) of nodes, from prefix sums along the tour.

    Places of the tour fall into blocks of equal size; one number per block carries the sums on.
    """
    arcs = ranks.select("rank", F.expr("id div 2").alias("place"), (F.col("id") % 2 == 0).alias("enters"))
    block = F.expr(f"rank div {BLOCK}").alias("block")
    arcs = arcs.join(values, "place").select("place", "rank", "enters", block, *(F.when(F.col("enters"), F.col(n)).otherwise(0).alias(n) for n in names))
    arcs = stored(arcs, "tour-values")
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = arcs.groupBy("block").agg(*(F.sum(n).alias(n) for n in names))
    blocks = blocks.select("block", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"before_{n}") for n in names))
    inside = Window.partitionBy("block").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    sums = arcs.select("place", "enters", "block", *names, *(F.sum(n).over(inside).alias(f"sum_{n}") for n in names))
    sums = sums.join(blocks, "block")

    def within(n: str) -> Column:
        so_far = F.col(f"sum_{n}") + F.col(f"before_{n}")
        return F.sum(F.when(F.col("enters"), F.col(n) - so_far).otherwise(so_far)).alias(n)

    return sums.groupBy("place").agg(*map(within, names))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, prefix, conv_id) as comma-joined ids per node, in pieces of at most a batch."""
    for batch in batches:
        depths, prefixes, ids = (c.to_pylist() for c in batch.columns)
        if not ids:
            continue
        starts = [k for k in range(len(ids)) if k % CHUNK == 0 or (depths[k], prefixes[k]) != (depths[k - 1], prefixes[k - 1])]
        ends = [*starts[1:], len(ids)]
        columns = [[c[k] for k in starts] for c in (depths, prefixes, ids)]
        joined = [",".join(map(str, ids[a:b])) for a, b in zip(starts, ends)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.decimal128(38)), pa.array(columns[2], pa.int64()), pa.array(joined, pa.string())],
            names=["depth", "prefix", "first", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by node and first id, hashed as they come: memory does not grow with a node's list."""
    key, digest = None, None

    def done(found: list) -> pa.RecordBatch:
        depths, prefixes, texts = zip(*found)
        arrays = [pa.array(depths, pa.int64()), pa.array(prefixes, pa.decimal128(38)), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["depth", "prefix", "ends_sha256"])

    for batch in batches:
        found = []
        for depth, prefix, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "prefix", "ids"))):
            if (depth, prefix) == key:
                digest.update(b",")
            else:
                if key is not None:
                    found.append((*key, digest.hexdigest()))
                key, digest = (depth, prefix), hashlib.sha256()
            digest.update(ids.encode())
        if found:
            yield done(found)
    if key is not None:
        yield done([(*key, digest.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, prefix, ends_sha256) of rows (depth, prefix, conv_id), ids ascending.

    A hash is sequential by nature; ids are sorted and joined by many tasks, and only the joined pieces of a
    node stream through one.
    """
    order = ["depth", "prefix", "conv_id"]
    rows = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(rows.mapInArrow(_chunks, "depth long, prefix decimal(38,0), first long, ids string"), "end-pieces")
    dealt = pieces.repartition("depth", "prefix").sortWithinPartitions("depth", "prefix", "first")
    return dealt.mapInArrow(_digests, "depth long, prefix decimal(38,0), ends_sha256 string")


RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def prefix_trie(conversations: DataFrame, few: int = FEW_ARCS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have one order; a null
    role or text is empty. Rows without a conv_id belong to no conversation and are left out. Without any
    conversation there is no root and the result is empty. Columns other than conv_id, turn, role and text are
    not read.
    """
    turns, heads = rebuilt(conversations)
    nothing = F.lit(0).cast("decimal(38,0)")
    root = heads.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    if root.isEmpty():
        return conversations.sparkSession.createDataFrame([], RESULT)
    sums = running_sum(with_slices(turns, ["conv_id"], ["depth"]), ["conv_id"], ["depth"], F.col("hash"), "prefix")
    paths = stored(
        sums.select("conv_id", "depth", F.col("prefix").cast("decimal(38,0)").alias("prefix"), "hash", "chars"), "trie-paths"
    )
    nodes = paths.groupBy("depth", "prefix").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("chars").alias("chars"),
        F.max((F.col("prefix") - F.col("hash")).cast("decimal(38,0)")).alias("parent"),
    )
    root = root.select(F.lit(0).cast("long").alias("depth"), nothing.alias("prefix"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"), F.lit(None).cast("decimal(38,0)").alias("parent"))
    nodes = stored(nodes.unionByName(root), "trie-nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(above, ["depth", "parent"], "left").drop("parent")
    # A node is named by its smallest member and its depth; ordered so, children of one parent are neighbours.
    order = [F.asc("depth"), F.asc_nulls_first("parent_conv_id"), F.asc("conv_id")]
    nodes = stored(numbered(nodes, order, "trie-order"), "trie-numbered")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id"))
    children = children.agg(F.min("place").alias("first_child"), F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["depth", "conv_id"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "trie-children")
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("place").alias("parent_place"),
        F.col("first_child").alias("first_sibling"),
        F.col("n_children").alias("siblings"),
    )
    ranks = list_ranks(tour_arcs(nodes.join(parents, ["depth", "parent_conv_id"], "left")), few)
    values = nodes.select(
        "place", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")
    )
    totals = subtree_sums(ranks, values, ["n_leaves", "saved_tokens"])
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "prefix")).alias("last")).select("last.*", "conv_id")
    turnless = heads.where("turns = 0").select(F.lit(0).cast("long").alias("depth"), nothing.alias("prefix"), "conv_id")
    digests = end_digests(last.unionByName(turnless))
    result = nodes.join(totals, "place").join(digests, ["depth", "prefix"], "left")
    none = hashlib.sha256().hexdigest()
    return result.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )
