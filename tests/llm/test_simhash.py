from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from strata.llm.components import components
from strata.llm.simhash import RADIUS, fingerprint, links_within, near_groups, neighbour_offsets, without_near_copies
from tests.conftest import rows_of
from tests.llm.conftest import LONG, text_pairs


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for blank in "\t\n\r\x0b\x0c":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(pairs):
    """component per row by joining every pair of rows within the radius."""
    prints = [slow_fingerprint(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(pairs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= RADIUS:
                parent[find(a)] = find(b)
    names = {}
    for k, (doc_id, _) in enumerate(pairs):
        if doc_id is not None:
            names[find(k)] = min(doc_id, names.get(find(k), doc_id))
    return sorted(
        ((i, f"{prints[k]:016x}", names.get(find(k))) for k, (i, _) in enumerate(pairs)), key=repr
    )


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_groups_equal_brute_force(request, name):
    docs = request.getfixturevalue(name)
    if name == "documents":
        docs = docs.where(F.length("text") < 6000)
    assert rows_of(near_groups(docs)) == brute_force(text_pairs(docs))


def test_fingerprint_of_long_and_short_texts():
    for text in (LONG, "", " ", "A", "a B", "Über Straße x", "a b c"):
        assert fingerprint(text.encode()) == slow_fingerprint(text)


def test_links_connect_what_all_pairs_connect(spark):
    """Random clusters and chains around the edges of cells, a dense one larger than a strip among them."""
    draw = random.Random(3)
    values = {0, 2**64 - 1, 1, 7, 15}
    for _ in range(60):
        value = draw.getrandbits(64)
        for _ in range(12):
            values.add(value)
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                value ^= 1 << bit
    dense = draw.getrandbits(64)
    values |= {dense ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    values = np.array(sorted(values), np.uint64)
    rows = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long").repartition(4)
    found = {(r.a, r.b) for r in links_within(rows, RADIUS).collect()}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= RADIUS
    signed = values.view(np.int64)
    pairs = {(int(signed[i]), int(signed[j])) for i, j in zip(*np.nonzero(near)) if i != j}
    assert found <= pairs  # every link is one
    labels = np.arange(len(values))
    while True:  # components of all pairs
        lower = np.where(near, labels[None, :], len(values)).min(1)
        if (lower == labels).all():
            break
        labels = lower
    place = {int(v): k for k, v in enumerate(signed)}
    tree = np.arange(len(values))
    for a, b in found:
        x, y = tree[place[a]], tree[place[b]]
        tree[tree == max(x, y)] = min(x, y)
    assert (tree == labels).all()
    assert len(found) < 40 * len(values)  # no cluster is written as all its pairs


def test_steps_cover_each_pair_of_cells_once():
    steps = neighbour_offsets(3)
    assert len(steps) == len(set(steps)) == (129 - 1) // 2 + 1


def test_components_of_a_chain_a_star_and_a_ring(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(2000 + k, 2000 + (k + 1) % 9) for k in range(9)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links + [(5, 5), (1, 0)], "a long, b long")).collect()}
    assert len(found) == 201 + 100 + 9
    groups = [{found[k] for k in nodes} for nodes in (range(201), range(1000, 1100), range(2000, 2009))]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3


def test_one_document_of_each_group_stays(odd):
    kept = without_near_copies(odd)
    assert kept.columns == odd.columns
    groups = {r.doc_id: r.component_id for r in near_groups(odd).collect() if r.doc_id is not None}
    ids = {i for i, _ in text_pairs(kept) if i is not None}
    assert set(groups[i] for i in ids) == set(groups.values())
    assert {i for i, c in groups.items() if i == c} <= ids


def test_empty_table(empty):
    assert near_groups(empty).collect() == []
    assert without_near_copies(empty).collect() == []
