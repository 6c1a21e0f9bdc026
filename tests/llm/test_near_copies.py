from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import near_copies
from strata.llm.near_copies import near_copy_groups
from tests.conftest import SMALL, rows_of
from tests.llm.conftest import text_pairs
from tests.llm.test_simhash import RADIUS, slow_fingerprint


def slow_shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for blank in "\t\n\r\x0b\x0c":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def groups_of(pairs):
    """A number per text; equal numbers are linked."""
    sets, prints = [slow_shingles(t) for _, t in pairs], [slow_fingerprint(t) for _, t in pairs]
    group = list(range(len(pairs)))
    for a in range(len(pairs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            alike = 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common)
            if group[a] != group[b] and (alike or (prints[a] ^ prints[b]).bit_count() <= RADIUS):
                group = [group[b] if g == group[a] else g for g in group]
    return group


def brute_force(pairs):
    group, names = groups_of(pairs), {}
    for g, (doc_id, _) in zip(group, pairs):
        if doc_id is not None:
            names[g] = min(doc_id, names.get(g, doc_id))
    return sorted(((i, names.get(g)) for g, (i, _) in zip(group, pairs)), key=repr)


def planted():
    """Texts with copies of which some words are changed, a dense group, and a line that all hold."""
    draw = random.Random(7)
    word = lambda: f"w{draw.randrange(3000)}"
    line, rows = [word() for _ in range(30)], []
    for size in (3, 5, 6, 12, 40, 100, 100, 300, 300, 1000):
        text = [word() for _ in range(size)] + (line if size > 50 else [])
        for share in (0, 0, 0.01, 0.015, 0.02, 0.025, 0.04, 0.1):
            rows.append([word() if draw.random() < share else w for w in text])
    dense = [word() for _ in range(60)]
    rows += [[word() if k == at else w for k, w in enumerate(dense)] for at in range(60)]
    draw.shuffle(rows)
    return [(k, " ".join(r)) for k, r in enumerate(rows)]


@pytest.mark.parametrize("tile", [2048, 3])
def test_all_planted_near_copies_are_linked(spark, monkeypatch, tile):
    monkeypatch.setattr(near_copies, "TILE", tile)
    monkeypatch.setattr(near_copies, "SAMPLE", 3)
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = brute_force(rows)
    assert rows_of(near_copy_groups(docs)) == expected


def one_list(share, core, size=200):
    """Members of a shingle that all variants of a text share; the first ``core`` of them are connected."""
    draw, rows = random.Random(11), []
    for k in range(size):
        words = [f"x{draw.randrange(9000)}" if draw.random() < share else f"w{j}" for j in range(150)]
        values = near_copies.shingles(" ".join(words).encode())
        sketch = near_copies.brief(near_copies.sketch(values))
        rows.append(np.r_[[1, len(values), k, 0, 0 if k < core else k], np.frombuffer(sketch, np.int64)])
    return np.array(rows)


def handed_on(step, *columns):
    names = ["a", "b", "same"][: len(columns)]
    batch = pa.RecordBatch.from_arrays([pa.array([c]) for c in columns], names=names)
    return [pair for out in step(iter([batch])) for pair in zip(*(c.to_pylist() for c in out.columns))]


def test_unlike_texts_of_a_list_are_ruled_out_where_they_meet():
    unlike, alike = one_list(0.08, 0).tobytes(), one_list(0.002, 0).tobytes()
    assert len(handed_on(near_copies._paired, unlike, unlike, True)) < 200
    assert len(handed_on(near_copies._paired, alike, alike, True)) > 200 * 199 // 4


def many_lists(count=300):
    """Short lists of members of a few components, as a batch."""
    draw, lists = random.Random(3), []
    for shingle in range(count):
        rows = one_list(0.004, 0, draw.randrange(1, 12))
        rows[:, 0], rows[:, 2] = shingle, rows[:, 2] + 20 * (shingle % 7)
        rows[:, 4] = [draw.randrange(4) for _ in rows]
        lists.append(rows)
    return lists


def test_short_lists_are_taken_together():
    lists = many_lists()
    batch = pa.RecordBatch.from_arrays([pa.array([rows.tobytes() for rows in lists])], names=["members"])
    found = list(near_copies._exploded(near_copies.SKETCHED)(iter([batch])))
    assert len(found) < 10
    rows = pa.Table.from_batches(found).to_pydict()
    assert list(zip(*(rows[c] for c in near_copies.MEMBER[:4]))) == [tuple(r[:4]) for rows in lists for r in rows.tolist()]
    assert rows["brief"] == [r[near_copies.PLAIN :].tobytes() for rows in lists for r in rows]


def test_lists_taken_together_give_the_pairs_of_each_list():
    lists = many_lists()
    plain = [np.ascontiguousarray(rows[:, : near_copies.PLAIN]) for rows in lists]
    for step, lists in ((near_copies._followed, lists), (near_copies._chained, plain)):
        batch = pa.RecordBatch.from_arrays([pa.array([rows.tobytes() for rows in lists])], names=["members"])
        together = {pair for out in step(iter([batch])) for pair in zip(*(c.to_pylist() for c in out.columns))}
        assert together == {pair for rows in lists for pair in handed_on(step, rows.tobytes())}
        assert len(together) > 50


def test_every_word_is_hashed_once(monkeypatch):
    hashed = []
    for name in ("xxh64_digest", "xxh64_intdigest"):
        plain = getattr(near_copies, name)
        monkeypatch.setattr(near_copies, name, lambda value, seed, plain=plain: hashed.append(value) or plain(value, seed))
    near_copies.shingles(b"One two three four five six seven")
    assert hashed == b"one two three four five six seven".split()


def test_shingles_tell_order_and_words_apart():
    draw, words = random.Random(9), [b"a", b"b", b"aa", b"ab", b"\xc3\xa9"]
    text = [draw.choice(words) for _ in range(3000)]
    expected = len({tuple(text[k : k + 5]) for k in range(len(text) - 4)})
    values = near_copies.shingles(b" \n".join(text))
    assert len(values) == expected and (values[1:] > values[:-1]).all()
    low, high = np.unique(values % np.uint64(512)), np.unique(values >> np.uint64(55))
    assert min(len(low), len(high)) > 500  # as 512 places of random numbers


def test_two_components_meet_once_per_distance():
    rows = one_list(0.002, 100)
    rows[100:, 4] = 100
    rows[:] = rows[np.argsort(np.arange(200) % 100, kind="stable")]  # by turns
    found = handed_on(near_copies._followed, rows.tobytes())
    assert 1 <= len(found) <= near_copies.SPAN and all((a < 100) != (b < 100) for a, b in found)


def test_brief_sketches_differ_in_no_more_bits_than_sets_in_shingles():
    draw = np.random.default_rng(5)
    sets = [draw.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2) for size in (40, 700, 3000)]
    for a in sets:
        b = np.unique(np.r_[a[: len(a) * 19 // 20], draw.integers(0, 1 << 63, 2).astype(np.uint64)])
        rows = [np.frombuffer(near_copies.brief(near_copies.sketch(v)), np.int64) for v in (a, b)]
        apart = int(np.bitwise_count((rows[0] ^ rows[1]).astype(np.uint64)).sum())
        assert apart <= len(np.setxor1d(a, b))
        members = [np.r_[[0, len(v), k, 0, k], row][None] for k, (v, row) in enumerate(zip((a, b), rows))]
        assert near_copies._alike(*members).tolist() == [True]


def test_the_stage_keeps_one_of_each_planted_group(spark):
    rows = planted()
    docs, expected = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), brute_force(rows)
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SMALL).collect()}
    assert kept == {i for i, name in expected if i == name}


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_groups_equal_brute_force(request, name):
    docs = request.getfixturevalue(name)
    if name == "documents":
        docs = docs.where(F.length("text") < 2000)
    assert rows_of(near_copy_groups(docs)) == brute_force(text_pairs(docs))


def test_empty_table(empty):
    assert near_copy_groups(empty).collect() == []
    assert near_copies.without_similar(empty).collect() == []


def test_one_row_of_each_group_stays_without_ids_or_under_one_id(spark):
    """Copies without an id, under one id, and a row whose id names another group too."""
    line = " ".join(f"w{k}" for k in range(60))
    near, other = line + " more", " ".join(f"v{k}" for k in range(60))
    rows = [(None, line, 1), (None, near, 2), (None, line, 3), (7, other, 1), (7, other + " x", 2), (7, other, 0), (9, other, 5), (7, "alone", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(3)
    kept = sorted(map(tuple, near_copies.without_similar(docs).collect()), key=repr)
    assert kept == sorted(one_of_each(rows), key=repr)


def one_of_each(rows):
    """Of each group the row with the least id, nulls last, then name of the text, then other columns."""
    groups, best = groups_of([(r[0], r[1] or "") for r in rows]), {}
    for g, row in zip(groups, rows):
        rank = (row[0] is None, row[0] or 0, hashlib.md5((row[1] or "").encode()).digest(), [(v is not None, v or "") for v in row])
        if g not in best or rank < best[g][0]:
            best[g] = (rank, row)
    return [tuple(row) for _, row in best.values()]


def test_rows_of_many_equal_texts_are_handed_on_once(spark):
    rows = [(k, " ".join(f"w{j}" for j in range(40))) for k in range(500)] + [(900, " ".join(f"w{j}" for j in range(1, 41)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    members = docs.mapInArrow(near_copies._prefixes(*near_copies.common_shingles(docs.withColumn("name", near_copies.text_name()))), near_copies.MEMBERS)
    assert members.count() <= 5 * 8
    assert near_copies.without_similar(docs).select("doc_id").collect() == [(0,)]


@pytest.mark.parametrize("size", [3, 511, 600, 1400, 2048, 9000])
def test_sketches_differ_in_no_more_bits_than_sets_in_shingles(size):
    random = np.random.default_rng(size)
    a = random.integers(0, 1 << 63, size).astype(np.uint64)
    unlike = random.integers(0, 1 << 63, max(1, size * 9 // 10)).astype(np.uint64)
    for b in (a, a[: size * 4 // 5], np.concatenate([a[: size // 2], unlike]), unlike):
        apart = len(np.setxor1d(a, b))
        found = near_copies.differing_bits(near_copies.sketch(a), near_copies.sketch(b))
        assert found <= apart and (found - apart) % 2 == 0
        if b is unlike and size > 500:
            assert 9 * found > len(a) + len(b)  # ruled out
