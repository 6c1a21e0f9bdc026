"""The decisions of the pipeline's stages on plain lists of rows (doc_id, text, lang, source, n_chars, ...)."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
from xxhash import xxh64_intdigest

from strata.llm.learning import Rows
from strata.llm.quality import CERTAIN, THRESHOLD, co_train, meta_view, text_view
from tests.llm.test_mixing import targets_by_rounds
from tests.llm.test_near_copies import one_of_each


def by_hash_of(doc_id):
    value = xxh64_intdigest(struct.pack("<q", doc_id), 42)
    return (value - (1 << 64) if value >> 63 else value, doc_id)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def null_first(row):
    return [(v is not None, v if v is not None else 0) for v in row]


def both_views(row):
    text = (row[1] or "").encode()
    return text_view(text), meta_view(text, row[2], row[3], row[4])


def odds(models, pair):
    """Raw scores of both views, term by term."""
    return [m.bias + sum(float(m.weights[i]) * float(np.float32(v)) for i, v in zip(*view)) for m, view in zip(models, pair)]


def plain_quality(rows, labels, handed_on=1000):
    """The co-trained model, and per round the ids that a view was certain of."""
    by_id = {}
    for row in rows:
        if row[0] is not None:
            by_id[row[0]] = min(by_id.get(row[0], row), row, key=null_first)
    given = {}
    for doc_id, label in labels:
        if doc_id is not None and label in (0, 1) and not held(doc_id):
            given[doc_id] = max(given.get(doc_id, 0), label)
    known = sorted(i for i in given if i in by_id)
    seen = {i: both_views(row) for i, row in by_id.items()}
    rounds = []

    def packed(ids):
        return Rows.of([seen[i][0] for i in ids]), Rows.of([seen[i][1] for i in ids])

    def opinions(models, i):
        p = [1 / (1 + np.exp(-x)) for x in odds(models, seen[i])]
        return [1 if x >= CERTAIN else 0 if x <= 1 - CERTAIN else -1 for x in p]

    def teach(models):
        free = sorted((i for i in by_id if i not in given and not held(i)), key=by_hash_of)
        thinks = {i: opinions(models, i) for i in free}
        chosen = set()
        for view in (0, 1):
            for label in (0, 1):
                chosen |= set([i for i in free if thinks[i][view] == label][:handed_on])
        rounds.append(chosen)
        ids = sorted(chosen)
        return *packed(ids), np.array([thinks[i] for i in ids]).reshape(-1, 2)

    return co_train(*packed(known), np.array([given[i] for i in known], float), teach), rounds


def plain_scores(model, rows):
    scores = {}
    for row in rows:
        views = [slope * x + offset for x, (slope, offset) in zip(odds(model.models, both_views(row)), model.calibrations)]
        *shares, offset = model.combination
        scores[row[0]] = float(1 / (1 + np.exp(-(sum(s * v for s, v in zip(shares, views)) + offset))))
    return scores


def plain_good(rows, labels):
    model = plain_quality(rows, labels)[0]
    return [row for row in rows if plain_scores(model, [row])[row[0]] >= THRESHOLD]


def plain_exact(rows):
    """Of equal texts the row with the largest id; rows without one come last."""
    best = {}
    for row in rows:
        text = row[1] or ""
        if text not in best or (row[0] is not None, row[0] or 0) > (best[text][0] is not None, best[text][0] or 0):
            best[text] = row
    return list(best.values())


def plain_near(rows):
    return one_of_each(rows)


def plain_copies(rows):
    """(row, copies) of a mix, equal rows together in the form that comes first."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")) for row in rows]
    total = Counter()
    for row, size in zip(rows, sizes):
        total[row[3]] += size
    targets, by_source = targets_by_rounds(total), defaultdict(list)
    for row, size in zip(rows, sizes):
        key = hashlib.md5(f"{'' if row[0] is None else row[0]}|{row[1] or ''}".encode()).hexdigest()
        by_source[row[3]].append((key, null_first((row[0], row[2], row[4])), size, row))
    copies = Counter()
    for source, found in by_source.items():
        budget, before = int(targets[source]), 0
        epochs, rest = divmod(budget, total[source]) if total[source] else (0, 0)
        groups = defaultdict(list)
        for key, order, size, row in sorted(found, key=lambda r: r[:2]):
            taken = epochs * size + max(0, min(size, rest - before))
            before += size
            groups[key, tuple(order)].append((1 if size == 0 else int(taken / size + 0.5), row))
        for members in groups.values():
            copies[min((row for _, row in members), key=null_first)] += sum(n for n, _ in members)
    return +copies


