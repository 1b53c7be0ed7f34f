"""Vector codes against a direct computation, with the corner cases of the operator."""

import hashlib
import math

import numpy as np
import pytest

from ledgerlake.llm import pq

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v string"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [row for row in rows if row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])]
    width = math.ceil(max((len(row[1]) for row in kept), default=0) / parts) * parts or parts
    # As stored: in single precision.
    filled = [[float(np.float32(x)) for x in row[1]] + [0.0] * (width - len(row[1])) for row in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, filled[i][:len(kept[i][1])]))
    cut = [[[math.floor(scale * x) for x in v[p * width // parts:(p + 1) * width // parts]] for p in range(parts)] for v in filled]
    books = [[list(cut[i][p]) for i in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for vector in cut:
            best = [min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), i) for i, entry in enumerate(book))
                    for part, book in zip(vector, books, strict=True)]
            out.append(best)
        return out

    for _ in range(rounds):
        found = assign()
        for p, book in enumerate(books):
            for i in range(len(book)):
                own = [vector[p] for vector, best in zip(cut, found, strict=True) if best[p][1] == i]
                if own:
                    book[i] = [sum(values) // len(own) for values in zip(*own, strict=True)]
    found = assign()
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    errors = [sum(d for d, _ in best) for best in found]
    of_label = {}
    for row, error in zip(kept, errors, strict=True):
        of_label[row[2]] = of_label.get(row[2], 0) + error
    return sorted((str(row[0]), "".join(f"{i:02x}" for _, i in best), error, of_label[row[2]], hashlib.sha256(text.encode()).hexdigest())
                  for row, best, error in zip(kept, found, errors, strict=True))


def encoded(spark, rows, **settings):
    frame = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(3)
    out = pq.encode(frame, "vec_id", "embedding", "label", **settings)
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect())


def test_codes_equal_a_direct_computation(spark):
    dice = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in dice.normal(size=8)], int(dice.integers(3)) or None) for i in dice.permutation(90)]
    rows += [(5, rows[0][1], 1), (5, rows[1][1], 1), (None, rows[2][1], 2), (None, rows[2][1], None)]  # repeated and missing ids
    rows += [(900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [math.inf] + [0.0] * 7, 1), (903, [math.nan] * 8, None)]
    assert encoded(spark, rows, entries=16) == brute(rows, entries=16)
    assert encoded(spark, rows) == brute(rows)  # more entries than rows
    assert encoded(spark, rows, entries=5, rounds=1, parts=2, scale=3) == brute(rows, parts=2, entries=5, rounds=1, scale=3)


def test_vectors_of_other_lengths_are_filled_with_zeros(spark):
    rows = [(1, [0.5, -0.25, 3.0], 1), (2, [], 1), (3, [0.0, 0.0], 2), (4, [-1e-9], 2), (5, [9.0] * 5, None)]
    assert encoded(spark, rows, entries=3) == brute(rows, entries=3)


def test_wide_integers_use_wide_sums(spark):
    dice = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in dice.uniform(-5e4, 5e4, 8)], 0) for i in range(40)]
    assert encoded(spark, rows, entries=7) == brute(rows, entries=7)
    with pytest.raises(Exception, match="leave 64 bits"):
        encoded(spark, [*rows, (99, [1e17] * 8, 0)])


def test_empty_tables(spark):
    assert encoded(spark, []) == []
    assert encoded(spark, [(1, None, 1), (2, [None], None)]) == []


def test_blocks_do_not_change_codes(spark, monkeypatch):
    dice = np.random.default_rng(6)
    values = dice.integers(-900, 900, (300, 12))
    found = [np.unique(values[:, at], return_inverse=True) for at in range(12)]
    book = dice.integers(-900, 900, (20, 12))
    book[7] = book[3]
    monkeypatch.setattr(pq, "GATHERED", 64)
    entry, distance = pq.nearest([x for x, _ in found], np.stack([c for _, c in found]), book)
    whole = ((values[:, None] - book[None]) ** 2).sum(axis=2)
    assert (entry == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
