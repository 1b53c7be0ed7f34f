"""Near-duplicate vectors against all pairs, with the corner cases of the operator."""

import math

import numpy as np
import pytest

from ledgerlake.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, node string, v string, links int"


def brute(rows, least=0.95):
    """Rows of (vec_id, n_links, component_id, kept)."""
    width = max((len(v) for _, v in rows if v), default=1)
    good = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = np.zeros((len(rows), width))
    for place, ((_, v), is_good) in enumerate(zip(rows, good, strict=True)):
        if is_good:
            unit[place, :len(v)] = np.float32(v)
            unit[place] /= np.abs(unit[place]).max()
            unit[place] /= np.linalg.norm(unit[place])
    near = unit @ unit.T >= least
    np.fill_diagonal(near, False)
    label = list(range(len(rows)))
    for a, b in np.argwhere(near):
        if label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    out = []
    for place, (key, _) in enumerate(rows):
        ids = [rows[i][0] for i in range(len(rows)) if label[i] == label[place] and rows[i][0] is not None]
        low = min(ids, default=None)
        out.append((str(key), int(near[place].sum()), str(low), key == low))
    return sorted(out)


def found(spark, rows):
    frame = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], SCHEMA).repartition(3)
    out = neighbours.near_duplicates(frame, "vec_id", "embedding")
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in out.collect())


def noisy(dice, base, cosine):
    across = dice.normal(size=base.shape)
    across -= (across @ base) * base
    return cosine * base + math.sqrt(1 - cosine ** 2) * across / np.linalg.norm(across)


def unit(dice, width=16):
    v = dice.normal(size=width)
    return v / np.linalg.norm(v)


@pytest.mark.parametrize("block", [7, 2048])
def test_links_equal_all_pairs(spark, monkeypatch, block):
    """Small blocks deal the lists of the copied groups out over many units."""
    monkeypatch.setattr(neighbours, "BLOCK", block)
    dice = np.random.default_rng(8)
    bases = [unit(dice) for _ in range(60)]
    rows = [(i, base.tolist()) for i, base in enumerate(bases)]
    rows += [(100 + i, noisy(dice, bases[0], 0.985).tolist()) for i in range(60)]  # a large group, linked among itself in part
    rows += [(300 + i, noisy(dice, bases[i % 9], 0.97).tolist()) for i in range(40)]
    rows += [(400 + i, bases[1].tolist()) for i in range(30)]  # exact copies
    rows += [(500, (3 * bases[2]).tolist()), (5, bases[3].tolist()), (None, bases[4].tolist()), (None, bases[0].tolist())]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [None] + [1.0] * 15), (604, [math.nan] * 16), (605, [math.inf]), (None, None)]
    rows += [(700, bases[5].tolist() + [0.0, 0.0]), (701, [1.0]), (702, [2.0, 0.0]), (703, [1e30]), (704, [1e-40, 1e-41])]
    alone = unit(dice)
    rows += [(None, alone.tolist()), (None, alone.tolist())]
    assert found(spark, rows) == brute(rows)


def test_few_directions(spark):
    """One pivot only: a single list has all vectors."""
    dice = np.random.default_rng(9)
    base = unit(dice)
    rows = [(i, noisy(dice, base, 0.97).tolist()) for i in range(50)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(1, [1.0])]) == [("1", 0, "1", True)]


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(2, None), (1, [0.0])]) == [("1", 0, "1", True), ("2", 0, "2", True)]


def test_recall_at_the_threshold(spark):
    """Pairs that barely link are the hardest for the index; few may be missed and nothing else linked."""
    dice = np.random.default_rng(10)
    bases = [unit(dice, 64) for _ in range(3000)]
    rows = [(i, base.tolist()) for i, base in enumerate(bases)]
    rows += [(10_000 + i, noisy(dice, base, 0.9502).tolist()) for i, base in enumerate(bases[:1500])]
    links = {r[0]: r[1] for r in found(spark, rows)}
    true = {r[0]: r[1] for r in brute(rows)}
    assert sum(true.values()) >= 3000 and all(links[key] <= true[key] for key in true)
    assert sum(links.values()) >= 0.99 * sum(true.values())
