"""Regions of many edited copies are divided by pivots, level by level, with the default parameters."""

import random
from collections import Counter
from fractions import Fraction

import pyarrow as pa
import pytest

from ledgerlake.llm import jaccard, tokens


def edited(dice, count, sizes):
    """Copies of one text, most of them between one and two radii apart."""
    texts = []
    for _ in range(count):
        words = [f"w{i}" for i in range(100)]
        for at in dice.sample(range(100), dice.choice(sizes)):
            words[at] = f"other{dice.randrange(50)}"
        texts.append(" ".join(words))
    return texts


@pytest.fixture
def levels(monkeypatch):
    """Numbers of home members per region of each level, and of the cells joined in the end."""
    seen, divide, join = [], jaccard._cells, jaccard._joined

    def homes(rows):
        return sorted((row["count"] for row in rows.where("home").groupBy("region").count().collect()), reverse=True)

    def cells(rows, *rest):
        seen.append(homes(rows))
        return divide(rows, *rest)

    def joined(rows, *rest):
        seen.append(homes(rows))
        return join(rows, *rest)

    monkeypatch.setattr(jaccard, "_cells", cells)
    monkeypatch.setattr(jaccard, "_joined", joined)
    return seen


def components_of(texts):
    sets = tokens.shingle_sets(tokens.words(pa.array(texts)), jaccard.SIZE)
    index = jaccard.Index(sets)
    first, second = zip(*jaccard._within(index, sets, Fraction(3, 4)), strict=True)
    return jaccard.roots(len(texts), list(first), list(second)).tolist()


def joined(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    return [row.component_id for row in sorted(jaccard.join(frame, "id", "text").collect(), key=lambda row: row.doc_id)]


def test_many_edited_copies(spark, levels):
    texts = edited(random.Random(4), 2600, [2, 3, 4, 5])
    assert joined(spark, texts) == components_of(texts)
    assert levels[0][0] > 2000 and len(levels) >= 2  # one region, divided by pivots
    assert levels[-1][0] <= levels[0][0] / 4  # into far smaller cells


def test_copies_at_equal_distances(spark, levels):
    """All texts share a core and nothing else: every distance is the same, and ties are dealt by hash."""
    core = " ".join(f"core{i}" for i in range(80))
    texts = [core + " " + " ".join(f"own{n}x{i}" for i in range(16)) for n in range(700)]
    assert joined(spark, texts) == components_of(texts + [texts[0]])[:-1]
    assert levels[0] == [700] and levels[-1][0] <= 350


@pytest.fixture
def made(monkeypatch):
    """Rows of the tables that the division of regions writes, by their label."""
    rows, store = Counter(), jaccard.stored

    def counted(frame, label):
        written = store(frame, label)
        rows[label] += written.count()
        return written

    monkeypatch.setattr(jaccard, "stored", counted)
    return rows


def test_rows_grow_with_the_texts_of_a_dense_group(spark, made):
    """Copies that links to pivots connect do not meet each other again: no row for each text and pivot, nor for each window."""
    counts = []
    for count in (600, 1200):
        made.clear()
        texts = edited(random.Random(6), count, [1])
        assert joined(spark, texts) == components_of(texts)
        counts.append((made["measured"], made["cells"] + made["cell-members"]))
    assert counts[1][0] <= 3 * 1200 and counts[1][1] <= 3 * 1200
    assert counts[1][0] <= 2.5 * counts[0][0]


def test_dense_group_with_strays_and_other_groups(spark, levels):
    """Some texts link with many, some with few others and some with none; all labels have to meet."""
    texts = edited(random.Random(8), 900, [1, 2, 4, 6, 7, 8])
    dice = random.Random(9)
    for seed in dice.sample(texts, 40):  # a neighbour of its own each
        words = seed.split()
        for at in dice.sample(range(100), 3):
            words[at] = f"new{dice.randrange(10**6)}"
        texts.append(" ".join(words))
    expected = components_of(texts)
    sizes = Counter(expected).values()
    assert max(sizes) > 200 and sum(size == 1 for size in sizes) > 50 and sum(1 < size < 20 for size in sizes) > 3
    assert joined(spark, texts) == expected
    assert len(levels) >= 2
