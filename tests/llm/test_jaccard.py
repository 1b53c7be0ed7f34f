"""The Jaccard join against all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard
from ledgerlake.llm.components import components

SCHEMA = "doc_id long, text string"


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def all_pairs(rows):
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(key, least.get(root(i), key))
    return {(key, len(sets[i]), least[root(i)] if sets[i] else key) for i, (key, _) in enumerate(rows)}


@pytest.mark.parametrize(("cell", "each"), [(8, 3), (3, 2), (20, 8), (10**6, 32)])
def test_equals_all_pairs(spark, near_copies, monkeypatch, cell, each):
    """Small cells make several levels of them."""
    monkeypatch.setattr(jaccard, "EACH", each)
    docs = spark.createDataFrame(near_copies, SCHEMA).repartition(3).withColumns({"point": F.lit(1), "region": F.lit("x")})
    found = jaccard.join(docs, "doc_id", "text", cell=cell).collect()
    assert {tuple(row) for row in found} == all_pairs(near_copies)
    assert len(found) == len(near_copies)


def test_empty_and_rows_without_id(spark):
    assert jaccard.join(spark.createDataFrame([], SCHEMA), "doc_id", "text").count() == 0
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "q")]
    found = jaccard.join(spark.createDataFrame(rows, SCHEMA), "doc_id", "text").collect()
    assert sorted((str(row.doc_id), row.component_id) for row in found if row.n_shingles == 2) == [("4", 4), ("4", 4), ("None", 4)]


def test_near_copies_without_id_link(spark):
    """A row without id is a near copy of 7 and 9 and ties them; two others without id have nobody with one."""
    words = [f"w{i}" for i in range(60)]
    rows = [(9, " ".join(words[:52])), (None, " ".join(words[4:56])), (7, " ".join(words[8:60])), (None, "x y z x y z"), (None, "x y z x y z"), (3, "")]
    found = jaccard.join(spark.createDataFrame(rows, SCHEMA), "doc_id", "text").collect()
    assert sorted((str(row.doc_id), str(row.component_id)) for row in found) == [
        ("3", "3"), ("7", "7"), ("9", "7"), ("None", "7"), ("None", "None"), ("None", "None")]
    assert not jaccard.links(len(set(zip(*(words[i:52] for i in range(5)))) & set(zip(*(words[8 + i:60] for i in range(5))))), 48, 48, jaccard.LEAST)


def test_one_of_each(spark):
    rows = [(2, "a b c d e f", 1), (1, "A b c d e f", 2), (3, "other", 3), (3, "other two", 8), (None, "x", 4), (5, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept int")
    found = [sorted((str(row.doc_id), row._kept) for row in jaccard.one_of_each(docs.repartition(n, "_kept"), "doc_id", "text").collect())
             for n in (1, 3)]
    assert found[0] == found[1] and found[0] in ([("1", 2), ("3", x), ("5", 5), ("None", 4)] for x in (3, 8))
    unique = jaccard.one_of_each(docs.where("_kept < 3 OR _kept > 3 AND _kept < 8"), "doc_id", "text")
    assert sorted((str(row.doc_id), row._kept) for row in unique.collect()) == [("1", 2), ("5", 5), ("None", 4)]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200), (200, 300)]
    found = {row.node: row.component for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 300: 200}


def test_first_pivots_of_neighbours_meet():
    """Texts at the threshold, with differences wherever they hurt most, share one of their first pivots."""
    dice = np.random.default_rng(3)
    shortest = 10**6
    for trial in range(600):
        n = int(dice.choice([1, 3, 4, 8, 40, 120, 400, 3000]))
        shared = -(-6 * n // 7)
        values = dice.integers(0, 2**63, 2 * n - shared).astype(np.uint64)
        step = {int(v): int(s) for v, s in zip(values, dice.integers(0, 1 + trial % 4, len(values)), strict=True)}
        if trial % 2:  # the shared shingles are the common ones
            step |= {int(v): 3 for v in values[:shared]}
        firsts = []
        for own in (values[:n], np.concatenate((values[:shared], values[n:]))):
            ordered = sorted((step[int(v)], int(v)) for v in own)
            reach = jaccard._reach(n, np.bincount([s for s, _ in ordered]), jaccard.LEAST)
            assert 1 <= reach <= n - -(-3 * n // 4) + 1
            if n == 3000 and trial % 4 == 0:
                shortest = min(shortest, reach)
            firsts.append({v for _, v in ordered[:reach]})
        assert jaccard.links(shared, n, n, jaccard.LEAST) and firsts[0] & firsts[1]
    assert shortest <= 34


def test_summaries_of_a_task_grow_with_its_texts():
    """However few texts a task has, it names no more shingles than some per text, the most frequent ones first."""
    common = " ".join(f"c{i}" for i in range(9))
    texts = [" ".join(f"t{at}x{i}" for i in range(300)) + " " + common for at in range(3)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3), pa.int64()), pa.array(texts), pa.array(range(3), pa.int64())], ["doc_id", "text", "hash"])
    counted = [row for out in jaccard._summaries(5)(iter([batch])) for row in out.to_pylist() if row["count"] is not None]
    assert len(counted) == 3 * jaccard.COMMON_OF_TEXT
    assert [row["count"] for row in counted].count(3) == 5
