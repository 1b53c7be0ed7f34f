"""Decontamination against all windows."""

import random
from collections import Counter

import pytest
import regex

from ledgerlake.llm import decontaminate

SCHEMAS = "doc_id long, text string, n int", "item_id long, text string"


def words(text):
    return [word for word in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if word]


def weighted(found, size):
    return Counter(tuple(found[i:i + size]) for i in range(len(found) - size + 1))


def all_windows(docs, items):
    out = {}
    for item_id, item in items:
        item = words(item)
        if not item:
            continue
        size = min(5, len(item))
        want = weighted(item, size)
        for doc_id, text in docs:
            found = words(text)
            for start in range(max(len(found) - len(item), 0) + 1):
                have = weighted(found[start:start + len(item)], size)
                shared = sum((have & want).values())
                total = sum(have.values()) + sum(want.values()) - shared
                if total and 4 * shared >= 3 * total:
                    out[doc_id, item_id] = max(shared / total, out.get((doc_id, item_id), 0))
    return out


@pytest.fixture(scope="module")
def planted():
    dice = random.Random(5)
    vocabulary = [f"w{i}é" for i in range(400)]

    def some(n):
        return [dice.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(some(n))) for i, n in enumerate([40, 40, 60, 25, 25, 12, 3, 1])]
    items += [(90, "la " * 30), (91, ""), (92, None), (93, items[0][1]), (None, "unique words of an item without any id")]
    docs = [(0, None), (1, ""), (2, "...")]
    for i in range(60):
        own = some(dice.randint(0, 200))
        item = words(dice.choice(items)[1])
        for _ in range(dice.choice([0, 0, 1, 2, 3, 8])):
            if item:
                at = dice.randrange(len(item))
                item[at:at + 1] = dice.choice([some(1), [], [item[at], *some(1)]])
        at = dice.randint(0, len(own))
        docs.append((10 + i, dice.choice([" ", ", ", "\n"]).join(own[:at] + item + own[at:]).title()))
    docs += [(100, items[0][1]), (101, items[2][1][:-30]), (102, "la " * 29), (103, "LA! " * 500), (104, "x " * 30000)]
    return docs, items


def test_equals_all_windows(spark, planted):
    docs, items = planted
    frames = spark.createDataFrame([(*doc, 1) for doc in docs], SCHEMAS[0]), spark.createDataFrame(items, SCHEMAS[1])
    found = decontaminate.matches(frames[0], "doc_id", "text", frames[1], "item_id", "text").collect()
    want = all_windows(docs, items)
    assert len(found) == len(want)
    assert {(row.doc_id, row.item_id): round(row.similarity, 9) for row in found} == {k: round(v, 9) for k, v in want.items()}
    assert len(want) > 30


def test_clean_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", 5), (2, "other text", 6), (None, "a b c d e f g", 7)], SCHEMAS[0])
    items = spark.createDataFrame([(1, "A b c, d e f g")], SCHEMAS[1])
    kept = decontaminate.clean(docs, "doc_id", "text", items, "item_id", "text")
    assert kept.columns == docs.columns and [row.n for row in kept.collect()] == [6]
    assert decontaminate.matches(docs, "doc_id", "text", items.where("false"), "item_id", "text").count() == 0
    assert decontaminate.matches(docs.where("false"), "doc_id", "text", items, "item_id", "text").count() == 0
