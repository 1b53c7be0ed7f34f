"""Spelling variants against a direct search of all near words, with the corner cases of the operator."""

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerlake.llm import spelling

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string, word string, n long, form string, cell int"


def brute(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {word: c for word, c in counts.items() if len(word) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        if abs(len(a) - len(b)) != 1:
            return False
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    found = {word: [other for other in n if near(word, other)] for word in n}
    form = {}
    for word, others in found.items():
        best = min(others, key=lambda other: (-n[other], other), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    out = []
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        out.append((word, str(form[word]), root, n[word], len(found[word]), str(n.get(form[word]))))
    return sorted(out)


def found(spark, rows):
    frame = spark.createDataFrame([(*row, "x", 1, "y", 2) for row in rows], SCHEMA).repartition(3)
    out = spelling.variants(frame, "doc_id", "text").collect()
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, str(r.form_n)) for r in out)


def corpus(dice, letters, words, size, documents):
    stock = ["".join(dice.choice(letters) for _ in range(dice.randint(4, size))) for _ in range(words)]
    for _ in range(3 * words):  # anagrams and near words of the stock
        word = list(dice.choice(stock))
        kind = dice.randrange(4)
        at = dice.randrange(len(word))
        if kind == 0:
            dice.shuffle(word)
        elif kind == 1:
            word[at] = dice.choice(letters)
        elif kind == 2:
            word.insert(at, dice.choice(letters))
        else:
            del word[at]
        stock.append("".join(word))
    return [(i, " ".join(dice.choice(stock[:dice.randint(1, len(stock))]) for _ in range(120))) for i in range(documents)]


@pytest.mark.parametrize(("cell", "queries"), [(1 << 15, 1 << 16), (40, 60)])
def test_variants_equal_a_direct_search(spark, monkeypatch, cell, queries):
    """Small cells and shares make deep trees of cells and deal each over several units."""
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "QUERIES", queries)
    monkeypatch.setattr(spelling, "SAMPLED_CELL", 4)
    dice = random.Random(5)
    rows = corpus(dice, "abceéÉÿ", 120, 9, 60)
    rows += [(100, None), (101, ""), (None, "abcdef ABCDEF Abcdef abcdeg"), (None, "abcdeg abcdeg abcde"), (7, "x" * 5000 + " " + "x" * 4999)]
    rows += [(i, "x" * 5000 + "," + "x" * 4999 + " straße STRASSE naïve-rôle ×÷×÷× aaaaa AAAAB") for i in range(200, 205)]
    rows += [(200, rows[-1][1])]
    want = brute(rows)
    assert len(want) > 150 and sum(row[1] != "None" for row in want) > 20
    assert found(spark, rows) == want


def test_anagrams_and_long_chains(spark):
    """Words with the same letter counts cannot be cut into cells; forms lead to forms."""
    dice = random.Random(6)
    words = {"".join(dice.sample("abcdefg", 7)) for _ in range(300)}
    rows = [(i, " ".join([word] * 3 + [word[:-1] + "zz"] * 3)) for i, word in enumerate(sorted(words))]
    chain = [("aaaaa" + "b" * i, 3 * 2 ** i) for i in range(8)]
    rows += [(1000 + i, " ".join([word] * n)) for i, (word, n) in enumerate(chain)]
    want = brute(rows)
    assert found(spark, rows) == want
    assert ("aaaaa", "aaaaab") in {row[:2] for row in want} and any(row[2] == chain[-1][0] and row[0] == "aaaaa" for row in want)


def test_segments_do_not_cut_runs(monkeypatch):
    monkeypatch.setattr(spelling, "SEGMENT", 7)
    text = "one threeé fiveeseven .. eleventhirteen a bb ccc dddd eeeee" * 5
    assert sum(spelling._runs(text), []) == spelling.RUN.findall(text)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, ""), (3, "rare words only")]) == []
