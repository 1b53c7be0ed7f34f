"""Windows just above the least similarity are found, all of them, and the blocks find whatever is within the radius."""

import random

from ledgerlake.llm import decontaminate


def test_cut_items_are_found(spark):
    dice = random.Random(11)

    def some(n):
        return [f"w{dice.randrange(3000)}" for _ in range(n)]

    items, docs = [], []
    for i in range(240):
        n = dice.choice([25, 40, 60, 100])
        item = some(n)
        kept = 4 + -(-6 * (n - 4) // 7)  # the fewest successive words that reach 0.75
        # At the start of a document only one window holds all of them.
        first = dice.randint(0, n - kept)
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(item[first:first + kept] + some(n))))
    found = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text",
                                  spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").collect()
    assert sorted((row.doc_id, row.item_id) for row in found) == [(i, i) for i in range(240)]
    assert all(0.75 <= row.similarity < 0.85 for row in found)


def bits(spark, rows):
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(rows)], "i int, text string")
    hashed = frame.select("i", decontaminate.word_hashes(frame.text).alias("words"))
    found = decontaminate.fingerprinted(hashed, "words").select("i", *decontaminate.HALVES).collect()
    return [(r.bits % 2**64) | (r.more_bits % 2**64) << 64 for r in sorted(found)]


def test_fingerprints_of_similar_windows_are_within_the_radius(spark):
    """Cuts at the least similarity, of items of any size and of items that repeat words."""
    dice = random.Random(12)
    pairs = []
    for i in range(2000):
        n = dice.choice([11, 12, 13, 15, 18, 25, 40, 60, 100])
        item = [f"w{dice.randrange(3000)}" for _ in range(n)]
        if i % 4 == 0:
            item[:n // 5] = ["often"] * (n // 5)
        kept = 4 + -(-6 * (n - 4) // 7)
        pairs += [" ".join(item), " ".join(item[n - kept:] + [f"w{dice.randrange(3000)}" for _ in range(n - kept)])]
    found = bits(spark, pairs)
    apart = [bin(a ^ b).count("1") for a, b in zip(found[::2], found[1::2], strict=True)]
    assert sum(x > decontaminate.RADIUS for x in apart) <= 2 and max(apart) > 25
    assert sum(apart) / len(apart) < 24


def test_blocks_meet_within_the_radius(spark):
    """Every pair of fingerprints within the radius has a block in which they are near."""
    dice = random.Random(13)
    widths, start, blocks = decontaminate.BLOCKS * len(decontaminate.HALVES), 0, []
    for width in widths:
        blocks.append(((1 << width) - 1) << start)
        start += width
    assert start == 128
    for _ in range(3000):
        changed = sum(1 << bit for bit in dice.sample(range(128), decontaminate.RADIUS))
        assert min(bin(changed & block).count("1") for block in blocks) <= decontaminate.NEAR
