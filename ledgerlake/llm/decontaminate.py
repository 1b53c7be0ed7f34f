"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

Words are lower-cased runs of letters and digits. An item of n words is looked for in windows of n words; both are
compared as weighted sets of their shingles of five words, the weight being how often one occurs (an item of fewer
words is one shingle). The similarity is the sum of the smaller weights over the sum of the larger ones, and ``LEAST``
or more is a match.

1. A window that reaches the similarity holds at least that share of the item's number of shingles, all of which occur
   in items of its size. So only windows with that many such positions get a fingerprint, whatever items these are of.
2. A fingerprint has 128 bits, each the majority of that bit in the hashes of the window's words; of a word that occurs
   several times each occurrence has a hash of its own, so no word outweighs the others. Fingerprints of windows and of
   items of the same size meet if they differ in at most ``RADIUS`` bits: in one of the blocks they then differ in at most
   ``NEAR`` bits, and items are indexed under all block values that near, so no fingerprint within the radius is missed.
3. Pairs within the radius are verified by the exact similarity.

A window of the least similarity shares at least about 6 of 7 words with its item, and such fingerprints differ in 21 bits
on average with a deviation of 4.2, so the radius of 39 is more than four deviations above: in a model of 15,000 cuts none
was beyond it (with 64 bits and a radius of 19, 0.2 % were, and 8 % with one of 14).

Only DataFrame functions are used. Tables derived from the benchmark alone are broadcast when a count shows that they
are small, and joined by shuffles otherwise. Null texts are empty; items and documents without words match nothing.
Texts are searched whole; a document shorter than an item is one window. Repeated documents or items match each by
itself; rows that repeat both id and text give one result per pair of ids. Empty tables give no rows. Other columns do not
matter, whatever their names.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import stored

SIZE = 5
LEAST = Fraction(3, 4)
BLOCKS = (13, 13, 13, 13, 12)  # bits of the blocks of each half of a fingerprint
HALVES = ("bits", "more_bits")
NEAR = 3
RADIUS = len(HALVES) * len(BLOCKS) * (NEAR + 1) - 1
BROADCAST_ROWS = 200_000  # of at most 40 bytes each

# Hash of each occurrence of a word; sorting numbers the occurrences.
_OCCURRENCES = "transform(ordered, (word, at) -> xxhash64(word, at + 1 - array_position(ordered, word), {seed}))"
_MAJORITY = """aggregate(sequence(0, 63), 0L, (f, b) ->
    f | if(2 * aggregate(hashes, 0, (c, x) -> c + getbit(x, b)) > size(hashes), shiftleft(1L, b), 0L))"""


def fingerprinted(rows: DataFrame, words: str) -> DataFrame:
    """The rows with both halves of the fingerprint of an array of hashed words."""
    rows = rows.withColumn("ordered", F.array_sort(words))
    for seed, name in enumerate(HALVES):
        rows = rows.withColumn("hashes", F.expr(_OCCURRENCES.format(seed=seed))).withColumn(name, F.expr(_MAJORITY))
    return rows.drop("ordered", "hashes")


def word_hashes(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda word: word != ""), lambda word: F.xxhash64(word))


def shingles(words: Column, size: int) -> Column:
    """Hashes of ``size`` successive words; none if there are fewer words."""

    def at(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + step) for step in range(size)])

    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), at)).otherwise(
        F.array().cast("array<bigint>"))


def shingles_by_size(words: Column, size: Column, sizes: list[int]) -> Column:
    out = F.when(F.lit(False), F.array().cast("array<bigint>"))
    for number in sizes:
        out = out.when(size == number, shingles(words, number))
    return out


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The stored table, marked for broadcast if it has few rows."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def matches(docs: DataFrame, id_column: str, text: str, items: DataFrame, item_column: str, item_text: str) -> DataFrame:
    """A row per document and item that some window of it matches: doc_id, item_id, similarity of the best window, its
    first word's place from 0 and its number of words."""
    item = items.select(F.col(item_column).alias("item_id"), word_hashes(F.col(item_text)).alias("words"))
    item = item.where(F.size("words") > 0).withColumns({
        "number": F.monotonically_increasing_id(), "n": F.size("words"), "k": F.least(F.size("words"), F.lit(SIZE))})
    sizes = list(range(1, SIZE + 1))
    item = item.withColumn("item_shingles", shingles_by_size(F.col("words"), F.col("k"), sizes))
    item = stored(fingerprinted(item, "words").drop("words"), "items")
    sizes = sorted(row.k for row in item.select("k").distinct().collect())  # five at most
    wanted = stored(item.select("n", "k", F.explode("item_shingles").alias("shingle")).distinct(), "item-shingles")
    index = item.select("number", F.col("n").alias("item_n"), *(F.col(name).alias(f"item_{name}") for name in HALVES),
                        F.explode(F.concat(*_near())).alias("near"))

    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    marks = _marks(texts, small(wanted), sizes)
    starts = marks.withColumn("starts", F.expr(_STARTS)).where(F.size("starts") > 0).drop("places")
    windows = _windows(texts, stored(starts, "window-starts"), sizes)
    windows = stored(windows.withColumn("window", F.monotonically_increasing_id()), "windows")

    block = F.explode(F.array(*_blocks(""))).alias("block")
    met = windows.select("window", "n", *HALVES, block).join(small(stored(index, "block-index")), F.expr("n = item_n AND block = near"))
    apart = [F.bit_count(F.col(name).bitwiseXOR(F.col(f"item_{name}"))) for name in HALVES]
    met = met.where(apart[0] + apart[1] <= RADIUS)
    # A pair may meet in several blocks; only the first in which it could counts.
    pairs = F.arrays_zip(F.array(*_blocks("")).alias("a"), F.array(*_blocks("item_")).alias("b"))
    near = F.transform(pairs, lambda x: F.bit_count(x["a"].bitwiseXOR(x["b"])) <= NEAR)
    met = met.where(F.shiftright("block", 16) == F.array_position(near, True) - 1).select("window", "number")

    known = small(item.select("number", "item_id", "item_shingles"), BROADCAST_ROWS // 20)
    met = windows.select("window", "doc_id", "n", "start", "shingles").join(met, "window").join(known, "number")
    met = met.withColumn("shared", _shared(F.col("shingles"), F.col("item_shingles")))
    met = met.withColumn("total", F.size("shingles") + F.size("item_shingles") - F.col("shared"))
    met = met.where(F.col("shared") * LEAST.denominator >= F.col("total") * LEAST.numerator)
    best = F.max(F.struct((F.col("shared") / F.col("total")).alias("similarity"), (-F.col("start")).alias("back"), "n"))
    return met.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("first_word"), F.col("best.n").alias("n_words"))


def clean(docs: DataFrame, id_column: str, text: str, items: DataFrame, item_column: str, item_text: str) -> DataFrame:
    """The rows of ``docs`` that match no item."""
    found = matches(docs, id_column, text, items, item_column, item_text).select("doc_id").distinct()
    same = F.col(f"given.{id_column}").eqNullSafe(F.col("found.doc_id"))
    return docs.alias("given").join(found.alias("found"), same, "left_anti")


def _blocks(prefix: str) -> list[Column]:
    """Values of the blocks of both halves, each with its number above them."""
    out = []
    for name in HALVES:
        offset = 0
        for width in BLOCKS:
            value = F.shiftrightunsigned(F.col(prefix + name), offset).bitwiseAND((1 << width) - 1).cast("int")
            out.append(value.bitwiseOR(F.lit(len(out) << 16)))
            offset += width
    return out


def _near() -> list[Column]:
    """Per block all values in at most ``NEAR`` bits from its own."""

    def around(value: Column, width: int) -> Column:
        masks = [sum(1 << bit for bit in chosen) for count in range(NEAR + 1) for chosen in combinations(range(width), count)]
        every = F.expr(f"array({', '.join(map(str, masks))})")
        return F.transform(every, lambda mask: value.bitwiseXOR(mask))

    return [around(value, width) for value, width in zip(_blocks(""), BLOCKS * len(HALVES), strict=True)]


def _marks(texts: DataFrame, wanted: DataFrame, sizes: list[int]) -> DataFrame:
    """Per document and item size the places of the shingles that items of this size have."""
    words = texts.select("doc_id", word_hashes(F.col("text")).alias("words"))
    placed = None
    for size in sizes:
        part = words.select("doc_id", F.lit(size).alias("k"), F.posexplode(shingles(F.col("words"), size)).alias("place", "shingle"))
        placed = part if placed is None else placed.union(part)
    if placed is None:
        placed = words.select("doc_id", F.lit(0).alias("k"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("shingle")).limit(0)
    return placed.join(wanted, ["k", "shingle"]).groupBy("doc_id", "n", "k").agg(
        F.sort_array(F.collect_set("place")).alias("places"))


# Starts of windows that hold enough marked shingles: for each run of as many marks as are needed, the starts from which
# a window reaches from its first to its last one. A window of n words has n - k + 1 shingles.
_NEED = f"((n - k + 1) * {LEAST.numerator} + {LEAST.denominator - 1}) div {LEAST.denominator}"
_STARTS = f"""if(size(places) < {_NEED}, array(), array_distinct(flatten(transform(
    sequence(0, size(places) - cast({_NEED} as int)),
    j -> if(places[j + {_NEED} - 1] - places[j] <= n - k,
            sequence(greatest(places[j + {_NEED} - 1] - (n - k), 0), places[j]), array())))))"""


def _windows(texts: DataFrame, starts: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows with their fingerprint and shingles. Windows over the end of a text are moved back into it."""
    wanted = starts.withColumnRenamed("doc_id", "of")
    rows = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("of"))).select(
        "doc_id", "n", "k", "starts", word_hashes(F.col("text")).alias("words"))
    inside = F.expr("array_distinct(transform(starts, s -> greatest(0, least(s, size(words) - n))))")
    rows = rows.where(F.size("words") > 0).select("doc_id", "n", "k", "words", F.explode(inside).alias("start"))
    rows = rows.withColumn("own", F.expr("slice(words, start + 1, n)")).drop("words").distinct()
    rows = rows.withColumn("shingles", shingles_by_size(F.col("own"), F.col("k"), sizes))
    return fingerprinted(rows, "own").select("doc_id", "n", "start", "shingles", *HALVES)


def _shared(a: Column, b: Column) -> Column:
    """Sum of the smaller weights of two lists as weighted sets."""
    common = F.array_intersect(a, b)

    def weight(values: Column, value: Column) -> Column:
        return F.size(F.filter(values, lambda x: x == value))

    counted = F.aggregate(common, F.lit(0), lambda total, value: total + F.least(weight(a, value), weight(b, value)))
    single = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(single, F.size(common)).otherwise(counted)
