"""Groups of spelling variants: words one edit apart, by k-d trees over letter counts.

Words are counted over whole texts. Inserting or deleting a letter changes one letter count by one, replacing a letter
changes two, so words one edit apart are at most 2 apart in the sum of absolute differences (L1) of their letter counts: exactly
2 for words of equal length, exactly 1 for lengths that differ by one. For each such pair of lengths the counts of the words
of the longer length are the points of a k-d tree, and the words of the other length (or the same) search the ball around
their own counts. A subtree whose box is farther away than the radius is pruned; what is found has its letter order verified.

The upper levels of the trees cut the words of a length into cells, which become units of work: a word goes to the cell
that has its counts and, as a query, to every cell whose box its ball meets. Cuts come from a bounded sample of the words
(``SAMPLED``, by hash) and only balance the cells; any cuts give the same result. A cell with more words or queries
than a task should hold is dealt by hash as a grid of parts, each with a part of both. Tasks build the lower levels. There
letter counts are unary bits, so boxes are bitwise unions and intersections and distances are numbers of bits.

A word has at most some 180 near words per letter, so no group is unbounded, and a unit returns one row per word, with the number
of its near words there and the best of them, never pairs. Forms have at least twice the occurrences of their word, so
chains of forms have no cycles, and their ends are found by pointer doubling.

Null texts have no words; a null id counts as an empty text before the colon. Rows that repeat an id or a text count each.
Texts and words may be of any length. An empty table, or one without frequent words, gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import stored

LEAST_LENGTH, LEAST_COUNT, DELETED_EACH = 5, 3, 97
# All letters have one byte in this encoding, in the order of their code points.
LETTERS = "latin-1"
SEGMENT = 1 << 20  # code points searched at a time
COUNTED = 1 << 19  # distinct words that a task counts before it sends them on
SAMPLED, SAMPLED_LENGTH, SAMPLED_CELL = 1 << 16, 64, 16
CELL, QUERIES = 1 << 15, 1 << 16  # words and queries of a unit
LEAF = 32
PAIRS = 1 << 17
UNIT = ("cell", "part", "share")

# A cell, or (letter, most, cells with at most that many of it, cells with more).
Cells = int | tuple[int, int, "Cells", "Cells"]


def variants(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Columns ``word``, ``form`` (its most frequent near word, if at least twice as frequent), ``root`` (the last of the
    chain of forms), ``n`` (occurrences), ``n_near`` (near words) and ``form_n``."""
    words = stored(frequent_words(documents, id_column, text), "words")
    near = stored(near_words(words), "near-words")
    of_form = F.col("best.n") >= 2 * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(of_form, F.col("best.word")).alias("form"), F.when(of_form, F.col("best.n")).alias("form_n"))
    formed = stored(joined, "formed-words")
    out = formed.join(_roots(formed), "word", "left")

    def plain(name: str):
        return F.decode(name, "ISO-8859-1").alias(name)

    return out.withColumn("root", F.coalesce("root", "word")).select(
        plain("word"), plain("form"), plain("root"), "n", "n_near", "form_n")


def frequent_words(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Columns ``word``, one byte per letter, and ``n``. In every text, words whose hash the number ``DELETED_EACH`` divides
    lose a letter first."""
    rows = documents.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    return rows.where("text IS NOT NULL").mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)


def _runs(text: str) -> Iterator[list[str]]:
    """Maximal runs of letters that are long enough, some at a time; no run is cut."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SEGMENT)
        if end < len(text) and (rest := _ANY.match(text, end)):
            end = rest.end()
        yield RUN.findall(text, at, end)
        at = end


_ANY = re.compile("[a-zÀ-ÿ]+")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def sent() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        lowered = pc.ascii_lower(batch.column("text"))
        for at, key in enumerate(batch.column("id").to_pylist()):
            start = zlib.crc32(f"{key}:".encode())
            for runs in _runs(lowered[at].as_py()):
                for run, n in Counter(runs).items():
                    hashed = zlib.crc32(run.encode(), start)
                    if not hashed % DELETED_EACH:
                        place = hashed % len(run)
                        run = run[:place] + run[place + 1:]
                        if len(run) < LEAST_LENGTH:
                            continue
                    counts[run.encode(LETTERS)] += n
                if len(counts) >= COUNTED:
                    yield sent()
    if counts:
        yield sent()


def near_words(words: DataFrame) -> DataFrame:
    """Columns ``word``, ``n_near`` and ``best`` (the near word with the greatest n, the first of equals) for each of
    ``words`` (``word``, ``n``) that has near words."""
    sizes = words.groupBy(F.octet_length("word").alias("size")).agg(F.count("*").alias("n"))
    lengths = {row["size"]: row.n for row in sizes.collect()}  # a row per length of a word
    short = words.where(F.octet_length("word") <= SAMPLED_LENGTH)
    sample = short.orderBy(F.xxhash64("word"), "word").limit(SAMPLED).collect()
    total = sum(n for size, n in lengths.items() if size <= SAMPLED_LENGTH)
    trees, cells = _cells(lengths, [bytes(row.word) for row in sample], len(sample) / max(total, 1))
    routed = stored(words.mapInArrow(_router(trees), "cell int, query boolean, word binary, n bigint"), "routed-words")
    units = _dealt(routed, words).repartition(*UNIT).sortWithinPartitions(*UNIT, "query", F.desc("n"), "word")
    found = units.mapInArrow(_search, "word binary, n_near bigint, best_n bigint, best binary")
    least = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("least")).select(
        "word", "n_near", F.struct((-F.col("least.less")).alias("n"), F.col("least.word").alias("word")).alias("best"))


def _dealt(routed: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of each cell with ``part`` of its words and ``share`` of its queries, so that every word meets every query once."""
    counts = routed.groupBy("cell").agg(F.count_if(~F.col("query")).alias("words"), F.count_if("query").alias("queries"))
    grid = counts.select(
        "cell", F.ceil(F.greatest("words", F.lit(1)) / CELL).cast("int").alias("parts"),
        F.ceil(F.greatest("queries", F.lit(1)) / QUERIES).cast("int").alias("shares")).where("parts > 1 OR shares > 1")
    rows = routed.join(stored(grid, "large-cells"), "cell", "left")
    own = F.xxhash64("word")

    def places(is_own, count: str):
        count = F.coalesce(F.col(count), F.lit(1))
        return F.when(is_own, F.array(F.pmod(own, count.cast("long")).cast("int"))).otherwise(F.sequence(F.lit(0), count - 1))

    return rows.select("cell", "query", "word", "n", F.explode(places(~F.col("query"), "parts")).alias("part"), "shares").select(
        "cell", "query", "word", "n", "part", F.explode(places(F.col("query"), "shares")).alias("share"))


def _roots(formed: DataFrame) -> DataFrame:
    """Columns ``word`` and ``root`` for the words that have a form."""
    steps = stored(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while steps.where("moved").limit(1).count():
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        steps = stored(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
    return steps.select("word", "root")


# --- cells -------------------------------------------------------------------------------------------------------------

PLACE = np.zeros(256, np.int64)  # number of each letter, by its byte
PLACE[97:123] = np.arange(26)
PLACE[192:256] = np.arange(26, 90)
KINDS = 90


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Occurrences of every letter; ``codes`` has a row per word and a byte per letter."""
    count, length = codes.shape
    out = np.zeros((count, KINDS), np.int32)
    for first in range(0, count, step := max(1, (1 << 22) // max(length, KINDS))):
        part = codes[first:first + step]
        flat = PLACE[part] + np.arange(len(part))[:, None] * KINDS
        out[first:first + step] = np.bincount(flat.ravel(), minlength=len(part) * KINDS).reshape(len(part), KINDS)
    return out


def _cells(lengths: dict[int, int], sample: list[bytes], share: float) -> tuple[dict[int, Cells], int]:
    """Per length its tree of cells, of about ``CELL`` words each, and the number of cells."""
    of_length: dict[int, list[bytes]] = {}
    for word in sample:
        of_length.setdefault(len(word), []).append(word)
    wanted = max(SAMPLED_CELL, CELL * share)
    made = 0

    def cut(counts: np.ndarray) -> Cells:
        nonlocal made
        if len(counts) > wanted and (at := _cut(counts)):
            low = counts[:, at[0]] <= at[1]
            return (*at, cut(counts[low]), cut(counts[~low]))
        made += 1
        return made - 1

    trees = {}
    for length in sorted(lengths):
        own = of_length.get(length, [])
        codes = np.frombuffer(b"".join(own), np.uint8).reshape(len(own), length)
        trees[length] = cut(letter_counts(codes))
    return trees, made


def _cut(counts: np.ndarray) -> tuple[int, int] | None:
    """Letter of the greatest variance and the count that halves the words best, or None for equal counts."""
    spread = counts.var(axis=0)
    letter = int(spread.argmax())
    if not spread[letter]:
        return None
    values = np.sort(counts[:, letter])
    most = int(values[(len(values) - 1) // 2])
    if most == values[-1]:
        most = int(values[np.searchsorted(values, most) - 1])
    return letter, most


def _reached(tree: Cells, counts: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Cells and the words whose counts are at most ``radius`` away from the cell's box."""
    waiting = [(tree, np.arange(len(counts)), {})]
    while waiting:
        node, rows, bounds = waiting.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            yield node, rows
            continue
        letter, most, low, high = node
        at_least, at_most = bounds.get(letter, (0, None))
        for child, limits in ((low, (at_least, most)), (high, (most + 1, at_most))):
            box = {**bounds, letter: limits}
            away = np.zeros(len(rows), np.int64)
            for name, (least, greatest) in box.items():
                own = counts[rows, name]
                away += np.maximum(least - own, 0)
                if greatest is not None:
                    away += np.maximum(own - greatest, 0)
            waiting.append((child, rows[away <= radius], box))


def _router(trees: dict[int, Cells]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("word")).to_numpy()
            for length in np.unique(sizes).tolist():
                rows = pa.array(np.flatnonzero(sizes == length))
                own = batch.take(rows)
                counts = letter_counts(_codes(own.column("word"), length))
                jobs = [(trees[length], 0, False), (trees[length], 2, True)]
                if length + 1 in trees:
                    jobs.append((trees[length + 1], 1, True))
                for tree, radius, query in jobs:
                    for cell, places in _reached(tree, counts, radius):
                        part = own.take(pa.array(places))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(places), cell, np.int32)), pa.array(np.full(len(places), query)),
                            part.column("word"), part.column("n"),
                        ], ["cell", "query", "word", "n"])

    return run


def _codes(words: pa.Array, length: int) -> np.ndarray:
    """Words of one length as rows of bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)
    first = int(offsets[words.offset])
    data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.zeros(0, np.uint8)
    return data[first:first + len(words) * length].reshape(len(words), length)


# --- search in a unit ----------------------------------------------------------------------------------------------------


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit, the words of a unit before its queries, both by falling n."""
    unit, waiting, search = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(name).to_numpy() for name in UNIT])
        query = batch.column("query").to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(batch.column("word")).to_numpy()
        new = np.ones(batch.num_rows, bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0) | (query[1:] != query[:-1]) | (sizes[1:] != sizes[:-1])
        edges = np.flatnonzero(new).tolist()
        # Queries of a unit have two lengths, mixed by n; they are searched length by length.
        at = 0
        while at < len(edges):
            first, last = edges[at], at
            key = tuple(keys[:, first].tolist())
            while last + 1 < len(edges) and tuple(keys[:, edges[last + 1]].tolist()) == key and query[edges[last + 1]] == query[first]:
                last += 1
            end = edges[last + 1] if last + 1 < len(edges) else batch.num_rows
            part = batch.slice(first, end - first).select(["word", "n"])
            if key != unit:
                if search:
                    yield from search.of_words()
                unit, waiting, search = key, [], None
            if not query[first]:
                waiting.append(part)
            else:
                if waiting:
                    search, waiting = Unit(pa.Table.from_batches(waiting).combine_chunks()), []
                if search:
                    own = sizes[first:end]
                    for length in np.unique(own).tolist():
                        yield from search.of_queries(part.take(pa.array(np.flatnonzero(own == length))), length)
            at = last + 1
    if search:
        yield from search.of_words()


class Unit:
    """Words of one length, by falling n, with a k-d tree over their distinct letter counts."""

    def __init__(self, words: pa.Table):
        self.words = words.column("word").combine_chunks()
        self.n = words.column("n").to_numpy()
        self.length = len(self.words[0].as_py())
        self.codes = _codes(self.words, self.length)
        counts = letter_counts(self.codes)
        self.low, self.high = counts.min(axis=0), counts.max(axis=0)
        self.ranged = np.flatnonzero(self.high > self.low)
        bits = self._bits(counts)
        self.by_point = np.lexsort(bits.T) if bits.shape[1] else np.arange(len(bits))
        ordered = bits[self.by_point]
        self.start = np.flatnonzero(np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1))))
        self.size = np.diff(self.start, append=len(bits))
        points = ordered[self.start]
        self.order, self.nodes = _tree(counts[self.by_point[self.start]], points)
        self.points = points[self.order]
        self.found = np.zeros(len(bits), np.int64)  # shorter near words, of which the first is the best
        self.best_n = np.zeros(len(bits), np.int64)
        self.best: list[bytes | None] = [None] * len(bits)

    def _bits(self, counts: np.ndarray) -> np.ndarray:
        """Counts within the range of this unit's words as unary bits."""
        widths = (self.high - self.low)[self.ranged]
        total = int(widths.sum())
        letters = np.repeat(self.ranged, widths)
        levels = np.arange(total) - np.repeat(np.cumsum(widths) - widths, widths) + self.low[letters]
        out = np.zeros((len(counts), -(-total // 64) * 8), np.uint8)
        for first in range(0, len(counts), step := max(1, (1 << 22) // max(total, 1))):
            part = counts[first:first + step]
            out[first:first + step, :-(-total // 8)] = np.packbits(part[:, letters] > levels, axis=1)
        return out.view(np.uint64)

    def of_queries(self, rows: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
        """Near words of queries of one length, a letter shorter than the words or as long."""
        queries, radius = rows.column("word"), 2 - (self.length - length)
        codes, n = _codes(queries, length), rows.column("n").to_numpy()
        counts = letter_counts(codes)
        outside = (np.maximum(counts - self.high, 0) + np.maximum(self.low - counts, 0)).sum(axis=1)
        found, best = np.zeros(len(n), np.int64), np.full(len(n), len(self.n))
        for query, point in self._near_points(self._bits(counts), outside, radius):
            for a, b in self._members(query, point):
                near = _one_replaced(codes[a], self.codes[b]) if length == self.length else _one_inserted(codes[a], self.codes[b])
                a, b = a[near], b[near]
                found += np.bincount(a, minlength=len(found))
                np.minimum.at(best, a, b)
                if length < self.length:
                    self._note(queries, n, a, b)
        has = np.flatnonzero(found)
        if len(has):
            yield pa.RecordBatch.from_arrays([
                queries.take(pa.array(has)), pa.array(found[has]), pa.array(self.n[best[has]]), self.words.take(pa.array(best[has])),
            ], ["word", "n_near", "best_n", "best"])

    def _note(self, queries: pa.Array, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Count these queries for the words; one with a greater n, or an equal n and a smaller text, is better."""
        self.found += np.bincount(b, minlength=len(self.found))
        order = np.lexsort((a, b))  # queries of a batch come by falling n and then by text
        a, b = a[order], b[order]
        first = np.flatnonzero(np.diff(b, prepend=-1))
        for query, word in zip(a[first].tolist(), b[first].tolist(), strict=True):
            text, count = queries[query].as_py(), int(n[query])
            if self.best[word] is None or (-count, text) < (-self.best_n[word], self.best[word]):
                self.best[word], self.best_n[word] = text, count

    def of_words(self) -> Iterator[pa.RecordBatch]:
        has = np.flatnonzero(self.found)
        if len(has):
            yield pa.RecordBatch.from_arrays([
                self.words.take(pa.array(has)), pa.array(self.found[has]), pa.array(self.best_n[has]),
                pa.array([self.best[at] for at in has.tolist()], pa.binary()),
            ], ["word", "n_near", "best_n", "best"])

    def _near_points(self, bits: np.ndarray, outside: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries and points at that distance exactly. ``outside`` is what the bits do not show of it."""
        waiting = [(0, np.flatnonzero(outside <= radius))]
        while waiting:
            number, rows = waiting.pop()
            first, end, union, common, left, right = self.nodes[number]
            own = bits[rows]
            away = outside[rows] + np.bitwise_count(own & ~union).sum(axis=1, dtype=np.int64) \
                + np.bitwise_count(common & ~own).sum(axis=1, dtype=np.int64)
            rows = rows[away <= radius]
            if not len(rows):
                continue
            if left >= 0:
                waiting += [(left, rows), (right, rows)]
                continue
            for at in range(0, len(rows), step := max(1, (1 << 19) // (end - first))):
                some = rows[at:at + step]
                apart = np.repeat(outside[some, None], end - first, axis=1)
                for column in range(bits.shape[1]):
                    apart += np.bitwise_count(bits[some, column, None] ^ self.points[first:end, column])
                query, point = np.nonzero(apart == radius)
                if len(query):
                    yield some[query], self.order[first + point]

    def _members(self, query: np.ndarray, point: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries and words that have the counts of the points, some at a time."""
        size = self.size[point]
        total = np.cumsum(size)
        limit = max(1, min(PAIRS, (1 << 23) // self.length))
        at = 0
        while at < len(query):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, "right")))
            count = size[at:end]
            owner = np.repeat(np.arange(at, end), count)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            yield query[owner], self.by_point[self.start[point[owner]] + place]
            at = end


def _tree(counts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """Order of the points by leaf, and per node its first and last point, the union and the intersection of their bits
    and its two children (-1 in a leaf)."""
    order, nodes = np.arange(len(bits)), []
    waiting = [(0, len(bits), None)]
    while waiting:
        first, end, parent = waiting.pop()
        own = order[first:end]
        number = len(nodes)
        nodes.append([first, end, np.bitwise_or.reduce(bits[own], axis=0), np.bitwise_and.reduce(bits[own], axis=0), -1, -1])
        if parent is not None:
            nodes[parent][4 if nodes[parent][4] < 0 else 5] = number
        if end - first > LEAF and (at := _cut(counts[own])):
            low = counts[own, at[0]] <= at[1]
            order[first:end] = np.concatenate((own[low], own[~low]))
            middle = first + int(low.sum())
            waiting += [(first, middle, number), (middle, end, number)]
    return order, [tuple(node) for node in nodes]


def _one_replaced(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one != other).sum(axis=1) == 1


def _one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether ``long`` is ``short`` with one letter more: what differs from its beginning lies behind what differs from its end."""
    length = short.shape[1]
    from_start, from_end = short != long[:, :-1], short != long[:, 1:]
    first = np.where(from_start.any(axis=1), from_start.argmax(axis=1), length)
    last = np.where(from_end.any(axis=1), length - 1 - from_end[:, ::-1].argmax(axis=1), -1)
    return last < first
