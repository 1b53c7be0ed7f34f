"""Exact Jaccard self-join of texts in the metric space of their shingle sets.

Distance is 1 - |x n y| / |x u y|; two texts link when it is at most the radius r. The join has three parts.

1. Texts with equal sets become one point, which stands for all of them.
2. Point pivots. Sets of one shingle are points of the space as well, and only the texts that hold the shingle are
   nearer to such a pivot than 1. Pivots are ordered, rare shingles first; a text lies in the region of its first pivot
   and is replicated to those of the next ones as long as a neighbour within the radius could have its first common
   pivot there: with n shingles, the first n - ceil((1 - radius) * n) + 1, since a neighbour lacks fewer of them. Pivots are
   ordered by how common they are in steps of eight, and by hash within a step. The hash is random, so the first ones of
   a step are all among those that the neighbour lacks with a probability that falls with their number, and ``_reach``
   stops where it is below 2 to the power of -``BITS`` (as rare as two shingles with one hash): after 32 pivots if all
   are of one step. Within a region only texts of like size can link. Regions are summarised before the shuffle by
   intervals of sizes; overlapping intervals connect, and the connected texts are the first regions. Most texts are alone
   in theirs. (Texts as pivots cannot begin: nearly all distances between texts are 1, so no text is nearer to one of them
   than to another.)
   Regions of more than ``CELL`` texts are divided once more in this way, by exact counts of all their shingles, so that
   texts which only share a few shingles part.
3. Text pivots, on every region of more than ``CELL`` texts. One text in ``EACH`` becomes a pivot, by hash, ``PIVOTS`` at
   most. Every text measures its distance to all pivots of its region; its home is the Voronoi cell of the nearest, and
   those within r are links. Texts that links to pivots connect have one label, a point that they all reach. Links that texts
   of one label have with each other would tell nothing new, so only texts of different labels have to meet, and of two
   homes the text of the label with fewer texts in the region visits the other one's (with as many, the larger home's visits
   the smaller). So the texts of a dense group of edited copies stay at home, and those visit that no pivot ties to it.
   If x is at home with pivot p and y is within r of x, then for every other pivot q: d(y,p) <= d(x,p) + r <= d(x,q) + r <=
   d(y,q) + 2r. So y is replicated to the window of p only if d(y,p) is at most 2r more than its distance to its nearest
   pivot, at most r more than the farthest home member of p that it has to meet, and if it is of like size; these bounds are
   kept for the most frequent label of a cell and for all others. Texts are measured twice, once for homes, links and
   bounds, once for windows, so that no row is made for a pair of text and pivot that does not have to meet. In a cell only
   home members meet home and window members. Cells with more than ``CELL`` home members are regions again, with the
   windows as members without a home; all others are joined exactly, unless all members have one label. A cell that holds
   over half of its region's home members, as when all distances are alike, is dealt by hash among copies of its pivot, whose
   home members meet in the same way. No task holds more than ``CELL`` home members; windows stream past them.

Order only affects cost: how common a shingle is comes from per-task summaries of the most frequent ones, ``COMMON_OF_TEXT``
per text at most, of which ``COMMON`` at most go to all tasks.

Texts without words have empty sets and link with nothing; with fewer words than a shingle the whole sequence is one.
Null texts are empty, texts of any length are taken whole. Rows that repeat an id are separate; equal texts always link. Rows
without id link like others, but give no id to their component, which is null if no row of it has one. An empty table gives no rows.
Other columns do not matter, whatever their names. Sets are compared by 64-bit hashes of their shingles, and equal sets by
a 64-bit sum of these.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import tokens
from ledgerlake.llm.components import components, in_few_tasks, small, stored

SIZE = 5
LEAST = Fraction(3, 4)
CELL = 96
EACH = 32
PIVOTS = 256
MEASURED = 256  # texts that one task measures
BITS = 64
STEP = 3  # shingles with 8 occurrences and more are common, in steps of 2 to this power
COMMON = 1 << 20
COMMON_OF_TASK = 1 << 18
COMMON_OF_TEXT = 8  # summaries of a task per text, so that all of them grow with the texts and not with the tasks
COUNTED = 1 << 21  # shingles that a task counts at a time
HELD = 1 << 18  # entries of pivots that a task combines at a time
_SEED = np.uint64(0xA5A5_1234_77F0_0D01)


def join(docs: DataFrame, id_column: str, text: str, size: int = SIZE, least: Fraction = LEAST, cell: int = CELL) -> DataFrame:
    """Columns ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id that links reach; a row per row of
    ``docs``."""
    with short_batches(docs.sparkSession):
        return _join(docs, id_column, text, size, least, cell)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While it lasts, Python workers are handed at most that many rows at a time, which may be long texts or sets."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _join(docs: DataFrame, id_column: str, text: str, size: int, least: Fraction, cell: int) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    sets = stored(rows.mapInArrow(tokens.trimmed(_summaries(size)), "doc_id long, hash long, n int, point long, count long"), "sets")
    texts = sets.where("count IS NULL").select("doc_id", "hash", "n", "point")
    # A point is known by the row of its smallest id, or by a text of it if it has none.
    row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("row")
    points = stored(texts.where("n > 0").groupBy("point").agg(row).select("point", "row.doc_id", "row.hash"), "points")

    frequent = sets.where("count IS NOT NULL").select("point", "count")
    regions = _point_regions(rows, frequent, size, least)
    members = stored(regions.join(points, F.col("node") == F.col("point")).select(
        F.col("component").alias("region"), "point", F.col("doc_id").alias("of"), F.col("hash").alias("own")), "members")
    found = rows.join(small(members.drop("region")), F.expr("hash = own AND doc_id <=> of")).select("point", "text")
    if not texts.where("n > 0").groupBy("point", "doc_id", "hash").count().where("count > 1").isEmpty():
        found = found.dropDuplicates(["point"])  # rows that repeat both id and text
    found = stored(found.mapInArrow(tokens.trimmed(_sets(size)), "point long, n int, shingles binary"), "member-sets")
    links = components(_links(members.select("region", "point"), found, least, cell))

    linked = points.join(links, F.col("point") == F.col("node"), "left").select(
        "point", "doc_id", F.coalesce("component", "point").alias("component"))
    linked = stored(linked, "linked-points")
    lowest = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stored(linked.join(lowest, "component").select("point", "component_id"), "named")
    out = texts.select("doc_id", "n", "point").join(named, "point", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of those that links reach. Rows without id stay; of rows that
    repeat an id one stays, that whose text has the smallest hash, for ids stand for documents."""
    ids = join(docs, id_column, text).where("doc_id = component_id").select(F.col("doc_id").alias(id_column)).distinct()
    kept = docs.where(F.col(id_column).isNotNull()).join(small(stored(ids, "kept-ids")), id_column, "left_semi").select(docs.columns)
    if not docs.where(F.col(id_column).isNotNull()).groupBy(id_column).count().where("count > 1").isEmpty():
        order = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
        kept = kept.groupBy(F.col(id_column).alias("_id")).agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return kept.union(docs.where(F.col(id_column).isNull()))


def _sets(size: int):
    """Rows of point and text as rows of point, number of shingles and these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.pieces(batches):
            sets = tokens.shingle_sets(tokens.words(batch.column("text")), size)
            yield pa.RecordBatch.from_arrays([
                batch.column("point"), pa.array([len(x) for x in sets], pa.int32()),
                pa.array([x.tobytes() for x in sets], pa.binary())], ["point", "n", "shingles"])

    return run


def values_of(shingles: bytes) -> np.ndarray:
    return np.frombuffer(shingles, np.uint64)


def _point_regions(rows: DataFrame, frequent: DataFrame, size: int, least: Fraction) -> DataFrame:
    """Columns ``node``, a point, and ``component``, its region, for the points that are not alone in theirs."""
    total = frequent.groupBy("point").agg(F.sum("count").alias("count")).where(F.col("count") >= 1 << STEP)
    common = total.orderBy(F.desc("count"), "point").limit(COMMON).toArrow()
    shingle = common.column("point").to_numpy().view(np.uint64)
    order = np.argsort(shingle)
    ranks = rows.sparkSession.sparkContext.broadcast((shingle[order], common.column("count").to_numpy()[order].astype(np.int32)))
    near = rows.select("text").mapInArrow(
        tokens.trimmed(_prefixes(size, least, ranks)), "pivot long, point long, low int, high int, other long")
    near = near.repartition(F.coalesce("pivot", "point")).mapInArrow(tokens.trimmed(_regions(least)), "point long, other long")
    return components(near)


def _exact_point_regions(sets: DataFrame, least: Fraction) -> DataFrame:
    """As ``_point_regions``, for rows of point, n and shingles, with the order of shingles by their exact counts. Shingles of
    one text alone come first and connect nothing, so only the others are ordered."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.pieces(batches, "shingles"):
            n = batch.column("n").to_numpy()
            every = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(every), pa.array(np.repeat(batch.column("point").to_numpy(), n)), pa.array(np.repeat(n, n))],
                ["pivot", "point", "n"])

    met = sets.mapInArrow(tokens.trimmed(listed), "pivot long, point long, n int")
    counts = met.groupBy("pivot").agg(F.count("*").alias("count")).where("count > 1")  # tasks count first
    reach = F.expr(f"n - (n * {least.numerator} + {least.denominator - 1}) div {least.denominator} + 1").cast("int")
    shared = met.join(stored(counts, "shared-shingles"), "pivot")
    ordered = shared.groupBy("point", "n").agg(F.sort_array(F.collect_list(F.struct("count", "pivot"))).alias("met"))
    first = F.greatest(reach - (F.col("n") - F.size("met")), F.lit(0))
    near = ordered.select("point", "n", F.explode(F.slice("met", F.lit(1), first)).alias("x")).select(
        F.col("x.pivot").alias("pivot"), "point", "n")
    schema = "pivot long, point long, low int, high int, other long"
    near = near.mapInArrow(tokens.trimmed(_combined_tasks(least)), schema).repartition(F.coalesce("pivot", "point"))
    return components(near.mapInArrow(tokens.trimmed(_regions(least)), "point long, other long"))


def _combined_tasks(least: Fraction):
    """Intervals of sizes per pivot of a task's entries, with links to the first text of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count > HELD:
                yield from _merged(*_columns(held), least)
                held, count = [], 0
        if count:
            yield from _merged(*_columns(held), least)

    return run


def _columns(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(held)
    return table.column("pivot").to_numpy(), table.column("point").to_numpy(), table.column("n").to_numpy().astype(np.int64)


def point_of(values: np.ndarray) -> int:
    """64-bit digest of a set of shingles."""
    total = np.add.reduce(tokens.mix(values ^ _SEED), dtype=np.uint64) if len(values) else np.uint64(0)
    return int(tokens.mix(np.array([total], np.uint64)).view(np.int64)[0])


def _summaries(size: int):
    """Per text its size and point; per task the shingles that it met most often, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "hash", "n", "point", "count"]
        met, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        texts = 0
        for batch in tokens.pieces(batches):
            sets = tokens.shingle_sets(tokens.words(batch.column("text")), size)
            texts += len(sets)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("hash"), pa.array([len(x) for x in sets], pa.int32()),
                pa.array([point_of(x) for x in sets], pa.int64()), pa.nulls(len(sets), pa.int64())], names)
            waiting += sets
            if sum(map(len, waiting)) > COUNTED:
                met, counts = _most_frequent(met, counts, waiting)
                waiting = []
        met, counts = _most_frequent(met, counts, waiting, COMMON_OF_TEXT * texts)
        if len(met):
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(met), pa.int64()), pa.nulls(len(met), pa.int64()), pa.nulls(len(met), pa.int32()),
                pa.array(met.view(np.int64)),
                pa.array(counts)], names)

    return run


def _most_frequent(
    met: np.ndarray, counts: np.ndarray, sets: list[np.ndarray], most: int = COMMON_OF_TASK
) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent values with their counts, at most ``most`` and ``COMMON_OF_TASK``. Of equally frequent ones all tasks
    prefer the same."""
    values, times = met, counts
    if sets:
        values, times = np.unique(np.concatenate(sets), return_counts=True)
        often = times > (len(values) > COMMON_OF_TASK)
        values, inverse = np.unique(np.concatenate((met, values[often])), return_inverse=True)
        times = np.bincount(inverse, np.concatenate((counts, times[often])), len(values)).astype(np.int64)
    most = min(most, COMMON_OF_TASK)
    if len(values) > most:
        kept = np.sort(np.lexsort((values, -times))[:most])
        values, times = values[kept], times[kept]
    return values, times


def _prefixes(size: int, least: Fraction, ranks):
    """Intervals of sizes per pivot, and links from the texts of an interval to the first of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = ranks.value
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        total = 0
        for batch in tokens.pieces(batches):
            for values in tokens.shingle_sets(tokens.words(batch.column("text")), size):
                n = len(values)
                if not n or (point := point_of(values)) in seen:
                    continue
                seen.add(point)
                steps = np.zeros(n, np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, values), len(common) - 1)
                    known = common[at] == values
                    steps[known] = np.log2(counts[at[known]]).astype(np.int64) // STEP
                if steps.any():
                    # Common shingles come last, as in the order of all texts.
                    values = values[np.lexsort((values, steps))]
                reach = _reach(n, np.bincount(steps), least)
                held.append((values[:reach], point, n))
                total += reach
                if total > HELD:
                    yield from _combined(held, least)
                    held, total = [], 0
                if len(seen) > HELD:
                    seen.clear()
        if held:
            yield from _combined(held, least)

    return run


def _reach(n: int, steps: np.ndarray, least: Fraction) -> int:
    """Number of first pivots of a set of ``n`` shingles among which one of any neighbour is; ``steps`` has the number of
    shingles by step."""
    lacking = n - (n * least.numerator + least.denominator - 1) // least.denominator  # at most, in a neighbour
    before = 0
    for size in steps.tolist():
        if before > lacking:
            break
        left = lacking - before
        if left < size:
            # The chance that the first k of the step are all lacking is at most (left / size) ** k.
            more = 1 if left == 0 else math.ceil(BITS / math.log2(size / left))
            return min(lacking + 1, before + more)
        before += size
    return min(n, lacking + 1)


def _combined(held: list[tuple[np.ndarray, int, int]], least: Fraction) -> Iterator[pa.RecordBatch]:
    reach = [len(values) for values, _, _ in held]
    pivot = np.concatenate([values for values, _, _ in held]).view(np.int64)
    point = np.repeat(np.array([point for _, point, _ in held], np.int64), reach)
    n = np.repeat(np.array([n for _, _, n in held], np.int64), reach)
    yield from _merged(pivot, point, n, least)


def _merged(pivot: np.ndarray, point: np.ndarray, n: np.ndarray, least: Fraction) -> Iterator[pa.RecordBatch]:
    heads, low, high, links = _intervals(pivot, point, n, n, least)
    names = ["pivot", "point", "low", "high", "other"]
    yield pa.RecordBatch.from_arrays([
        pa.array(pivot[heads]), pa.array(point[heads]), pa.array(low.astype(np.int32)),
        pa.array(high.astype(np.int32)), pa.nulls(len(heads), pa.int64())], names)
    if len(links[0]):
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(links[0]), pa.int64()), pa.array(links[0]), pa.nulls(len(links[0]), pa.int32()),
            pa.nulls(len(links[0]), pa.int32()), pa.array(links[1])], names)


def _intervals(pivot: np.ndarray, point: np.ndarray, low: np.ndarray, high: np.ndarray, least: Fraction):
    """Merges intervals of sizes of one pivot whose texts could link. Returns the entries that head an interval, the
    intervals, and links from the other entries to their head."""
    order = np.lexsort((point, low, pivot))
    pivot, point, low, high = pivot[order], point[order], low[order], high[order]
    new = np.ones(len(pivot), bool)
    new[1:] = pivot[1:] != pivot[:-1]
    alone = new.copy()
    alone[:-1] &= new[1:]
    top = high.copy()
    # Only pivots with several entries need the running maximum.
    for first in np.flatnonzero(new & ~alone).tolist():
        reach = top[first]
        at = first + 1
        while at < len(pivot) and pivot[at] == pivot[first]:
            if reach * least.denominator < low[at] * least.numerator:
                new[at] = True
                reach = high[at]
            reach = max(reach, high[at])
            at += 1
    heads = np.flatnonzero(new)
    owner = np.repeat(heads, np.diff(np.append(heads, len(pivot))))
    tops = np.maximum.reduceat(high, heads) if len(heads) else high
    linked = np.unique(np.stack((point, point[owner]), axis=1)[(point != point[owner])], axis=0)
    return order[heads], low[heads], tops, (linked[:, 0].copy(), linked[:, 1].copy())


def _regions(least: Fraction):
    """Links between points whose intervals of a pivot overlap, reduced to one tree per connected set of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Entries of a task are bounded by the size of its shuffle partition; a pivot has few after the combination.
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        entry = table.filter(pc.is_valid(table.column("pivot")))
        given = table.filter(pc.is_null(table.column("pivot")))
        _, _, _, found = _intervals(
            entry.column("pivot").to_numpy(), entry.column("point").to_numpy(),
            entry.column("low").to_numpy().astype(np.int64), entry.column("high").to_numpy().astype(np.int64), least)
        first = np.concatenate((found[0], given.column("point").to_numpy()))
        second = np.concatenate((found[1], given.column("other").to_numpy()))
        nodes, places = np.unique(np.concatenate((first, second)), return_inverse=True)
        root = roots(len(nodes), places[:len(first)].tolist(), places[len(first):].tolist())
        other = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[root[other]])], ["point", "other"])

    return run


def roots(count: int, first: list[int], second: list[int]) -> np.ndarray:
    """Smallest member of each of ``count`` nodes' set, after all links."""
    parent = list(range(count))

    def find(node: int) -> int:
        while parent[node] != node:
            parent[node] = node = parent[parent[node]]
        return node

    for a, b in zip(first, second, strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return np.array([find(node) for node in range(count)], np.int64)


# --- regions of texts ---


def links(common, n, m, least: Fraction):
    return common * least.denominator >= least.numerator * (n + m - common)


def _links(members: DataFrame, sets: DataFrame, least: Fraction, cell: int) -> DataFrame:
    """Links within the regions of ``members``, rows of region and point; ``sets`` has point, n and shingles. Of each
    connected set of a cell one tree. Rows of a few numbers move; sets are only joined where they are compared."""
    count = members.count()
    sizes = in_few_tasks(members.groupBy("region").agg(F.count("*").alias("texts")), count)
    crowded = stored(sizes.where(F.col("texts") > cell).select("region"), "crowded-regions")
    if not crowded.isEmpty():
        inside = stored(members.join(small(crowded), "region").select("point"), "crowded")
        parts = _exact_point_regions(sets.join(small(inside), "point", "left_semi"), least)
        others = members.join(small(crowded), "region", "left_anti").select("region", "point")
        members = others.union(parts.select(F.col("component").alias("region"), F.col("node").alias("point")))
    now = members.select("region", "point", F.col("point").alias("label"), F.lit(True).alias("home"), F.lit(None).cast("long").alias("parent"))
    now = stored(now, "first-regions")
    finished, found, level = [], [], 0
    while True:
        homes = now.groupBy("region").agg(
            F.count_if("home").alias("texts"), F.max("parent").alias("parent"),
            F.min(F.when(F.col("home"), F.xxhash64("point", F.lit(level)))).alias("first"),
            (F.min("label") < F.max("label")).alias("differ"))
        homes = in_few_tasks(homes, count)
        large = homes.where((F.col("texts") > cell) & F.col("differ") & (F.col("parent").isNull() | (2 * F.col("texts") <= F.col("parent"))))
        large = stored(large.drop("parent", "differ"), "large")
        if large.isEmpty():
            break
        finished.append(now.join(small(large), "region", "left_anti").select("region", "point", "label", "home"))
        now, tied = _cells(now.drop("parent").join(small(large), "region"), sets, least, level)
        found.append(tied)
        level += 1
    for part in finished:
        now = now.select("region", "point", "label", "home").union(part)
    pairs = _joined(now, sets, least, cell)
    for tied in found:
        pairs = pairs.union(tied)
    return pairs


def _cells(rows: DataFrame, sets: DataFrame, least: Fraction, level: int) -> tuple[DataFrame, DataFrame]:
    """Home and window members of the Voronoi cells in each region, and links of texts with the points that label them. ``rows``
    have region, point, label and home, with the number of home members (``texts``) and the least of their hashes (``first``)
    of the region."""
    hashed = F.xxhash64("point", F.lit(level))
    pivots = F.least(F.ceil(F.col("texts") / EACH), F.lit(PIVOTS))
    chosen = F.col("home") & ((F.abs(hashed % 1_000_000) / 1_000_000.0 < pivots / F.col("texts")) | (hashed == F.col("first")))
    columns = ["home", "texts", "label"]
    dealt = _dealt(rows, rows.where(chosen), sets, columns, "measuring")
    schema = "region long, point long, n int, home boolean, texts long, label long, nearest long, distance double, tied long"
    measured = stored(dealt.mapInArrow(tokens.trimmed(_nearest(least)), schema), "measured")
    # Pivots of a region are few, and so are different links between them.
    between = measured.where("nearest IS NULL").select("region", "point", "tied").distinct().repartition("region")
    roots_of = stored(between.mapInArrow(tokens.trimmed(_roots_of_pivots), "region long, tied long, root long"), "pivot-roots")
    labelled = measured.where("nearest IS NOT NULL").join(small(roots_of), ["region", "tied"], "left")
    labelled = stored(labelled.withColumn("label", F.coalesce("root", "tied", "label")).drop("root", "tied"), "labelled")

    homes = labelled.where("home")
    sizes = stored(homes.groupBy("region", "label").agg(F.count("*").alias("size")), "label-sizes")
    groups = homes.groupBy("region", "nearest", "label").agg(
        F.max("distance").alias("reach"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("texts").alias("texts"))
    groups = stored(groups.join(small(sizes), ["region", "label"]), "cell-labels")
    tops = groups.groupBy("region", "nearest").agg(
        F.max(F.struct("size", "label", "reach", "low", "high")).alias("top"), F.max("texts").alias("texts"))
    rest = groups.join(tops.drop("texts"), ["region", "nearest"]).where("label <> top.label").groupBy("region", "nearest").agg(
        F.max("size").alias("rest_size"), F.max("reach").alias("rest_reach"), F.min("low").alias("rest_low"), F.max("high").alias("rest_high"))
    bounds = tops.join(rest, ["region", "nearest"], "left").select(
        "region", F.col("nearest").alias("point"), "texts", F.col("top.label").alias("label"), F.col("top.size").alias("size"),
        F.col("top.reach").alias("reach"), F.col("top.low").alias("low"), F.col("top.high").alias("high"),
        "rest_size", "rest_reach", "rest_low", "rest_high")
    # A label of more than half of the home members is the largest, so its texts wait for visits.
    visitors = labelled.join(small(sizes), ["region", "label"], "left").where("NOT (home AND 2 * size > texts)").drop("n")
    columns += ["size", "nearest", "reach", "low", "high", "rest_size", "rest_reach", "rest_low", "rest_high"]
    dealt = _dealt(visitors, bounds, sets, columns, "visiting")
    schema = "region long, point long, texts long, label long, pivot long"
    windows = dealt.mapInArrow(tokens.trimmed(_windows(least)), schema)

    def members(texts: DataFrame, pivot: str, home: bool) -> DataFrame:
        return texts.select(F.xxhash64("region", pivot).alias("region"), "point", "label", F.lit(home).alias("home"), F.col("texts").alias("parent"))

    now = stored(members(homes, "nearest", True).union(members(windows, "pivot", False)), "cells")
    return now, labelled.where("label <> point").select("point", F.col("label").alias("other"))


def _dealt(texts: DataFrame, pivots: DataFrame, sets: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Texts with their sets and the given columns, of which they may lack some, in parts of about ``MEASURED``; each part has all
    pivots of its region first."""
    parts = F.ceil(F.col("texts") / MEASURED).cast("int")
    own = texts.withColumns({"part": F.pmod(F.xxhash64("point"), parts).cast("int"), "role": F.lit(1)})
    copies = pivots.withColumns({"part": F.explode(F.sequence(F.lit(0), parts - 1)), "role": F.lit(0)})
    rows = copies.unionByName(own, allowMissingColumns=True).select("region", "part", "role", "point", *columns)
    rows = sets.join(small(stored(rows, label)), "point")
    rows = rows.select("region", "part", "role", "point", "n", *columns, "shingles").repartition("region", "part")
    return rows.sortWithinPartitions("region", "part", "role", "point")


class Index:
    """Sets to measure others against: their shingles in order, with the places of the sets that have them."""

    def __init__(self, sets: list[np.ndarray]):
        self.lengths = np.array([len(x) for x in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.lengths)
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.every, self.owner = every[order], owner[order]

    def common(self, values: np.ndarray) -> np.ndarray:
        """Number of shingles that each set shares with ``values``."""
        left, right = np.searchsorted(self.every, values), np.searchsorted(self.every, values, "right")
        spans = right - left
        hits = np.repeat(left - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
        return np.bincount(self.owner[hits], minlength=len(self.lengths))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Slices of rows with equal keys, and whether a slice begins a new run of them."""
    last = None
    for batch in tokens.pieces(batches, "shingles"):
        values = np.stack([batch.column(key).to_numpy(zero_copy_only=False).astype(np.int64) for key in keys])
        edges = np.flatnonzero(np.concatenate(([True], (values[:, 1:] != values[:, :-1]).any(axis=0)))).tolist()
        for first, end in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            key = tuple(values[:, first].tolist())
            yield key != last, batch.slice(first, end - first)
            last = key


class Pivots:
    """Pivots of a part of a region, which come before its texts: their rows and an index of their sets."""

    def __init__(self):
        self.rows: list[pa.RecordBatch] = []
        self.index = None

    def column(self, name: str) -> np.ndarray:
        return pa.Table.from_batches(self.rows).column(name).to_numpy()

    def taken(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        """Takes the pivots among the rows and returns the rest, which are texts."""
        front = pc.sum(pc.equal(rows.column("role"), 0)).as_py()
        if front:
            self.rows.append(rows.slice(0, front))
        if front < rows.num_rows and self.index is None:
            self.index = Index([values_of(x) for part in self.rows for x in part.column("shingles").to_pylist()])
        return rows.slice(front)

    def measured(self, texts: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per text its number of shingles, those it shares with each pivot, and the distances to them."""
        for shingles in texts.column("shingles").to_pylist():
            values = values_of(shingles)
            common = self.index.common(values)
            yield len(values), common, 1 - common / (self.index.lengths + len(values) - common)


def _nearest(least: Fraction):
    """Per text its nearest pivot and one that it is connected with (``tied``), by a link or by its label; and rows without a
    nearest one that tie pivots with each other, fewer of them than pivots in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["region", "point", "n", "home", "texts", "label"]
        pivots, region, group = Pivots(), None, np.zeros(0, np.int64)

        def between() -> Iterator[pa.RecordBatch]:
            other = np.flatnonzero(group != np.arange(len(group)))
            if len(other):
                names, none = pivots.column("point"), [pa.nulls(len(other), kind) for kind in (
                    pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(other), region, np.int64)), pa.array(names[other]), *none, pa.array(names[group[other]])],
                    [*columns, "nearest", "distance", "tied"])

        for is_new, rows in _runs(batches, ["region", "part"]):
            if is_new:
                yield from between()
                pivots, region, group = Pivots(), rows.column("region")[0].as_py(), np.zeros(0, np.int64)
            texts = pivots.taken(rows)
            if not texts.num_rows:
                continue
            names, labels = pivots.column("point"), pivots.column("label")
            if not len(group):
                group = np.arange(len(names))  # place of the first pivot that each is connected with
            points, own = texts.column("point").to_numpy(), texts.column("label").to_numpy()
            nearest, distances, tied = [], [], []
            for at, (n, common, distance) in enumerate(pivots.measured(texts)):
                # Of equally near pivots one by hash, so that ties do not crowd one cell.
                near = np.flatnonzero(distance == distance.min())
                chosen = near[int(tokens.mix(points[at:at + 1].view(np.uint64))[0] % np.uint64(len(near)))]
                nearest.append(names[chosen])
                distances.append(distance[chosen])
                reached = np.flatnonzero(links(common, n, pivots.index.lengths, least) | (labels == own[at]))
                tied.append(int(names[reached[0]]) if len(reached) else None)
                if len(met := np.unique(group[reached])) > 1:
                    group[np.isin(group, met)] = met[0]
            yield pa.RecordBatch.from_arrays([
                *(texts.column(x) for x in columns), pa.array(np.array(nearest, np.int64)), pa.array(np.array(distances)),
                pa.array(tied, pa.int64())], [*columns, "nearest", "distance", "tied"])
        yield from between()

    return run


def _roots_of_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pivots that are tied with smaller ones of their region, with the smallest that they are connected with."""
    batches = list(batches)
    if not sum(batch.num_rows for batch in batches):
        return
    table = pa.Table.from_batches(batches)
    region = table.column("region").to_numpy()
    ends = [np.stack((region, table.column(x).to_numpy()), axis=1) for x in ("point", "tied")]
    nodes, places = np.unique(np.concatenate(ends), axis=0, return_inverse=True)
    places = places.ravel()
    root = roots(len(nodes), places[:len(region)].tolist(), places[len(region):].tolist())
    other = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes[other, 0]), pa.array(nodes[other, 1]), pa.array(nodes[root[other], 1])], ["region", "tied", "root"])


def _windows(least: Fraction):
    """Rows of texts and the pivots whose home members they have to visit. Pivots have the label of most home members of
    theirs, with its size and bounds, and the same of the rest, if there are others."""
    radius = float(1 - least) + 1e-9
    up, down = least.numerator, least.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = Pivots()
        for is_new, rows in _runs(batches, ["region", "part"]):
            if is_new:
                pivots = Pivots()
            texts = pivots.taken(rows)
            if not texts.num_rows:
                continue
            names, labels = pivots.column("point"), pivots.column("label")
            groups = [[np.nan_to_num(pivots.column(x).astype(np.float64), nan=-1.0) for x in (
                before + "size", before + "reach", before + "low", before + "high")] for before in ("", "rest_")]
            given = zip(*(texts.column(x).to_pylist() for x in ("home", "label", "size", "nearest")), strict=True)
            places, found = [], []
            for at, ((home, label, own, nearest), (n, _, distance)) in enumerate(zip(given, pivots.measured(texts), strict=True)):
                visits = np.zeros(len(names), bool)
                for which, (size, reach, low, high) in enumerate(groups):
                    to = (size > own) | (size == own) & (names < nearest) if home else size > 0
                    to = to & (distance <= reach + radius) & (n * down >= low * up) & (n * up <= high * down)
                    visits |= to & (labels != label) if which == 0 else to
                visits &= distance <= distance.min() + 2 * radius
                if home:
                    visits &= names != nearest
                found.append(names[visits])
                places += [at] * len(found[-1])
            if places:
                whole = texts.select(["region", "point", "texts", "label"]).take(pa.array(places))
                yield pa.RecordBatch.from_arrays([*whole.columns, pa.array(np.concatenate(found))], [*whole.schema.names, "pivot"])

    return run


def _joined(rows: DataFrame, sets: DataFrame, least: Fraction, cell: int) -> DataFrame:
    """Links in cells of several labels. One with more than ``cell`` home members is dealt by hash among copies of its pivot:
    home members of a copy are window members of the copies before it, and windows are those of all copies. If more than
    half of the home members have one label, they stay in their copy and the others visit all copies."""
    sizes = rows.groupBy("region").agg(F.count_if("home").alias("texts"), (F.min("label") < F.max("label")).alias("differ"))
    sizes = stored(sizes.where("differ AND texts > 0").drop("differ"), "cell-sizes")
    most = rows.where("home").join(small(sizes.where(F.col("texts") > cell)), "region").groupBy("region", "label").agg(
        F.count("*").alias("size"), F.max("texts").alias("texts")).where("2 * size > texts")
    most = stored(most.select("region", F.col("label").alias("most")), "cell-labels")
    copies = F.ceil(F.col("texts") / cell).cast("int")
    own = F.pmod(F.xxhash64("point"), copies.cast("long")).cast("int")
    rows = rows.join(sizes, "region").join(small(most), "region", "left").withColumns({"copies": copies, "own": own})
    first = F.when(F.expr("home AND label = most"), F.col("own")).otherwise(F.lit(0))
    last = F.when(F.expr("home AND (most IS NULL OR label = most)"), F.col("own")).otherwise(F.col("copies") - 1)
    rows = rows.withColumn("copy", F.explode(F.sequence(first, last)))
    rows = stored(rows.select("region", "copy", (F.expr("home AND copy = own")).alias("home"), "point"), "cell-members")
    rows = sets.join(small(rows), "point")
    keys = ["region", "copy"]
    dealt = rows.select(*keys, "home", "point", "shingles").repartition(*keys).sortWithinPartitions(*keys, F.desc("home"), "point")
    return dealt.mapInArrow(tokens.trimmed(_pairs(least)), "point long, other long")


def _pairs(least: Fraction):
    """Links of home members with each other and with the window members that come after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[int] = []
        sets: list[np.ndarray] = []
        found: list[tuple[int, int]] = []  # places of home members that link
        index = None

        def tree() -> Iterator[pa.RecordBatch]:
            root = roots(len(names), [a for a, _ in found], [b for _, b in found])
            other = np.flatnonzero(root != np.arange(len(names)))
            if len(other):
                points = np.array(names, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(points[other]), pa.array(points[root[other]])], ["point", "other"])

        for is_new, rows in _runs(batches, ["region", "copy"]):
            if is_new:
                index = index or Index(sets)
                found += _within(index, sets, least)
                yield from tree()
                names, sets, found, index = [], [], [], None
            outside = []
            for point, is_home, shingles in zip(*(rows.column(x).to_pylist() for x in ("point", "home", "shingles")), strict=True):
                values = values_of(shingles)
                if is_home:
                    names.append(point)
                    sets.append(values)
                    continue
                index = index or Index(sets)
                near = np.flatnonzero(links(index.common(values), len(values), index.lengths, least))
                if len(near):
                    outside.append((point, names[near[0]]))
                    found += [(int(near[0]), int(at)) for at in near[1:]]
                    if len(found) > HELD:
                        root = roots(len(names), [a for a, _ in found], [b for _, b in found])
                        found = [(at, int(root[at])) for at in np.flatnonzero(root != np.arange(len(names))).tolist()]
            if outside:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*outside, strict=True)], ["point", "other"])
        index = index or Index(sets)
        found += _within(index, sets, least)
        yield from tree()

    return run


def _within(index: Index, sets: list[np.ndarray], least: Fraction) -> Iterator[tuple[int, int]]:
    """Places of the indexed sets that link with each other."""
    for at, values in enumerate(sets[:-1]):
        near = links(index.common(values)[at + 1:], len(values), index.lengths[at + 1:], least)
        yield from ((at, at + 1 + other) for other in np.flatnonzero(near).tolist())
