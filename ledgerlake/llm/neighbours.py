"""Near-duplicate vectors by a pivot-permutation index.

Every distinct direction-bearing vector is described by its nearest reference vectors (pivots), in order of nearness. The
inverted lists belong to pairs of pivots: a vector is in the list of every pair that it has among its ``NEAREST`` ones, so
two vectors that meet in a list share at least two pivots. A pair that meets in several lists counts in one alone, that of
the two smallest pivots it shares, which the shared pivots tell. What remains is verified by the cosine itself.

The index runs in two steps. The first moves descriptions only, a few bytes per list and vector, and keeps those members of
a list that have a partner there. The second moves these vectors and verifies. A list of more than ``BLOCK`` members is cut
into blocks by a hash, and every pair of blocks becomes a unit of work of its own, so that a group of near copies that
holds a large part of the table is spread over many tasks. No pair leaves a task: a unit returns, per member, its number of
links and one member of its connected part there.

Pivots come from a bounded sample of the distinct vectors (``SAMPLED`` for each pivot, by hash); of sampled vectors that
are nearer than ``APART`` only one becomes a pivot, so a large group of copies does not hold the pivots. Their number grows
with the root of the distinct vectors, up to ``MOST``, and lists stay short. Every vector is indexed. The index is
approximate: a link between vectors that share fewer than two pivots is missed, and no wrong one is returned.

Equal vectors are one vector with a count. Vectors that are null, all zeros or hold nulls, NaN or infinities link with
nothing. Vectors may differ in length: missing components are zeros. Rows that repeat an id are separate vectors. A row
without id is linked like others; its own id cannot become that of a component, and a component whose rows all lack ids has
no id, and each of its rows is kept. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import components, stored

NEAREST = 8  # pivots that describe a vector
FEWEST, MOST = 64, 4096  # pivots
SAMPLED = 3
APART = 0.8
BLOCK = 2048
PIVOT_VALUES = 1 << 23  # numbers in all pivots, which every task holds
PAIRS = 1 << 18  # pairs looked at in one step
UNIT_ROWS = 1 << 14


def near_duplicates(vectors: DataFrame, id_column: str, vector: str, least: float = 0.95) -> DataFrame:
    """Columns ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (smallest id that links reach) and
    ``kept`` (the row has that id) for every row. Rows link when the cosine of their vectors is at least ``least``."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"))
    values = F.col("v").cast("array<double>")
    usable = F.coalesce(
        F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
        & F.exists(values, lambda x: x != 0), F.lit(False))
    distinct = rows.where(usable).groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("copies"))
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    size = nodes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if size.n:
        linked = _linked(nodes, size.n, size.width, least)
    else:
        linked = nodes.sparkSession.createDataFrame([], "node bigint, links bigint, other bigint")
    edges = linked.where("node <> other").select("node", "other")
    component = components(edges)
    # Smallest id of each component, from its members; a vector without links is one of its own.
    member = nodes.select("node", "low", "copies").join(component, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    named = stored(member.join(links, "node", "left").join(lowest, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "named-vectors")
    of_vector = nodes.select("node", F.col("v").alias("same")).join(named, "node")
    own = rows.withColumn("key", F.when(usable, F.col("v")))
    return own.join(of_vector, F.col("key") == F.col("same"), "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def pivots_of(nodes: DataFrame, count: int, width: int) -> np.ndarray:
    """Reference vectors of length 1, none nearer than ``APART`` to another one; their number is bounded, so the
    driver may choose them."""
    wanted = 1 << round(math.log2(4 * math.sqrt(count)))
    wanted = max(2, min(max(FEWEST, min(wanted, MOST)), PIVOT_VALUES // width))
    sample = nodes.orderBy(F.xxhash64("node"), "node").select("v").limit(SAMPLED * wanted).toArrow()
    found = directions(sample.column("v").combine_chunks(), width)
    chosen = np.empty((min(wanted, len(found)), width))
    size = 0
    for one in found:
        if size == len(chosen):
            break
        if not size or (chosen[:size] @ one).max() < APART:
            chosen[size] = one
            size += 1
    return chosen[:size]


def directions(vectors: pa.ListArray, width: int) -> np.ndarray:
    """The vectors in double precision, scaled to length 1; shorter ones are filled with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = vectors.flatten().to_numpy()
    out /= np.abs(out).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _linked(nodes: DataFrame, count: int, width: int, least: float) -> DataFrame:
    """Rows of ``node``, ``links`` (rows linked with it in a unit) and ``other`` (a node that links reach there)."""
    pivots = pivots_of(nodes, count, width)
    described = stored(nodes.select("node", "v").mapInArrow(_describer(pivots, width), "node bigint, pivots array<int>"),
                       "vector-pivots")
    held = min(NEAREST, len(pivots))
    if held < 2:  # all vectors are near one pivot, so one list has them all
        keys = F.array(F.lit(0).cast("long"))
    else:
        keys = F.transform(
            F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in combinations(range(held), 2)]),
            lambda pair: F.get("pivots", pair["a"]).cast("long") * MOST + F.get("pivots", pair["b"]))
    sets = described.withColumn("pivots", F.array_sort("pivots"))
    postings = sets.select("node", "pivots", F.explode(keys).alias("list"))
    sizes = stored(postings.groupBy("list").agg(F.count("*").alias("n")).where("n > 1"), "list-sizes")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int")
    units = postings.join(sizes, "list").select(
        "node", "pivots", "list", block.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("partner")
    ).select("node", "pivots", "list", "block", F.least("block", "partner").alias("first"),
             F.greatest("block", "partner").alias("second"))
    unit = ["list", "first", "second"]

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(*unit).sortWithinPartitions(*unit)

    partners = stored(dealt(units).mapInArrow(
        _partner_finder(held), "node bigint, pivots array<int>, list bigint, block int, first int, second int"), "partners")
    with_vectors = partners.join(nodes.select("node", "v", "copies"), "node")
    return stored(dealt(with_vectors).mapInArrow(
        _verifier(held, width, least), "node bigint, links bigint, other bigint"), "vector-links")


def _describer(pivots: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = min(NEAREST, len(pivots))
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                nearness = directions(part.column("v"), width) @ pivots.T
                # By nearness, equal ones by number.
                nearest = np.argsort(-nearness, axis=1, kind="stable")[:, :held].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(list(nearest), pa.list_(pa.int32()))], ["node", "pivots"])

    return run


def _units(batches: Iterator[pa.RecordBatch], limit: int = UNIT_ROWS) -> Iterator[pa.Table]:
    """The rows in tables of whole units, about ``limit`` rows each; units are consecutive rows."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if sum(x.num_rows for x in waiting) >= limit:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            edge = int(_edges(rows)[-1])  # the last unit may go on
            if edge:
                yield rows.slice(0, edge)
            waiting = rows.slice(edge).combine_chunks().to_batches()
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _edges(rows: pa.Table) -> np.ndarray:
    """Places where units begin."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for name in ("list", "first", "second"):
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _pairs(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of each unit, some of them at a time: of a unit of two blocks those between the blocks."""
    begin = _edges(rows)
    sizes = np.diff(begin, append=rows.num_rows)
    unit_end = np.repeat(begin + sizes, sizes)
    partners = unit_end - np.arange(rows.num_rows) - 1  # rows after each row in its unit
    total = np.cumsum(partners)
    block, first, second = (rows.column(name).to_numpy() for name in ("block", "first", "second"))
    at = 0
    while at < rows.num_rows:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        count = partners[at:end]
        left = np.repeat(np.arange(at, end), count)
        right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + left + 1
        wanted = (first[left] == second[left]) | (block[left] != block[right])
        if wanted.any():
            yield left[wanted], right[wanted]
        at = end


def _is_home(pivots: np.ndarray, lists: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the list in which a pair meets is that of the two smallest pivots it shares."""
    second = lists[left] % MOST
    own = pivots[left]
    shared = (own[:, :, None] == pivots[right][:, None, :]).any(axis=2)
    return (shared & (own < second[:, None])).sum(axis=1) == 1


def _pivot_rows(rows: pa.Table, held: int) -> np.ndarray:
    return rows.column("pivots").combine_chunks().flatten().to_numpy().reshape(-1, held)


def _partner_finder(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            pivots, lists = _pivot_rows(rows, held), rows.column("list").to_numpy()
            has = np.zeros(rows.num_rows, bool)
            for left, right in _pairs(rows):
                home = _is_home(pivots, lists, left, right) if held > 1 else slice(None)
                has[left[home]] = has[right[home]] = True
            yield from rows.filter(pa.array(has)).select(
                ["node", "pivots", "list", "block", "first", "second"]).combine_chunks().to_batches()

    return run


def _verifier(held: int, width: int, least: float):
    step = max(1, (1 << 22) // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches, min(UNIT_ROWS, step)):
            pivots, lists = _pivot_rows(rows, held), rows.column("list").to_numpy()
            nodes, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
            unit = directions(rows.column("v").combine_chunks(), width)
            links, reach = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
            for left, right in _pairs(rows):
                for first in range(0, len(left), step):
                    a, b = left[first:first + step], right[first:first + step]
                    near = np.einsum("ij,ij->i", unit[a], unit[b]) >= least
                    a, b = a[near], b[near]
                    if held > 1:
                        home = _is_home(pivots, lists, a, b)
                        a, b = a[home], b[home]
                    np.add.at(links, a, copies[b])
                    np.add.at(links, b, copies[a])
                    reach = _joined(reach, a, b)
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[found]), pa.array(links[found]), pa.array(nodes[reach[found]])], ["node", "links", "other"])

    return run


def _joined(reach: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``reach`` names a place of the same connected part for every place; now with further links."""
    while len(left):
        low, high = np.minimum(reach[left], reach[right]), np.maximum(reach[left], reach[right])
        apart = low != high
        if not apart.any():
            break
        left, right = left[apart], right[apart]
        np.minimum.at(reach, high[apart], low[apart])
        while (reach[reach] != reach).any():
            reach = reach[reach]
    return reach
