"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation over postings.

Vectors are quantised to integers, component by component; a component that becomes 0 is no term of its vector. A task
turns the vectors of a batch into postings, per dimension the vectors that have it with their weights. Each query, a
sparse row of terms, adds the weighted postings of its terms into a dense array of scores, of which the k best are
selected. The best of all batches are merged per query by rank.

Queries are dealt to blocks of about ``BLOCK`` rows and vectors to parts of about ``PART``. Every block meets every part in
one shuffle: a vector is sent once per block and a query once per part, so a task holds one block and one part, however
large the table. Parts are dealt by place and stored, so neither equal rows nor equal ids gather in one. Nothing but
counts reaches the driver.

Vectors that are null or hold nulls, NaN or infinities take no part, nor do null ids. Vectors may differ in length:
missing components are 0. Ties go to the smaller id. Rows that repeat an id are separate candidates, but no row of the
query's own id is one of its own; of repeated query rows the best per row are found once for each distinct vector and
reported by rank over all. Empty tables give no rows. Columns beside the named ones are not read, whatever their names.
Components beyond 64 bits are cut to their range; where a score could leave it, scores are summed as whole numbers of any
size and cut then, so they never wrap around. Long vectors need no more than their own length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.components import stored

BLOCK = 4096
PART = 8192
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(vector: Column, scale: int) -> Column:
    """Components as floor(scale * x), null unless all are finite numbers."""
    values = vector.cast("array<double>")
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return F.when(usable, F.transform(values, lambda x: F.floor(F.lit(float(scale)) * x)))


def top_k(vectors: DataFrame, id_column: str, vector: str, is_query: Column, k: int, scale: int = 256,
          block: int = BLOCK, part: int = PART) -> DataFrame:
    """Columns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` for each row of ``vectors`` that ``is_query``
    selects."""
    usable = vectors.select(
        F.col(id_column).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"), is_query.alias("query"),
    ).where("id IS NOT NULL AND v IS NOT NULL")
    usable = stored(usable.withColumn("place", F.monotonically_increasing_id()), "topk-vectors")
    queries = stored(usable.where("query").select("id", "v").distinct(), "topk-queries")
    parts, blocks = (max(1, math.ceil(rows.count() / size)) for rows, size in ((usable, part), (queries, block)))
    candidates = usable.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod("place", F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "id", "v")
    asked = queries.select(
        F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"), "id", "v")
    met = candidates.union(asked).repartition(blocks * parts, F.col("block") * parts + F.col("part"))
    met = met.sortWithinPartitions("block", "part", "kind", "id")  # equal scores are then met in the order of ids
    found = met.mapInArrow(_matcher(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matcher(k: int):
    """The best of each part for the queries of each block; the part comes first, then the queries, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ids, postings = None, [], None, {}
        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy() for name in ("block", "part", "kind")])
            edges = np.flatnonzero(np.any(np.diff(keys, axis=1, prepend=keys[:, :1] - 1) != 0, axis=0))
            for at, end in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows], strict=True):
                rows = batch.slice(at, end - at)
                if (pair := tuple(keys[:2, at].tolist())) != now:
                    now, held, ids, postings = pair, [], None, {}
                if keys[2, at] == 0:
                    held.append(rows)
                    continue
                if ids is None:
                    every = pa.Table.from_batches(held).combine_chunks()
                    held, ids = [], every.column("id").to_numpy()
                    postings = _postings(every.column("v").combine_chunks())
                found = _best(_sparse(rows), ids, postings, k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

    return run


def _sparse(rows: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its id, its dimensions and their weights."""
    values = rows.column("v")
    weights, lengths = values.flatten().to_numpy(), values.value_lengths().to_numpy()
    ends = np.cumsum(lengths)
    for key, start, end in zip(rows.column("id").to_pylist(), (ends - lengths).tolist(), ends.tolist(), strict=True):
        own = weights[start:end]
        dimensions = np.flatnonzero(own)
        yield key, dimensions, own[dimensions]


def _postings(vectors: pa.ListArray) -> dict[int, tuple[np.ndarray | slice, np.ndarray]]:
    """Per dimension the places of the vectors that have it and their weights."""
    lengths = vectors.value_lengths().to_numpy()
    weights = vectors.flatten().to_numpy()
    owner = np.repeat(np.arange(len(lengths)), lengths)
    dimension = np.arange(len(weights)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    present = np.flatnonzero(weights)
    present = present[np.argsort(dimension[present], kind="stable")]
    edges = np.flatnonzero(np.diff(dimension[present], prepend=-1))
    out = {}
    for at, end in zip(edges.tolist(), [*edges[1:].tolist(), len(present)], strict=True):
        rows = present[at:end]
        whole = len(rows) == len(lengths)
        out[int(dimension[rows[0]])] = (slice(None) if whole else owner[rows], weights[rows])
    return out


def _scores(count: int, dimensions: np.ndarray, weights: np.ndarray, postings, largest: float) -> np.ndarray:
    """Inner products of a query with the vectors of a part."""
    wide = float(np.abs(weights.astype(float)).sum()) * largest >= float(MOST) / 2
    scores = np.zeros(count, object if wide else np.int64)
    for dimension, weight in zip(dimensions.tolist(), weights.tolist(), strict=True):
        if (posting := postings.get(dimension)) is not None:
            scores[posting[0]] += weight * (posting[1].astype(object) if wide else posting[1])
    return np.array([min(max(x, LEAST), MOST) for x in scores], np.int64) if wide else scores


def _best(queries, ids, postings, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out = [[], [], []]
    largest = max((float(np.abs(weights.astype(float)).max()) for _, weights in postings.values()), default=0.0)
    for key, dimensions, weights in queries:
        scores = _scores(len(ids), dimensions, weights, postings, largest)
        others = np.flatnonzero(ids != key)
        if len(others) > k:
            own = scores[others]
            least = np.partition(own, len(own) - k)[len(own) - k]
            above, equal = others[own > least], others[own == least]
            others = np.concatenate((above, equal[:k - len(above)]))
        out[0].append(np.full(len(others), key, np.int64))
        out[1].append(ids[others])
        out[2].append(scores[others])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
