"""Connected components of a table of links, by alternating large and small stars.

Each step points every node, or every larger neighbour of a node, at the smallest node it knows of; the number of steps
grows with the logarithm of the longest path. Minima are aggregated before the shuffle and stored, so the joins that
follow read both sides from shuffles and split a node that has very many links. It ends when all links are stars; nothing
is collected but whether they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import new_folder

FEW = 500_000  # rows of a few numbers that are little work for as many tasks as cores
FEWEST_TASKS = 8


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again, which cuts their lineage."""
    folder = new_folder(rows.sparkSession, label)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def small(table: DataFrame, rows: int = FEW) -> DataFrame:
    """A stored table of a few numbers per row, marked for broadcast if it has at most that many rows."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def in_few_tasks(rows: DataFrame, most: int) -> DataFrame:
    """Grouped or distinct rows, of which there are at most ``most``: as many tasks as cores take them if they are few, since
    starting a task and writing its file takes longer than some hundred rows do."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, FEWEST_TASKS)) if most <= FEW else rows


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component``, the smallest node that links reach, for each node that a
    link ties to another one.

    ``links`` has two columns of one integer type, in any order and with repetitions."""
    first, second = links.columns
    ends = F.least(first, second), F.greatest(first, second)
    now = links.where(F.col(first) != F.col(second)).select(ends[1].alias("node"), ends[0].alias("to")).distinct()
    now = stored(now, "links")
    while not _are_stars(now, count := now.count()):
        both = now.union(now.select("to", "node"))
        least = both.groupBy("node").agg(F.min("to").alias("low")).select("node", F.least("node", "low").alias("low"))
        large = both.join(stored(in_few_tasks(least, count), "least"), "node").where("to > node").select(
            F.col("to").alias("node"), F.col("low").alias("to"))
        large = stored(in_few_tasks(large.distinct(), count), "large-star")
        least = stored(in_few_tasks(large.groupBy("node").agg(F.min("to").alias("low")), count), "least")
        small = large.join(least, "node").where("to <> low").select(F.col("to").alias("node"), F.col("low").alias("to"))
        now = stored(in_few_tasks(small.union(least).distinct(), count), "small-star")
    named = now.select("node", F.col("to").alias("component"))
    return named.union(now.select("to", "to").distinct())


def _are_stars(links: DataFrame, count: int) -> bool:
    """Whether every node points at one other, which points at none. Nodes point at smaller ones, so the one that a star's
    nodes point at is then the smallest of all that are connected with it."""
    ends = links.select("node", F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        links.select("to", F.lit(0), F.lit(1)))
    counts = in_few_tasks(ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("into").alias("into")), count)
    return counts.agg(F.count_if(F.expr("out > 1 OR (out = 1 AND into > 0)"))).first()[0] == 0
