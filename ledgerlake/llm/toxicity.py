"""Toxicity scores: logistic regression by FTRL-proximal over hashed words, their beginnings, pairs and skip pairs;
words are bare of punctuation.

Training. A feature is present or absent in a text. Each coordinate has its own learning rate, from the sum of its
squared gradients, and an L1 penalty that leaves most weights at 0. Rounds of training start from one state; in each, a
task updates it over its own part of the sample in some passes, text by text, and Spark averages the states by coordinate. The weights
that are not 0, at most 2**BITS of them, are what scoring sends to tasks.

The sample of labelled texts is bounded: about ``sample`` distinct ones, chosen by a hash of the text, or all if there are
no more. Equal texts with equal labels are one example, however many rows they have, which weighs 1 + ln(rows): so neither
the sample nor what it learns is taken over by copies. It is stored once for all rounds. Scoring covers every text, whole.

Null and empty texts have no features; their score is the rate of the intercept. Rows without label, and labels without
row, train nothing; repeated rows each get their score, and equal texts have equal ones. Very long texts are scored whole. Without
any labelled text, as of empty tables, all scores are 0.5. Columns beside the named ones are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import features, tokens
from ledgerlake.llm.components import stored

BITS = 19
TEMPLATES = ((0,), (0, 1), (0, 2))
BEGINNINGS = (5, 7)  # bytes
SAMPLE = 24_000
SHARDS = 4
ROUNDS = 2
PASSES = 2  # over its part, by a task in a round
ALPHA, BETA, L1, L2 = 0.3, 1.0, 2.0, 0.5
INTERCEPT = 1 << BITS


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights of a state; 0 where the L1 penalty outweighs the gradients."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def train(labelled: DataFrame, text: str, label: str, sample: int = SAMPLE, key: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights that are not 0, from rows of text and a label of 0 or 1. ``key`` names a column that holds
    ``text_key`` of the text; computed before the join that brings the labels, it keeps texts out of the sample there."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col(label).isNotNull()).select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(label).cast("double").alias("label"),
        (F.col(key) if key else text_key(text)).alias("key"))
    shards = sampled(rows, sample).repartition(SHARDS, F.xxhash64("text", F.lit(1))).sortWithinPartitions(F.xxhash64("text", F.lit(2)), "text", "label")
    state = np.zeros((2, INTERCEPT + 1))
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(state)
        merged = shards.mapInArrow(_trainer(sent), "place int, z float, n float").groupBy("place").agg(
            F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow()
        state = state.copy()
        places = merged.column("place").to_numpy()
        state[0, places] += merged.column("z").to_numpy() / SHARDS
        state[1, places] += merged.column("n").to_numpy() / SHARDS
    weights = weights_of(*state)
    weights[INTERCEPT] = -state[0, INTERCEPT] / ((BETA + np.sqrt(state[1, INTERCEPT])) / ALPHA)
    kept = np.flatnonzero(weights)
    return kept, weights[kept]


def sampled(rows: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` distinct texts with label and weight, stored, from rows of text, label and key. Copies become one row
    before they are shuffled."""
    distinct = rows.agg(F.approx_count_distinct("key")).first()[0]
    chance = F.pmod("key", F.lit(1 << 20)) / float(1 << 20)
    once = rows.where(chance < sample / max(distinct, 1)).groupBy("key", "label").agg(F.min("text").alias("text"), F.count("*").alias("rows"))
    return stored(once.select("text", "label", (1 + F.log("rows")).alias("weight")), "toxicity-sample")


def _trainer(sent):
    """Changes of the state over one shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = sent.value[0].copy(), sent.value[1].copy()
        examples = []  # the sample is bounded, so is a part of it
        for batch in tokens.pieces(batches):
            found = tokens.words(batch.column("text"), tokens.PUNCTUATION)
            places, owners = features.distinct(*features.hashed(found, TEMPLATES, BITS, BEGINNINGS), BITS)
            parts = np.split(places.astype(np.int32), np.searchsorted(owners, np.arange(1, batch.num_rows)))
            examples += zip(parts, batch.column("label").to_pylist(), batch.column("weight").to_pylist(), strict=True)
        for at, label, weight in examples * PASSES:
            zi, ni = z[at], n[at]
            w = weights_of(zi, ni)
            w0 = -z[INTERCEPT] / ((BETA + np.sqrt(n[INTERCEPT])) / ALPHA)
            error = weight * (features.sigmoid(w.sum() + w0) - label)
            square = error * error
            z[at] = zi + error - (np.sqrt(ni + square) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + square
            z[INTERCEPT] += error - (np.sqrt(n[INTERCEPT] + square) - np.sqrt(n[INTERCEPT])) / ALPHA * w0
            n[INTERCEPT] += square
        if examples:
            z -= sent.value[0]
            n -= sent.value[1]
            places = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([
                pa.array(places.astype(np.int32)), pa.array(z[places].astype(np.float32)),
                pa.array(n[places].astype(np.float32))], ["place", "z", "n"])

    return run


def score(docs: DataFrame, id_column: str, text: str, weights: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``id_column`` and ``score``, the probability of label 1, for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.select(F.col(id_column), F.col(text).cast("string").alias("_text"))
    kind = kept.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(INTERCEPT + 1)
        table[sent.value[0]] = sent.value[1]
        for batch in tokens.pieces(batches, "_text"):
            places, owners = features.hashed(tokens.words(batch.column("_text"), tokens.PUNCTUATION), TEMPLATES, BITS, BEGINNINGS)
            used = table[places] != 0
            places, owners = features.distinct(places[used], owners[used], BITS)
            total = features.sums(table[places], owners, batch.num_rows) + table[INTERCEPT]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(features.sigmoid(total))], [id_column, "score"])

    return kept.mapInArrow(run, f"`{id_column}` {kind}, score double")
