"""Quality scores from weak labels.

Heuristic labellers look at measures of a text and vote good, bad or not at all. Every text of the corpus is
voted on; the counts of vote patterns, of which there are 3**len(LABELLERS) at most, are all that the driver gets.
Expectation-maximisation over these counts estimates how accurate the votes of each labeller are and how many texts are
good, and with that the posterior of each pattern.

The posteriors are the labels of a logistic regression over hashed features of word shapes, endings and words: a text
that shows what bad texts have in common is found even where the heuristics abstain. It is trained on a bounded sample,
about ``sample`` texts chosen by a hash of the text, in rounds: each task takes gradient steps over its part, and Spark
averages the weights by coordinate. Scoring covers every text, whole.

Null texts are empty. A text of few words gets no votes; one without words has no features, so its score is that of the intercept,
which is more than a half where most texts are good. Equal texts score alike. An empty table trains nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlake.llm import features, tokens

BITS = 16
SAMPLE = 16_000
SHARDS = 4
ROUNDS = 2
STEPS = 3
RATE = 0.5
FEW = 24  # shares in texts of fewer words are of so many, for single words prove little
INTERCEPT = 1 << BITS
GOOD, BAD, NONE = 1, 0, 2

# Fault finders: the measure, its highest value in clean prose and the lowest that is a vote for bad. They vote on
# nothing else, for a text without one fault may have another.
FAULTS = (
    ("symbols", 0.06, 0.10),        # share of bytes that are ASCII symbols
    ("capitals", 0.15, 0.40),       # capitals among ASCII letters
    ("repeated", 0.05, 0.15),       # words equal to the one before
    ("marked", 0.25, 0.40),         # words that end in a symbol
    ("separators", 0.02, 0.10),     # words without letter or digit
    ("digits", 0.10, 0.30),         # share of bytes that are digits
    ("long", 0.02, 0.15),           # words of more than 30 bytes
)
# Two-sided labellers, which overlap with all fault finders and with each other.
LABELLERS = (*(name for name, _, _ in FAULTS), "prose", "varied", "short_words")

_BYTES = np.arange(256)
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _CAPITAL | ((_BYTES >= 97) & (_BYTES <= 122))
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SYMBOL = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT
_KIND = np.select([_CAPITAL, _LETTER, _DIGIT, _SYMBOL, _BYTES >= 128], [1, 2, 3, 4, 5], 0).astype(np.uint64)


def measures(texts: pa.Array, found: tokens.Words) -> np.ndarray:
    """The measures of the fault finders, the share of word pairs that are distinct and that of short words."""
    raw, offsets = tokens.text_bytes(texts, lower=False)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[offsets[1:]] - total[offsets[:-1]]

    def per_words(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (total[found.starts[1:]] - total[found.starts[:-1]]) / np.maximum(found.lengths, 1)

    size, letters = np.maximum(np.diff(offsets), 1), np.maximum(per_text(_LETTER[raw]), 1)
    plain = np.concatenate(([0], np.cumsum(~_SYMBOL[raw], dtype=np.int64)))
    length = found.end - found.begin
    pairs = tokens.gram(found.hashes, (0, 1))
    varied = [len(np.unique(pairs[a:max(a, b - 1)])) / max(b - 1 - a, 1)
              for a, b in zip(found.starts[:-1].tolist(), found.starts[1:].tolist(), strict=True)]
    return np.stack([
        per_text(_SYMBOL[raw]) / size, per_text(_CAPITAL[raw]) / letters, per_words(_same(found)),
        per_words(_SYMBOL[raw[found.end - 1]]), per_words(plain[found.end] == plain[found.begin]),
        per_text(_DIGIT[raw]) / size, per_words(length > 30), np.array(varied), per_words(length <= 4),
    ], axis=1)


def _same(found: tokens.Words) -> np.ndarray:
    """Whether each word equals the one before it in its text."""
    same = np.zeros(len(found.hashes), bool)
    same[1:] = found.hashes[1:] == found.hashes[:-1]
    firsts = found.starts[:-1][found.lengths > 0]
    same[firsts] = False
    return same


def votes(texts: pa.Array, found: tokens.Words) -> np.ndarray:
    """A row per text, a column per labeller."""
    values = measures(texts, found)
    clean, bad = (np.array([fault[side] for fault in FAULTS]) for side in (1, 2))
    faults = values[:, :len(FAULTS)] >= bad
    prose = np.where(faults.any(1), BAD, np.where((values[:, :len(FAULTS)] <= clean).all(1), GOOD, NONE))
    varied, short = values[:, -2], values[:, -1]
    cast = np.column_stack([
        np.where(faults, BAD, NONE), prose,
        np.where(varied >= 0.7, GOOD, np.where(varied < 0.4, BAD, NONE)),
        np.where(short >= 0.3, GOOD, np.where(short < 0.2, BAD, NONE)),
    ])
    cast[found.lengths < 8] = NONE  # shares of so few words say nothing
    return cast


def pattern_of(cast: np.ndarray) -> np.ndarray:
    return cast @ 3 ** np.arange(len(LABELLERS))


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of good per pattern, and per labeller the probability that a vote of it is right."""
    cast = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    accuracy, prior = np.full(len(LABELLERS), 0.8), 0.7
    for _ in range(steps):
        odds = np.log(accuracy / (1 - accuracy))
        margin = ((cast == GOOD) * odds).sum(1) - ((cast == BAD) * odds).sum(1)
        posterior = features.sigmoid(margin + np.log(prior / (1 - prior)))
        right = np.where(cast == GOOD, posterior[:, None], np.where(cast == BAD, 1 - posterior[:, None], 0))
        voted = ((cast != NONE) * counts[:, None]).sum(0)
        accuracy = np.clip(((right * counts[:, None]).sum(0) + 8) / (voted + 10), 0.05, 0.99)
        prior = ((posterior * counts).sum() + 7) / (counts.sum() + 10)
    return posterior, accuracy


def _features(texts: pa.Array, found: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, texts and values: the share of a text's words that have a shape, an ending or a hash."""
    raw, _ = tokens.text_bytes(texts, lower=False)
    owner = np.repeat(np.arange(len(found.lengths)), found.lengths)
    size = found.end - found.begin
    kinds = _KIND[raw]
    shape = kinds[found.begin] * 6 + kinds[found.end - 1] if len(raw) else np.zeros(0, np.uint64)
    shape = (shape * 8 + np.minimum(size // 2, 7).astype(np.uint64)) * 2 + _same(found)
    ending = np.zeros(len(size), np.uint64)
    for step in (1, 2, 3):
        at = found.end - step
        ending = ending * 256 + np.where(at >= found.begin, raw[at] if len(raw) else 0, 0).astype(np.uint64)
    keys = np.concatenate((tokens.mix(shape + np.uint64(1 << 40)), tokens.mix(ending + np.uint64(1 << 41)), found.hashes))
    places = (keys >> np.uint64(64 - BITS)).astype(np.int64)
    both, counts = np.unique((np.tile(owner, 3) << BITS) | places, return_counts=True)
    text = both >> BITS
    return both & (INTERCEPT - 1), text, np.sqrt(counts / np.maximum(found.lengths, FEW)[text])


def train(docs: DataFrame, text: str, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the scorer; the last is the intercept."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text).cast("string").alias("text"))
    seen = rows.mapInArrow(tokens.trimmed(_patterns), "pattern long, count long").groupBy("pattern").agg(
        F.sum("count").alias("count")).toArrow()
    weights = np.zeros(INTERCEPT + 1)
    if not seen.num_rows:
        return weights
    patterns, counts = seen.column("pattern").to_numpy(), seen.column("count").to_numpy().astype(float)
    posterior, _ = estimate(patterns, counts)
    known = dict(zip(patterns.tolist(), posterior.tolist(), strict=True))
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.where("text IS NOT NULL").where(chance < sample / max(counts.sum(), 1))
    shards = chosen.repartition(SHARDS, F.xxhash64("text", F.lit(1))).sortWithinPartitions(F.xxhash64("text", F.lit(2)), "text")
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((weights, known))
        merged = shards.mapInArrow(tokens.trimmed(_trainer(sent)), "place long, change double").groupBy("place").agg(
            F.sum("change").alias("change")).toArrow()
        weights = weights.copy()
        weights[merged.column("place").to_numpy()] += merged.column("change").to_numpy() / SHARDS
    return weights


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(3 ** len(LABELLERS), np.int64)
    for batch in tokens.pieces(batches):
        texts = batch.column("text")
        total += np.bincount(pattern_of(votes(texts, tokens.words(texts))), minlength=len(total))
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["pattern", "count"])


def _trainer(sent):
    """Changes of the weights by adaptive gradient steps over one shard, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, known = sent.value[0].copy(), sent.value[1]
        squares = np.full(len(weights), 1e-3)
        for batch in tokens.pieces(batches, limit=tokens.PIECE_BYTES // 4):
            texts = batch.column("text")
            found = tokens.words(texts)
            target = np.array([known.get(p, 0.5) for p in pattern_of(votes(texts, found)).tolist()])
            places, owners, values = _features(texts, found)
            for _ in range(STEPS):
                margin = features.sums(weights[places] * values, owners, batch.num_rows) + weights[INTERCEPT]
                error = (features.sigmoid(margin) - target) / batch.num_rows
                step = np.bincount(places, error[owners] * values, len(weights))
                step[INTERCEPT] = error.sum()
                squares += step * step
                weights -= RATE * step / np.sqrt(squares)
        change = weights - sent.value[0]
        places = np.flatnonzero(change)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(change[places])], ["place", "change"])

    return run


def score(docs: DataFrame, text: str, weights: np.ndarray, name: str = "quality_score") -> DataFrame:
    """The rows of ``docs`` with the probability that they are good in column ``name``, which is replaced if there."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    kept = docs.drop(name)
    names = [*kept.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in tokens.pieces(batches, text):
            texts = batch.column(text)
            places, owners, values = _features(texts, tokens.words(texts))
            margin = features.sums(table[places] * values, owners, batch.num_rows) + table[INTERCEPT]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(features.sigmoid(margin))], names)

    return kept.mapInArrow(tokens.trimmed(run), StructType([*kept.schema.fields, StructField(name, DoubleType())]))
