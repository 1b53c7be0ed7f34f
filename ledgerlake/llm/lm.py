"""Log probabilities of texts under a hashed maximum-entropy model with a class-factored softmax.

Tokens are hashed words and one end per text. A token's probability is that of its class in its context times that of
the token in its class. Classes are the most frequent words, each alone, the end, and groups of the other words by their
last two bytes, which also place unknown words. Classes are factored once more, into ``SIDE`` groups of ``SIDE`` classes: the
group and the class in its group each have a softmax over hashed features of the context, so a token pays for two short
ones. The features are the word before, the two before, the word before that (a skip), and the pair of the two and three
before (a skip pair); frequent words stand for themselves there, others for their ending. The words of a group class are factored again, into ``SIDE`` drawers by their
hash, by a softmax over features of the one and two words before, so context also decides within a class. Within a drawer
the maximum-entropy distribution under counts alone is the relative frequency, smoothed by half a count, with half a
count for words that training has not seen.

Training. Counts cover all training texts. Softmax weights start at 0 with the class frequencies as offsets; each task
takes adaptive gradient steps over its part of the training texts, batch by batch, and Spark averages the weights of
every feature over the tasks that met it, by how often they did.

Scoring. Counts per word do not fit into one task for a large corpus, so each block of texts gets the counts of its own
words: distinct words per block are counted, summed by word, and sent back to their blocks. A block is a run of texts
that one task reads, ``BLOCK_BYTES`` at most and one text; it is stored with the texts, so files of any size, equal texts
and frames that come out of shuffles make bounded blocks, and each pass sees the same ones.

Null texts are empty: one end. Texts of any length are scored whole. Rows without id train and are scored like others;
repeated rows count as often as they occur. Without training texts every token is unknown. Words are compared by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import tokens
from ledgerlake.llm.components import stored

SIDE = 10
ALONE = 63
ENDINGS = 30
OTHERS = 6
CLASSES = ALONE + 1 + ENDINGS + OTHERS  # SIDE * SIDE
FREQUENT = 1024
BUCKETS = 1 << 12
TEMPLATES = ((1,), (1, 2), (2,), (2, 3))
ROWS = len(TEMPLATES) * BUCKETS
DRAWN = 2  # templates that decide about drawers
# A row of features has SIDE weights for the groups, and then SIDE for the classes of each group. Behind them all, rows of
# the first templates have SIDE weights for the drawers of each group.
DRAWERS = ROWS * (SIDE + 1)
BLOCKS = DRAWERS + DRAWN * BUCKETS * SIDE
RANGES = 16
STEP_TOKENS = 1 << 14
RATE = 0.4
SHARDS = 4096
ROUNDS = 1
COUNTED = 1 << 22
BLOCK_BYTES = 1 << 26  # of text
ROW_BYTES = 32  # what a row counts for besides its text
END, START = np.uint64(0x1D0F_5EED_0000_0001), np.uint64(0x1D0F_5EED_0000_0002)
END_ENDING = -1


@dataclass
class Vocabulary:
    """What is known of all words together; its size does not grow with the corpus."""

    tokens: int
    distinct: int
    alone: np.ndarray      # hashes of the words with a class of their own, sorted
    endings: np.ndarray    # endings with a class of their own, sorted
    frequent: np.ndarray   # hashes of the words that are contexts by themselves, sorted
    shares: np.ndarray     # per class and drawer the smoothed count; a word alone and the end are in drawer 0

    @property
    def totals(self) -> np.ndarray:
        return self.shares.sum(axis=1)

    def drawers(self, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return np.where(classes > ALONE, (hashes % np.uint64(SIDE)).astype(np.int64), 0)

    def classes(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = ALONE + 1 + ENDINGS + (endings % OTHERS)
        place, known = _find(self.endings, endings)
        out = np.where(known, ALONE + 1 + place, out)
        place, known = _find(self.alone, hashes)
        out = np.where(known, place, out)
        return np.where(endings == END_ENDING, ALONE, out)

    def contexts(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        return np.where(_find(self.frequent, hashes)[1], hashes, tokens.mix(endings.astype(np.uint64)))


def _find(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted in sorted values, and whether they are there."""
    if not len(values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and endings of the tokens of all texts, and where each text starts."""
    found = tokens.words(texts)
    count = len(found.hashes)
    starts = found.starts + np.arange(len(found.starts))
    place = np.arange(count) + np.repeat(np.arange(len(found.lengths)), found.lengths)
    hashes, endings = np.full(starts[-1], END), np.full(starts[-1], END_ENDING, np.int64)
    hashes[place] = found.hashes
    if count:
        before = np.where(found.end - 2 >= found.begin, found.data[np.maximum(found.end - 2, 0)], 0).astype(np.int64)
        endings[place] = before * 256 + found.data[found.end - 1]
    return hashes, endings, starts


def score(docs: DataFrame, id_column: str, text: str, held_out: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score. Rows that ``held_out`` selects
    train nothing."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"), held_out.alias("held_out"))
    rows = in_blocks(rows, block_bytes)

    counted = rows.select("text", "held_out", "block").mapInArrow(_count, "block long, hash long, ending int, count long")
    summed = counted.repartition("hash").mapInArrow(
        _sum_up, "block long, hashes binary, counts binary, hash long, ending int, count long")
    summed = stored(summed, "lm-counts")
    known = summed.where("hash IS NOT NULL").select("hash", "ending", "count")
    vocabulary = _vocabulary(known)
    weights = _train(rows.where(~F.col("held_out")).select("text"), vocabulary)

    sent = rows.sparkSession.sparkContext.broadcast((vocabulary, weights))
    nothing = F.lit(None)
    entries = summed.where("block IS NOT NULL").select(
        "block", F.lit(0).alias("kind"), nothing.cast(rows.schema["doc_id"].dataType).alias("doc_id"),
        nothing.cast("boolean").alias("held_out"), nothing.cast("string").alias("text"), "hashes", "counts")
    texts = rows.select("block", F.lit(1).alias("kind"), "doc_id", "held_out", "text",
                        nothing.cast("binary").alias("hashes"), nothing.cast("binary").alias("counts"))
    blocks = entries.select("block").distinct().count()
    tasks = max(blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = entries.union(texts).repartition(tasks, "block").sortWithinPartitions("block", "kind")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(_scorer(sent), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
                                          "train_tokens long, base_score double, score double")


# --- blocks ---


def in_blocks(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, stored, with the block of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(sizes + ROW_BYTES)
            starts = np.concatenate(([before], ends[:-1]))[:len(ends)]
            task = batch.column("block").to_numpy()
            yield batch.set_column(batch.num_columns - 1, "block", pa.array((task << 32) + starts // block_bytes))
            before = int(ends[-1]) if len(ends) else before

    numbered = rows.withColumn("block", F.spark_partition_id().cast("long"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(numbered.mapInArrow(run, f"doc_id {kind}, text string, held_out boolean, block long"), "lm-texts")


# --- counts ---


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct tokens per block with their counts in training texts, which may be 0."""
    held: dict[int, list] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for block, parts in held.items():
            hashes, endings, times = (np.concatenate(x) for x in zip(*parts, strict=True))
            distinct, first, places = np.unique(hashes, return_index=True, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(distinct), block, np.int64)), pa.array(distinct.view(np.int64)),
                pa.array(endings[first].astype(np.int32)),
                pa.array(np.bincount(places, times, len(distinct)).astype(np.int64))], ["block", "hash", "ending", "count"])

    for batch in tokens.pieces(batches):
        hashes, endings, starts = tokens_of(batch.column("text"))
        train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        times = np.repeat(train, np.diff(starts)).astype(np.float64)
        blocks = batch.column("block").to_numpy()
        for block in np.unique(blocks).tolist():
            own = np.repeat(blocks == block, np.diff(starts))
            held.setdefault(block, []).append((hashes[own], endings[own], times[own]))
        size += len(hashes)
        if size > COUNTED:
            yield from flush()
            held, size = {}, 0
    yield from flush()


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words that training has, and per block one row with the total counts of all its words."""
    names = ["block", "hashes", "counts", "hash", "ending", "count"]
    held = list(batches)  # a shuffle partition; a word has a row per block and task at most
    if not sum(batch.num_rows for batch in held):
        return
    table = pa.Table.from_batches(held)
    block, hashes, endings, count = (table.column(i).to_numpy() for i in range(4))
    distinct, first, places = np.unique(hashes, return_index=True, return_inverse=True)
    total = np.bincount(places, count, len(distinct)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    edges = np.flatnonzero(np.diff(block[order], prepend=block[order[0]] - 1))
    for at, end in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
        own = np.unique(places[order[at:end]])
        yield pa.RecordBatch.from_arrays([
            pa.array([block[order[at]]], pa.int64()), pa.array([distinct[own].tobytes()], pa.binary()),
            pa.array([total[own].tobytes()], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()),
            pa.nulls(1, pa.int64())], names)
    seen = np.flatnonzero(total)
    for at in range(0, len(seen), 50_000):
        part = seen[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.binary()), pa.nulls(len(part), pa.binary()),
            pa.array(distinct[part]), pa.array(endings[first[part]].astype(np.int32)), pa.array(total[part])], names)


def _vocabulary(known: DataFrame) -> Vocabulary:
    sums = known.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    words = known.where(F.col("ending") != END_ENDING)
    most = words.orderBy(F.desc("count"), "hash").limit(FREQUENT).select("hash", "count").toArrow()
    most = most.column("hash").to_numpy().view(np.uint64)
    alone = np.sort(most[:ALONE])
    grouped = words.where(~F.col("hash").isin(alone.view(np.int64).tolist())) if len(alone) else words
    top = grouped.groupBy("ending").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "ending").limit(ENDINGS)
    endings = np.sort(np.array([row.ending for row in top.collect()], np.int64))
    out = Vocabulary(sums[0], sums[1], alone, endings, np.sort(most), np.zeros((CLASSES, SIDE)))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            classes = out.classes(hashes, batch.column("ending").to_numpy().astype(np.int64))
            places = classes * SIDE + out.drawers(hashes, classes)
            counts = np.bincount(places, batch.column("count").to_numpy() + 0.5, CLASSES * SIDE)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES * SIDE)), pa.array(counts)], ["place", "count"])

    found = known.mapInArrow(total, "place long, count double").groupBy("place").agg(F.sum("count").alias("count")).toArrow()
    shares = np.zeros(CLASSES * SIDE)
    shares[found.column("place").to_numpy()] = found.column("count").to_numpy()
    shares = shares.reshape(CLASSES, SIDE)
    shares[ALONE + 1:] += 0.5
    shares[:ALONE + 1, 0] = np.maximum(shares[:ALONE + 1, 0], 0.5)
    out.shares = shares
    return out


# --- the softmaxes over groups, classes and drawers ---


def rows_of(contexts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of the weights for each token: templates x tokens."""
    lengths = np.diff(starts)
    inside = np.arange(len(contexts)) - np.repeat(starts[:-1], lengths)
    before = []
    for distance in range(1, 4):
        shifted = np.concatenate((np.full(min(distance, len(contexts)), START), contexts[:-distance]))[:len(contexts)]
        before.append(np.where(inside >= distance, shifted, START))
    out = np.empty((len(TEMPLATES), len(contexts)), np.int64)
    for number, template in enumerate(TEMPLATES):
        value = np.full(len(contexts), number + 1, np.uint64)
        for distance in template:
            value = tokens.mix(value * np.uint64(0x9E3779B97F4A7C15) + before[distance - 1])
        out[number] = (value >> np.uint64(52)).astype(np.int64) + number * BUCKETS
    return out


def log_softmax(weights: np.ndarray, blocks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities: tokens x SIDE. ``blocks`` has the blocks of weights: templates x tokens."""
    margin = weights[blocks[0]]
    for block in blocks[1:]:
        margin += weights[block]
    margin += offsets
    margin -= margin.max(axis=1, keepdims=True)
    return margin - np.log(np.exp(margin).sum(axis=1, keepdims=True))


def factors(weights: np.ndarray, offsets: tuple[np.ndarray, np.ndarray], rows: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the group probabilities, and of those of the classes in the given group of each token."""
    blocks = rows * (SIDE + 1)
    return log_softmax(weights, blocks, offsets[0]), log_softmax(weights, blocks + 1 + groups, offsets[1][groups])


def drawer_logs(weights: np.ndarray, offsets: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities of the drawers in the given group class of each token."""
    return log_softmax(weights, DRAWERS + rows[:DRAWN] * SIDE + classes // SIDE, offsets[classes])


def offsets_of(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frequencies: of the groups, of the classes in each group, and of the drawers in each class (0 where it has none)."""
    totals = vocabulary.totals.reshape(SIDE, SIDE)
    groups = totals.sum(axis=1)
    drawers = np.zeros((CLASSES, SIDE))
    drawers[ALONE + 1:] = np.log(vocabulary.shares[ALONE + 1:] / vocabulary.totals[ALONE + 1:, None])
    return (np.log(groups / groups.sum()).astype(np.float32), np.log(totals / groups[:, None]).astype(np.float32),
            drawers.astype(np.float32))


def order_of(blocks: np.ndarray) -> np.ndarray:
    """The order that sorts the blocks of a step, equal ones as they come: sorted whole numbers beat a stable argsort."""
    keys = blocks * STEP_TOKENS + np.arange(len(blocks))
    keys.sort()
    return keys % STEP_TOKENS


def _train(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    spark = texts.sparkSession
    weights = np.zeros((BLOCKS, SIDE), np.float32)
    shards = texts.coalesce(SHARDS)
    for _ in range(ROUNDS if vocabulary.tokens else 0):
        sent = spark.sparkContext.broadcast((vocabulary, weights))
        parts = shards.mapInArrow(_trainer(sent), "part int, sums binary, times binary")
        merged = parts.repartition("part").mapInArrow(_average, "part int, sums binary, times binary").toArrow()
        for part, change in zip(merged.column("part").to_pylist(), merged.column("sums").to_pylist(), strict=True):
            weights[part * (BLOCKS // RANGES):(part + 1) * (BLOCKS // RANGES)] += np.frombuffer(change, np.float32).reshape(-1, SIDE)
    return weights


def _trainer(sent):
    """Changes of the weights over one part of the texts, times how often each block was met, by ranges of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = sent.value
        offsets = offsets_of(vocabulary)
        weights, squares = start.copy(), np.full(start.shape, 1e-2, np.float32)
        times = np.zeros(BLOCKS, np.float32)

        def move(order: np.ndarray, blocks: np.ndarray, error: np.ndarray) -> None:
            """One adaptive step along the error of the tokens in ``order``, which sorts ``blocks``."""
            if not len(blocks):
                return
            edges = np.flatnonzero(np.diff(blocks, prepend=-1))
            met = blocks[edges]
            gradient = np.add.reduceat(error[order], edges, axis=0)
            squares[met] += gradient * gradient
            weights[met] -= RATE * gradient / np.sqrt(squares[met])
            times[met] += np.diff(np.append(edges, len(blocks)))

        for batch in tokens.pieces(batches):
            hashes, endings, starts = tokens_of(batch.column("text"))
            classes = vocabulary.classes(hashes, endings)
            drawers = vocabulary.drawers(hashes, classes)
            rows = rows_of(vocabulary.contexts(hashes, endings), starts)
            for at in range(0, len(hashes), STEP_TOKENS):
                part, own = rows[:, at:at + STEP_TOKENS], classes[at:at + STEP_TOKENS]
                group, inside = np.divmod(own, SIDE)
                errors = [np.exp(logs) for logs in factors(weights, offsets, part, group)]
                every = np.arange(len(group))
                errors[0][every, group] -= 1
                errors[1][every, inside] -= 1
                for row in part:
                    first = row * (SIDE + 1)
                    order = order_of(first + 1 + group)  # sorts both kinds of blocks
                    move(order, first[order], errors[0])
                    move(order, (first + 1 + group)[order], errors[1])
                grouped = np.flatnonzero(own > ALONE)
                part, own = part[:DRAWN, grouped], own[grouped]
                error = np.exp(drawer_logs(weights, offsets[2], part, own))
                error[np.arange(len(own)), drawers[at + grouped]] -= 1
                for row in part:
                    blocks = DRAWERS + row * SIDE + own // SIDE
                    order = order_of(blocks)
                    move(order, blocks[order], error)
        if not times.any():
            return
        change = (weights - start) * times[:, None]
        size = BLOCKS // RANGES
        yield pa.RecordBatch.from_arrays([
            pa.array(range(RANGES), pa.int32()),
            pa.array([change[i * size:(i + 1) * size].tobytes() for i in range(RANGES)], pa.binary()),
            pa.array([times[i * size:(i + 1) * size].tobytes() for i in range(RANGES)], pa.binary())],
            ["part", "sums", "times"])

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for part, change, times in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            change, times = np.frombuffer(change, np.float32).reshape(-1, SIDE), np.frombuffer(times, np.float32)
            if part in found:
                found[part][0] += change
                found[part][1] += times
            else:
                found[part] = [change.astype(np.float64), times.astype(np.float64)]
    for part, (change, times) in found.items():
        mean = (change / np.maximum(times, 1)[:, None]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([mean.tobytes()], pa.binary()), pa.array([b""], pa.binary())],
            ["part", "sums", "times"])


# --- scores ---


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = sent.value
        offsets = offsets_of(vocabulary)
        base = np.log10(vocabulary.tokens + 0.5 * (vocabulary.distinct + 1))
        within = np.log10(np.maximum(vocabulary.shares, 0.5))
        now, hashes, counts, merged = None, [], [], True
        for batch in tokens.pieces(batches):
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.diff(blocks, prepend=blocks[0] - 1) | np.diff(kinds, prepend=kinds[0] - 1))
            for at, end in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows], strict=True):
                part = batch.slice(at, end - at)
                if blocks[at] != now:
                    now, hashes, counts, merged = blocks[at], [], [], False
                if kinds[at] == 0:
                    hashes += [np.frombuffer(x, np.uint64) for x in part.column("hashes").to_pylist()]
                    counts += [np.frombuffer(x, np.int64) for x in part.column("counts").to_pylist()]
                    continue
                if not merged:
                    every = np.concatenate(hashes)
                    order = np.argsort(every)
                    words, times, merged = every[order], np.concatenate(counts)[order], True
                    hashes, counts = [], []
                token, endings, starts = tokens_of(part.column("text"))
                met = np.searchsorted(words, token)
                if not np.array_equal(words[met], token):
                    raise ValueError("a block holds words that were not counted for it")
                count = times[met]
                own = np.log10(count + 0.5)
                classes = vocabulary.classes(token, endings)
                drawers = vocabulary.drawers(token, classes)
                rows = rows_of(vocabulary.contexts(token, endings), starts)
                logs = np.empty(len(token))
                for first in range(0, len(token), STEP_TOKENS):
                    share = slice(first, first + STEP_TOKENS)
                    group, inside = np.divmod(classes[share], SIDE)
                    of_group, of_class = factors(weights, offsets, rows[:, share], group)
                    every = np.arange(len(group))
                    logs[share] = of_group[every, group] + of_class[every, inside]
                    grouped = first + np.flatnonzero(classes[share] > ALONE)
                    of_drawer = drawer_logs(weights, offsets[2], rows[:, grouped], classes[grouped])
                    logs[grouped] += of_drawer[np.arange(len(grouped)), drawers[grouped]]
                logs = logs / np.log(10) + own - within[classes, drawers]
                firsts = starts[:-1]
                known = np.add.reduceat((count > 0).astype(np.int64), firsts)
                size = np.diff(starts)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array(size), pa.array(known),
                    pa.array(np.full(part.num_rows, vocabulary.tokens, np.int64)),
                    pa.array(np.add.reduceat(own, firsts) - size * base), pa.array(np.add.reduceat(logs, firsts))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run
