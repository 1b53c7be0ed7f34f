"""Compressed vector codes: a codebook per part of the vector, trained and assigned in integers.

Components become integers floor(scale * x). A vector is cut into equal parts, and each part is coded by the nearest entry
of its part's codebook. The vectors are stored once in blocks: per block and dimension a dictionary of the distinct integers
that occur and, per vector, the number of its integer in it. A round tabulates, per dimension, the squared differences of
every dictionary value to all entries; the distances of a part are then rows gathered from these tables and added up. So the
arithmetic grows with the distinct values, and what is left per vector are gathers and additions.

Training is Lloyd's method on all rows. Each task sends one sum per entry that it used, and the driver holds the codebooks
and their sums, whose size depends on the width of the vectors alone.

Vectors that are null or hold nulls, NaN or infinities are dropped. Vectors may differ in length: all are filled with zeros
up to the longest one, rounded up to whole parts, and an empty vector is one of zeros. Rows that repeat an id or a vector
all count. The first entries are those of the smallest ids, ties by the components in order, rows without id after all
others; with fewer rows than entries there are as many entries as rows. An empty table gives no rows. Integers so large that a squared
distance may leave 64 bits (components of about 180,000 at 64 dimensions and scale 1024) raise an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK_VALUES = 1 << 19  # integers of a block
GATHERED = 1024  # vectors whose distances are held at a time
Books = list[np.ndarray]  # per part: entries x positions


def usable(vector: Column) -> Column:
    """True for a vector of finite numbers."""
    values = vector.cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return F.coalesce(finite, F.lit(False))


def encode(vectors: DataFrame, id_column: str, vector: str, label: str, parts: int = PARTS, entries: int = ENTRIES,
           rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Columns ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` for each usable row.

    ``code`` has two hexadecimal digits per part, ``error`` is the squared distance to the entries it names, and
    ``label_error`` the sum of that over the rows with an equal label, null among them."""
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits per part, so at most 256 entries")
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("v")).where(usable(F.col("v")))
    first = rows.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    widest = rows.agg(F.max(F.size("v")).alias("width")).first().width
    width = max(1, math.ceil((widest or 0) / parts)) * parts
    kinds = dict(rows.dtypes)
    blocks = stored(rows.mapInArrow(
        _packer(width, scale),
        f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, dictionaries array<array<bigint>>, codes binary",
    ), "vector-blocks")
    start = _integers(np.array([[*row.v, *[0.0] * (width - len(row.v))] for row in first]).reshape(len(first), width), scale)
    books = [np.ascontiguousarray(part) for part in np.split(start, parts, axis=1)]
    for _ in range(rounds if first else 0):
        books = _updated(books, blocks)
    coded = stored(blocks.mapInArrow(
        _coder(books), f"vec_id {kinds['id']}, label {kinds['label']}, code string, error bigint"), "vector-codes")
    of_label = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def digest(books: Books) -> str:
    """SHA-256 of all components by part, entry and position, in decimal with commas between."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(values * float(scale))
    limit = math.isqrt((1 << 61) // max(1, values.shape[1]))
    if scaled.size and np.abs(scaled).max() > limit:
        raise ValueError(f"squared distances of components beyond {limit / scale:.6g} leave 64 bits")
    return scaled.astype(np.int64)


def _packer(width: int, scale: int):
    step = max(1, BLOCK_VALUES // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                values = _integers(_filled(part.column("v"), width), scale)
                found = [np.unique(values[:, at], return_inverse=True) for at in range(width)]
                codes = np.stack([number for _, number in found]).astype(np.uint32)
                whole = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(whole, part.column("id")),
                    pa.ListArray.from_arrays(whole, part.column("label")),
                    pa.array([[values.tolist() for values, _ in found]], pa.list_(pa.list_(pa.int64()))),
                    pa.array([codes.tobytes()], pa.binary()),
                ], ["ids", "labels", "dictionaries", "codes"])

    return run


def _filled(vectors: pa.ListArray, width: int) -> np.ndarray:
    """The vectors as rows of ``width`` numbers, with zeros after shorter ones."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = vectors.flatten().to_numpy()
    return out


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """Per block its place in the batch, its dictionaries and its codes, dimension by dimension."""
    for at in range(batch.num_rows):
        dictionaries = [x.values.to_numpy() for x in batch.column("dictionaries")[at]]
        codes = np.frombuffer(batch.column("codes")[at].as_py(), np.uint32).reshape(len(dictionaries), -1)
        yield at, dictionaries, codes


def nearest(dictionaries: list[np.ndarray], codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry, the first of equally near ones, and its squared distance, for the part that these dictionaries and
    codes hold."""
    apart = max(int(max(abs(values[-1] - low), abs(high - values[0])))
                for values, low, high in zip(dictionaries, book.min(axis=0), book.max(axis=0), strict=True))
    kind = np.int32 if len(dictionaries) * apart * apart < 1 << 31 else np.int64
    tables = [((values[:, None] - book[:, at]) ** 2).astype(kind) for at, values in enumerate(dictionaries)]
    count = codes.shape[1]
    entry, distance = np.empty(count, np.int64), np.empty(count, np.int64)
    sums, row = np.empty((GATHERED, len(book)), kind), np.empty((GATHERED, len(book)), kind)
    for first in range(0, count, GATHERED):
        end = min(first + GATHERED, count)
        total, added = sums[:end - first], row[:end - first]
        total[:] = 0
        for table, numbers in zip(tables, codes, strict=True):
            np.take(table, numbers[first:end], axis=0, out=added, mode="clip")
            total += added
        entry[first:end] = total.argmin(axis=1)
        distance[first:end] = total[np.arange(end - first), entry[first:end]]
    return entry, distance


def _updated(books: Books, blocks: DataFrame) -> Books:
    """The codebooks after one round: means of the parts assigned to each entry, rounded down."""
    positions = range(books[0].shape[1])
    totals = blocks.select("dictionaries", "codes").mapInArrow(
        _summer(books), "cell int, n bigint, sums array<bigint>").groupBy("cell").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.get("sums", F.lit(at)).cast("decimal(38,0)")) for at in positions]).alias("sums"))
    out = [book.copy() for book in books]
    for row in totals.collect():  # a row per entry at most
        part, entry = divmod(row.cell, len(books[0]))
        out[part][entry] = [int(total) // row.n for total in row.sums]
    return out


def _summer(books: Books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, width = books[0].shape
        sums, counts = np.zeros((len(books) * entries, width), np.int64), np.zeros(len(books) * entries, np.int64)
        for batch in batches:
            for _, dictionaries, codes in _blocks(batch):
                for part, book in enumerate(books):
                    own = slice(part * width, (part + 1) * width)
                    entry, _ = nearest(dictionaries[own], codes[own], book)
                    order = np.argsort(entry, kind="stable")
                    edges = np.flatnonzero(np.diff(entry[order], prepend=-1))
                    cells = part * entries + entry[order[edges]]
                    counts[cells] += np.diff(edges, append=len(order))
                    for at in range(width):
                        values = dictionaries[own][at][codes[own][at][order]]
                        sums[cells, at] += np.add.reduceat(values, edges)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64())),
        ], ["cell", "n", "sums"])

    return run


def _coder(books: Books):
    digits = np.array([f"{entry:02x}" for entry in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, dictionaries, codes in _blocks(batch):
                width = books[0].shape[1]
                error, text = np.zeros(codes.shape[1], np.int64), np.full(codes.shape[1], "", "U1")
                for part, book in enumerate(books):
                    own = slice(part * width, (part + 1) * width)
                    entry, distance = nearest(dictionaries[own], codes[own], book)
                    error += distance
                    text = np.char.add(text, digits[entry])
                yield pa.RecordBatch.from_arrays([
                    batch.column("ids")[at].values, batch.column("labels")[at].values,
                    pc.cast(pa.array(text.tolist()), pa.string()), pa.array(error),
                ], ["vec_id", "label", "code", "error"])

    return run
