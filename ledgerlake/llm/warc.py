"""WARC archives: written from a table of pages, read by a Python data source.

Writing: of the pages with equal payloads, the one with the smallest id becomes a ``response`` record with the payload;
the others become ``revisit`` records that refer to it and carry its digest and length. Records are text with the
payload in UTF-8, so Spark's text sink writes them to any store it knows, with the record separator as line separator.

Reading (format ``warc``): each file is one partition. Headers are parsed first; a record that the pushed predicates
on type and headers reject, or whose payload the option ``payload`` does not want, is passed over without reading its
payload into memory or decoding it. Predicates that are not understood stay with Spark.

Null payloads are empty, null urls leave out their header, control characters in urls are percent-encoded. Rows that
repeat the id of the first page of a payload are responses as well; a page without id is a revisit if its payload has
a first page with id, else a response. An empty table gives archives without records. Other columns are not archived.
"""

from __future__ import annotations

import gzip
import io
import posixpath
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
)

from ledgerlake.session import new_folder

# Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = "WARC/1.1"
END = "\r\n\r\n"
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "date": "warc-date",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "payload_length": "x-payload-length",
}

BATCH_BYTES = 4 << 20


def payload_digest(payload: Column) -> Column:
    """SHA-1 in base 32, from five hexadecimal digits to four characters at a time. The digest and each number are arguments
    of a function, so that they are computed once and not wherever they are used."""
    letters = F.lit(BASE32)

    def four(value: Column) -> Column:
        return F.concat(*[F.substr(letters, F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)])

    def encoded(hexed: Column) -> Column:
        numbers = F.array(*[F.conv(F.substr(hexed, F.lit(i + 1), F.lit(5)), 16, 10).cast("int") for i in range(0, 40, 5)])
        return F.array_join(F.transform(numbers, four), "")

    return F.element_at(F.transform(F.array(F.sha1(payload)), encoded), 1)


def deduplicated(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """Columns page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to."""
    spark = pages.sparkSession
    filled = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), filled.alias("payload"),
    ).withColumns({
        "content": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long"),
    })
    first = rows.groupBy("content").agg(F.min("page_id").alias("first_id"))
    # Written, so that the join reads both sides from shuffles and splits a payload that very many pages share.
    first.write.parquet(folder := new_folder(spark, "first-pages"))
    joined = rows.join(spark.read.parquet(folder), "content")
    response = F.col("page_id").eqNullSafe(F.col("first_id")) | F.col("first_id").isNull()
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", payload_digest(F.col("payload")).alias("payload_digest"),
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("first_id")).alias("refers_to"),
    )


def urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def write(records: DataFrame, folder: str, date: str) -> None:
    """Writes the rows of ``deduplicated`` as compressed archives, one per task. ``date`` is the time of capture."""
    response = F.col("record_type") == "response"
    printable = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    headers = F.concat_ws(
        "\r\n", F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), printable),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to"))),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(response, F.col("payload_bytes")).otherwise(0).cast("string")),
    )
    body = F.when(response, F.col("payload")).otherwise("")
    text = F.concat(headers, F.lit(END), body)  # the sink adds END, which closes the record
    records.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(folder)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


class WarcSource(DataSource):
    """Options: ``path``, a file or folder; ``payload``, whether payloads are wanted (default true)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return ", ".join(f"{column} string" for column in HEADERS) + ", content_length long, payload binary"

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")


@dataclass
class WarcFile(InputPartition):
    uri: str


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for condition in filters:
            column = getattr(condition, "attribute", ())
            if isinstance(condition, (EqualTo, EqualNullSafe, In, IsNotNull, IsNull, StringStartsWith)) \
                    and len(column) == 1 and column[0] in HEADERS:
                self.filters.append(condition)
            else:
                yield condition

    def partitions(self) -> list[WarcFile]:
        store, root = _store(self.path)
        info = store.get_file_info(root)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        files = [x for x in found if x.is_file and not posixpath.basename(x.path).startswith(("_", "."))]
        prefix = self.path[:len(self.path) - len(root)] if self.path.endswith(root) else ""
        files.sort(key=lambda x: (-x.size, x.path))  # the longest start first
        return [WarcFile(prefix + x.path) for x in files if x.size]

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        store, path = _store(partition.uri)
        types = [pa.string()] * len(HEADERS) + [pa.int64(), pa.binary()]
        names = [*HEADERS, "content_length", "payload"]
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        with store.open_input_file(path) as raw:
            stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 18)
            for headers in iter(lambda: _headers(stream, partition.uri), None):
                length = int(headers["content-length"])
                if not all(_holds(condition, headers) for condition in self.filters):
                    stream.seek(length, io.SEEK_CUR)
                    continue
                payload = None
                if self.payload:
                    payload = stream.read(length)
                    if len(payload) < length:
                        raise ValueError(f"{partition.uri}: the file ends within a payload")
                else:
                    stream.seek(length, io.SEEK_CUR)
                rows.append((*(headers.get(name) for name in HEADERS.values()), length, payload))
                held += 500 + (length if self.payload else 0)
                if held > BATCH_BYTES:
                    yield batch()
                    rows.clear()
                    held = 0
        if rows:
            yield batch()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def _headers(stream: io.BufferedIOBase, uri: str) -> dict[str, str] | None:
    """Headers of the next record by lower-case name, None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"{uri}: no record begins at {line[:40]!r}")
    headers = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8", errors="replace").partition(":")
        headers[name.strip().lower()] = value.strip()
    if "content-length" not in headers:
        raise ValueError(f"{uri}: a record has no length")
    return headers


def _holds(condition: Filter, headers: dict[str, str]) -> bool:
    value = headers.get(HEADERS[condition.attribute[0]])
    if isinstance(condition, IsNull):
        return value is None
    if isinstance(condition, IsNotNull):
        return value is not None
    if isinstance(condition, EqualNullSafe):
        return value == condition.value
    if value is None:
        return False
    if isinstance(condition, In):
        return value in condition.value
    if isinstance(condition, StringStartsWith):
        return value.startswith(condition.value)
    return value == condition.value
