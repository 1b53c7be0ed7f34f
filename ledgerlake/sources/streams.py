"""Stream sources. ``open`` gives a streaming frame with a ``value`` column, text or bytes; jobs do not care which
source stands behind it."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class StreamSource(Protocol):
    def open(self, spark: SparkSession) -> DataFrame: ...


@dataclass(frozen=True)
class FileStream:
    """Text files, one record per line, read as they appear."""

    path: str
    files_per_trigger: int | None = None

    def open(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format("text")
        if self.files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(self.files_per_trigger))
        return reader.load(self.path)


@dataclass(frozen=True)
class KafkaStream:
    """Kafka topic by ``subscribe``, or explicit partitions by ``assign`` (JSON); needs Spark's Kafka package.

    ``offsets_per_trigger`` limits a micro-batch, as the flush limits of a buffered sink would.
    """

    servers: str
    subscribe: str | None = None
    assign: str | None = None
    starting: str = "latest"
    offsets_per_trigger: int | None = None
    text: bool = True
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        if (self.subscribe is None) == (self.assign is None):
            raise ValueError("give either subscribe or assign")
        chosen = {"subscribe": self.subscribe} if self.subscribe else {"assign": self.assign}
        limit = {"maxOffsetsPerTrigger": str(self.offsets_per_trigger)} if self.offsets_per_trigger else {}
        return {
            "kafka.bootstrap.servers": self.servers, **chosen, "startingOffsets": self.starting, **limit,
            **self.options,
        }

    def open(self, spark: SparkSession) -> DataFrame:
        """Record values; a record without value only marks a deleted key for the topic's compaction."""
        records = spark.readStream.format("kafka").options(**self.reader_options()).load()
        value = F.col("value").cast("string") if self.text else F.col("value")
        return records.where(F.col("value").isNotNull()).select(value.alias("value"))
