"""A training-data pipeline over documents, in five stages.

Each stage takes all rows that its predecessor kept and returns a frame, which is written to the shared folder and read
again as the input of the next one:

1. quality: documents whose weak-label score is below a half go;
2. near duplicates: one document of each group that the Jaccard join links stays, the one with the smallest id;
3. decontamination: documents with a window that matches a benchmark item go;
4. secrets: found spans are replaced in the text;
5. tokens: per document its token ids, with digests of them and of the bytes that they decode to.

Null texts count as empty and stay until the end; empty tables stay empty. Rows without id pass all stages, but link in stage
2. Of rows that repeat an id one stays from stage 2 on. Further columns are carried along up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, decontaminate, jaccard, quality, secrets
from ledgerlake.llm.components import stored
from ledgerlake.llm.jaccard import short_batches
from ledgerlake.llm.queries import RANKS
from ledgerlake.session import new_folder


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = "_quality_score"
    scored = quality.score(docs, "text", quality.train(docs, "text"), score)
    return scored.where(F.col(score) >= 0.5).drop(score)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, "doc_id", "text")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, "doc_id", "text", benchmark, "item_id", "text")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ledger = secrets.BlobLedger(spark, new_folder(spark, "blob-ledger"))
    ledger.scan(docs, "doc_id", "text")
    rows = ledger.by_path(docs, "text").select(
        "row", secrets.redacted(F.col("row.text")).alias("redacted")).withColumn("changed", ~F.col("redacted").eqNullSafe(F.col("row.text")))

    def column(name: str):
        if name == "text":
            return F.col("redacted").alias(name)
        if name == "n_chars":
            return F.when(F.col("changed"), F.length("redacted").cast(docs.schema[name].dataType)).otherwise(
                F.col("row.n_chars")).alias(name)
        return F.col("row")[name].alias(name)

    return rows.select(*map(column, docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with short_batches(spark):  # written here, so that the workers get few long texts at a time
        digests = bpe.digest(docs, "doc_id", "text", RANKS, public_tokenizers.PATTERN, ids=True, remembered=60_000)
        return stored(digests, "token-ids")


STAGES = [
    ("quality", good),
    ("near duplicates", distinct),
    ("decontamination", uncontaminated),
    ("secrets", without_secrets),
    ("tokens", tokens),
]

# Training, the join and tokenisation have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
