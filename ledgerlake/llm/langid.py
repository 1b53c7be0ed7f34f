"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence about a text are combined as if independent given the language:

- the text itself: naive Bayes over hashed byte trigrams, trained on a sample of labelled texts that is bounded per
  language, rare languages with up to ``EACH`` texts. Every language of the labels has a class. Trigrams overlap, so their log likelihoods are tempered: n of them count as n * EVIDENCE / (n + EVIDENCE);
- the language that markup declares, by how often texts of each language declare which;
- the suffix of the address and
- its host, as a prior that is smoothed hierarchically: a host's share of languages is drawn towards that of its suffix,
  and that towards the share of the corpus, each by ``STRENGTH`` imaginary texts. A text's own part in its host's counts
  is left out.

Shares and declarations are counted over the whole corpus by the posteriors of the texts alone, in grouped
aggregations. Only what the number of languages bounds reaches the driver (the trigram table has 128 KB for each); hosts and suffixes are joined.

Null texts are empty and count as no evidence; null or unknown declarations, hosts and suffixes likewise. Ties go to the
language that is more common in the sample, then to the alphabet. Rows are judged one by one; repeated rows count as
often as they occur. Without labelled texts the language is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import tokens
from ledgerlake.llm.components import stored

BITS = 15
SAMPLE = 8_000
EACH = 100
EVIDENCE = 50.0
STRENGTH = 4.0


@dataclass
class TextModel:
    languages: list[str]
    prior: np.ndarray
    table: np.ndarray  # log probabilities: grams x languages


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the bytes of all texts and the edges of each text's; shorter texts have none."""
    data, offsets = tokens.text_bytes(texts)
    wide = data.astype(np.uint32)
    if len(wide) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    values = ((wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    lengths = np.maximum(np.diff(offsets) - 2, 0)
    edges = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(edges[-1]) + np.repeat(offsets[:-1] - edges[:-1], lengths)
    return values[at].astype(np.int64), edges


def train(labelled: DataFrame, text: str, language: str, sample: int = SAMPLE) -> TextModel:
    rows = labelled.where(F.col(language).isNotNull()).select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(language).cast("string").alias("language"))
    shares = rows.groupBy("language").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "language").collect()
    languages = [row.language for row in shares]
    total = sum(row.n for row in shares)
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in tokens.pieces(batches):
            values, edges = grams(batch.column("text"))
            own = np.array([place[x] for x in batch.column("language").to_pylist()], np.int64)
            keys, times = np.unique(np.repeat(own, np.diff(edges)) << BITS | values, return_counts=True)
            met, at = np.unique(np.concatenate((met, keys)), return_inverse=True)
            counts = np.bincount(at, np.concatenate((counts, times)), len(met)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met >> BITS), pa.array(met & ((1 << BITS) - 1)), pa.array(counts)], ["number", "gram", "n"])

    counts = np.full((1 << BITS, max(len(languages), 1)), 0.5, np.float32)
    if languages:
        chance = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
        shown = {row.language: max(sample / total, EACH / row.n) for row in shares}
        bound = F.create_map(*[F.lit(x) for pair in shown.items() for x in pair])
        chosen = rows.where(chance < F.try_element_at(bound, F.col("language")))
        met = chosen.mapInArrow(count, "number long, gram long, n long").groupBy("number", "gram").agg(F.sum("n").alias("n")).toArrow()
        counts[met.column("gram").to_numpy(), met.column("number").to_numpy()] += met.column("n").to_numpy()
    prior = np.array([row.n + 1.0 for row in shares]) / (total + len(shares)) if shares else np.ones(1)
    return TextModel(languages, prior, np.log(counts / counts.sum(0, np.float64)).astype(np.float32))


def pages_evidence(pages: DataFrame, page_id: str, url: str, html: str, languages: list[str]) -> DataFrame:
    """Evidence of web pages: id, text, declared, suffix and host."""
    code = F.coalesce(F.col(html).cast("string"), F.lit(""))
    hidden = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    declared = F.lower(F.regexp_extract(code, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1))
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return evidence(pages, F.col(page_id), F.regexp_replace(code, hidden, " "),
                    F.when(declared.isin(languages), declared), F.regexp_extract(host, r"\.([a-z][a-z0-9-]*)$", 1), host)


def evidence(rows: DataFrame, key: Column, text: Column, declared: Column, suffix: Column, host: Column) -> DataFrame:
    def some(value: Column) -> Column:
        return F.when(value != "", value)

    return rows.select(key.alias("id"), text.cast("string").alias("text"), declared.cast("string").alias("declared"),
                       some(suffix.cast("string")).alias("suffix"), some(host.cast("string")).alias("host"))


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """For rows of ``evidence``: id, lang, probability, text_lang (by the text alone) and declared."""
    if not model.languages:
        none = F.lit(None).cast("string")
        return rows.select("id", none.alias("lang"), F.lit(None).cast("double").alias("probability"), none.alias("text_lang"), "declared")
    count = len(model.languages)
    names = F.array(*map(F.lit, model.languages))
    judged = stored(_judged(rows, model), "text-evidence")
    sums = [F.sum(F.get("own", F.lit(i))).alias(f"s{i}") for i in range(count)]

    corpus = judged.agg(*sums).first()
    whole = np.array([corpus[i] or 0.0 for i in range(count)]) + model.prior
    share = [float(x) for x in whole / whole.sum()]
    declared = _declarations(judged, sums, model.languages)

    by_suffix = judged.where("suffix IS NOT NULL").groupBy("suffix").agg(*sums)
    drawn = _drawn(F.array(*(f"s{i}" for i in range(count))), F.array(*map(F.lit, share)))
    by_suffix = by_suffix.select(F.col("suffix").alias("of_suffix"), drawn.alias("suffix_share"))
    by_host = judged.where("host IS NOT NULL").groupBy("host", "suffix").agg(F.array(*sums).alias("host_sum"))
    hosts = by_host.join(stored(by_suffix, "suffixes"), F.col("suffix") == F.col("of_suffix"), "left").select(
        F.col("host").alias("of_host"), F.col("suffix").alias("host_suffix"), "host_sum",
        F.coalesce("suffix_share", F.array(*map(F.lit, share))).alias("suffix_share"))
    joined = judged.join(stored(hosts, "hosts"), (F.col("host") == F.col("of_host")) & F.col("suffix").eqNullSafe(F.col("host_suffix")), "left")
    table = rows.sparkSession.createDataFrame(list(declared.items()), "of_declared string, said array<double>")
    joined = joined.join(F.broadcast(table), F.col("declared") == F.col("of_declared"), "left")
    others = F.zip_with("host_sum", "own", lambda total, own: F.greatest(total - own, F.lit(0.0)))
    prior = F.coalesce(_drawn(others, F.col("suffix_share")), F.array(*map(F.lit, share)))
    fused = F.zip_with(F.col("text_log"), prior, lambda log, p: log + F.log(p))
    said = F.coalesce("said", F.array(*[F.lit(0.0)] * count))
    fused = F.zip_with(fused, said, lambda a, b: a + b)
    out = joined.select("id", "declared", "text_lang", fused.alias("logs")).withColumn("top", F.array_max("logs"))
    mass = F.aggregate(F.transform("logs", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, b: a + b)
    return out.select("id", F.get(names, F.array_position("logs", F.col("top")).cast("int") - 1).alias("lang"),
                      (1 / mass).alias("probability"), "text_lang", "declared")


def _drawn(sums: Column, towards: Column) -> Column:
    """Shares by sums, drawn towards others."""
    total = F.aggregate(sums, F.lit(0.0), lambda a, b: a + b) + STRENGTH
    return F.zip_with(sums, towards, lambda own, other: (own + STRENGTH * other) / total)


def _declarations(judged: DataFrame, sums: list[Column], languages: list[str]) -> dict[str, list[float]]:
    """Per declared language the logarithm of how likely texts of each language declare it, if they declare any."""
    rows = judged.where(F.col("declared").isin(languages)).groupBy("declared").agg(*sums).collect()
    counts = np.full((len(languages), len(languages)), 0.5) + STRENGTH * np.eye(len(languages))  # most declare their own
    for row in rows:
        counts[languages.index(row.declared)] += list(row)[1:]
    logs = np.log(counts / counts.sum(0))
    return {language: [float(x) for x in logs[i]] for i, language in enumerate(languages)}


def _judged(rows: DataFrame, model: TextModel) -> DataFrame:
    """The evidence with text_log, the tempered log likelihoods of the text, own, the posterior by them, and text_lang."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kept = ["id", "declared", "suffix", "host"]
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        prior = np.log(model.prior)
        for batch in tokens.pieces(batches):
            values, edges = grams(batch.column("text"))
            n = np.diff(edges)
            logs = np.zeros((batch.num_rows, len(model.languages)))
            owner = np.repeat(np.arange(batch.num_rows), n)
            for i in range(len(model.languages)):
                logs[:, i] = np.bincount(owner, model.table[values, i], batch.num_rows)
            logs *= (EVIDENCE / (n + EVIDENCE))[:, None]
            logs -= logs.max(axis=1, keepdims=True)
            own = np.exp(logs + prior)
            own /= own.sum(axis=1, keepdims=True)
            languages = np.array(model.languages, object)[np.argmax(own, axis=1)]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(name) for name in kept), pa.array(list(logs), pa.list_(pa.float64())),
                pa.array(list(own), pa.list_(pa.float64())), pa.array(languages, pa.string())],
                [*kept, "text_log", "own", "text_lang"])

    return rows.mapInArrow(run, f"id {kind}, declared string, suffix string, host string, text_log array<double>, "
                                "own array<double>, text_lang string")
