"""Secret scans over an incremental ledger of blobs.

Every version of every path is content-addressed: its blob id is the SHA-256 of its text. A scan looks only at pairs of
a blob and a rule version that the ledger does not hold yet, appends what it finds and the pairs it has scanned, and
joins findings back to all paths of a blob. Copies, later versions with an old text and repeated runs cost no scan; a
new rule version scans all blobs once for that rule.

The ledger is two Parquet tables below one folder: ``scanned`` (blob_id, kind, version) and ``findings`` (blob_id, kind,
version, spans). Findings are appended before the pairs that they belong to, so a run that breaks off is repeated by the
next one, and the repeated findings are equal rows that reading drops. One writer at a time.

Spans are code points, end exclusive, found left to right without overlap per rule. Java's regular expressions give the
matches and the texts between them, and a running sum of their lengths gives the positions. Null texts are empty and
have no findings; texts are scanned whole. A path may have several rows; each is joined to the findings of its text. An empty
table adds nothing, and a ledger without rows reads as empty. Further columns of the versions, whatever their names, stay inside
the struct that ``by_path`` returns; a column that is named like a kind does no harm there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import new_folder

SPAN = "struct<start: int, end: int>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``; a match whose group ``measured`` has fewer than ``least`` characters is dropped."""

    kind: str
    pattern: str
    measured: int = 0
    least: int = 0
    version: str = "1"


# Fixed values of the base rules, in their order.
# Shorter runs of upper-case or hexadecimal characters cannot be matches, so their least length is in the pattern.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)

SPANS = f"array<{SPAN}>"
SCANNED = "blob_id string, kind string, version string"
FINDINGS = f"{SCANNED}, spans {SPANS}"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def spans_of(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of a rule's matches, in order."""
    pattern = F.lit(rule.pattern)
    matched = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.measured)) if rule.measured else matched
    zipped = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("before"),
        F.transform(matched, F.length).alias("size"),
        F.transform(measured, F.length).alias("measured"),
    )
    # The list of texts between is one longer than that of the matches; its last part has no match after it.
    zipped = F.filter(zipped, lambda x: x["size"].isNotNull())
    none = F.array().cast(SPANS)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["before"]
        end = start + x["size"]
        found = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(
            x["measured"] >= rule.least, F.concat(state["spans"], found)).otherwise(state["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    found = F.aggregate(zipped, start, step, lambda state: state["spans"])
    return F.when(F.regexp_like(text, pattern), found).otherwise(none)


class BlobLedger:
    """The ledger in ``folder``, which all executors must share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _table(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def scanned(self) -> DataFrame:
        return self._table("scanned", SCANNED)

    def findings(self) -> DataFrame:
        """One row per blob and rule version that found something."""
        return self._table("findings", FINDINGS).dropDuplicates(["blob_id", "kind", "version"])

    def scan(self, versions: DataFrame, path: str, text: str, rules: tuple[Rule, ...] = RULES) -> None:
        """Scans what is new in ``versions`` under ``rules``; may be called for every delivery of versions."""
        blobs = versions.select(F.col(path).alias("path"), blob_id(F.col(text)).alias("blob_id"),
                                F.coalesce(F.col(text), F.lit("")).alias("text"))
        # One row stands for a blob. It is picked without its text, so that each text to be scanned moves once.
        chosen = blobs.groupBy("blob_id").agg(F.min("path").alias("path"))
        seen = self.scanned().groupBy("blob_id").agg(
            F.collect_set(F.struct("kind", "version")).alias("seen"))  # as many as there are rule versions at most
        states = [F.coalesce(F.array_contains("seen", _pair(rule)), F.lit(False)).alias(rule.kind) for rule in rules]
        due = chosen.join(seen, "blob_id", "left").select("blob_id", "path", *states)
        due = due.where(~F.forall(F.array(*(rule.kind for rule in rules)), lambda known: known))
        wanted = due.withColumnsRenamed({"blob_id": "due_blob", "path": "due_path"}).hint("shuffle_hash")
        fresh = blobs.join(wanted, F.expr("blob_id = due_blob AND path <=> due_path"))
        spans = [F.when(~F.col(rule.kind), spans_of(F.col("text"), rule)) for rule in rules]
        found = fresh.select("blob_id", *(x.alias(rule.kind) for x, rule in zip(spans, rules, strict=True)))
        found = _by_rule(found, rules, "spans").where(F.size("spans") > 0)
        found.write.mode("append").parquet(f"{self.folder}/findings")
        pairs = _by_rule(due, rules, "known").where("NOT known").drop("known")
        pairs.write.mode("append").parquet(f"{self.folder}/scanned")

    def by_path(self, versions: DataFrame, text: str, rules: tuple[Rule, ...] = RULES, carried: list[str] | None = None) -> DataFrame:
        """``row``, a row of ``versions`` as a struct, and per rule a column of its kind with the spans in the row's
        text; one row per row of ``versions``. ``carried`` names the columns of the struct, all unless given; without the text
        among them only short rows are moved to meet the findings."""
        kept = self.findings().where(F.struct("kind", "version").isin([_pair(rule) for rule in rules]))
        blobs = kept.groupBy("blob_id").agg(*[
            F.max(F.when(F.col("kind") == rule.kind, F.col("spans"))).alias(rule.kind) for rule in rules])
        # Written, so that the join reads both sides from shuffles and splits a blob that very many paths share.
        blobs.write.parquet(target := new_folder(self.spark, "findings"))
        blobs = self.spark.read.parquet(target)
        row = F.struct(*(F.col(name) for name in versions.columns if carried is None or name in carried))
        rows = versions.select(row.alias("row"), blob_id(F.col(text)).alias("blob_id"))
        empty = F.array().cast(SPANS)
        return rows.join(blobs, "blob_id", "left").select(
            "row", *(F.coalesce(rule.kind, empty).alias(rule.kind) for rule in rules))


def _pair(rule: Rule) -> Column:
    return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))


def _by_rule(rows: DataFrame, rules: tuple[Rule, ...], value: str) -> DataFrame:
    """One row per rule from the columns named by kind."""
    return rows.select("blob_id", F.inline(F.array(*[
        F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.col(rule.kind).alias(value))
        for rule in rules])))


def listed(rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a row of ``by_path`` as ``kind:start:end``, by start and then by the order of the rules."""
    def placed(rule: Rule, number: int) -> Column:
        return F.transform(rule.kind, lambda x: F.struct(
            x["start"].alias("start"), F.lit(number).alias("rule"), x["end"].alias("end")))

    numbered = [placed(rule, number) for number, rule in enumerate(rules)]
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    texts = F.transform(F.array_sort(F.concat(*numbered)), lambda x: F.concat_ws(
        ":", F.get(kinds, x["rule"]), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(texts, ",")


def redacted(text: Column, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> Column:
    """The text of a row of ``by_path`` with its spans replaced by ``mark``, spans that overlap by one."""
    spans = F.array_sort(F.concat(*[F.col(rule.kind) for rule in rules]))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        between = F.array(F.substr(text, state["at"] + 1, span["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], F.concat(state["parts"], between)).otherwise(state["parts"]).alias("parts"))

    done = F.aggregate(spans, start, step, lambda state: F.concat(
        F.array_join(state["parts"], ""), F.substr(text, state["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
