"""The registered queries against their SQL, and the pipeline stage by stage."""

import __spark_entry__ as registered
import compare
import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_jaccard import all_pairs
from test_search_and_text import spans

from ledgerlake.llm import bpe
from ledgerlake.llm.queries import ORACLES, QUERIES, RANKS


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert registered.queries()["pipeline"].__wrapped__ is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, name):
    assert compare.spark_rows(QUERIES[name](spark, folder)) == compare.duck_rows(ORACLES[name], folder)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = [(-1, None, "en", "s", None), (-2, "", None, None, 0), (None, "some text without an id", "en", "s", 23), (-2, "", None, None, 0),
           (-3, "password = hunter2hunter2 ok", "en", "s", 28)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("row", F.lit(1))
    stages = dict(corpus_pipeline.STAGES)
    kept = corpus_pipeline.stored(stages["quality"](spark, docs, folder), "test-stage")
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()

    single = corpus_pipeline.stored(stages["near duplicates"](spark, kept, folder), "test-stage")
    rows = [(row.doc_id, row.text) for row in kept.where("doc_id IS NOT NULL").collect()]
    want = {key for key, _, component in all_pairs(rows) if key == component}
    assert single.columns == docs.columns
    assert {row.doc_id for row in single.collect()} - {None} == want
    assert single.where("doc_id IS NULL").count() == 1

    leaked = {row.doc_id for row in QUERIES["op4_decontaminate"](spark, folder).collect()}
    pure = corpus_pipeline.stored(stages["decontamination"](spark, single, folder), "test-stage")
    assert {row.doc_id for row in pure.collect()} == {row.doc_id for row in single.collect()} - leaked

    safe = corpus_pipeline.stored(stages["secrets"](spark, pure, folder), "test-stage")
    before = {row.doc_id: row.text for row in pure.collect()}
    assert safe.columns == docs.columns and safe.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    changed = 0
    for row in safe.collect():
        assert spans(row.text) == "" and (spans(before[row.doc_id]) == "") == (row.text == before[row.doc_id])
        changed += row.text != before[row.doc_id]
    assert changed

    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = {row.doc_id: row.text or "" for row in safe.collect()}
    for row in stages["tokens"](spark, safe, folder).collect():
        assert list(row.ids) == coder.encode_ordinary(texts[row.doc_id])
