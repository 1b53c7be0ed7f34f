"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, decontaminate, jaccard, langid, lm, neighbours, pq, quality, secrets, spelling, topk, toxicity, warc
from ledgerlake.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column) -> Column:
    """Fold of a document: crc32 of its id as text, modulo 5."""
    return F.crc32(doc_id.cast("string")) % 5


@register
def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), "doc_id", "text", remainder(F.col("doc_id")) == 1)


@register
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), "doc_id", "text", RANKS, public_tokenizers.PATTERN)


@register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    keyed = documents.select("doc_id", "text", toxicity.text_key("text").alias("text_key"))
    train = keyed.join(labels.select("doc_id", "toxic"), "doc_id").where(remainder(F.col("doc_id")) != 0)
    scored = toxicity.score(documents, "doc_id", "text", toxicity.train(train, "text", "toxic", key="text_key"))
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(
        table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


@register
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written, then read back: responses with their payloads, revisits by their headers alone."""
    folder = new_folder(spark, "warc")
    warc.write(warc.deduplicated(table(spark, sf_dir, "pages"), "page_id", "url", "html"), folder, "2024-01-01T00:00:00Z")
    responses = warc.read(spark, folder).where("record_type = 'response'").withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "digest": warc.payload_digest(F.col("payload"))})
    revisits = warc.read(spark, folder, payload=False).where("record_type = 'revisit'").withColumns({
        "payload_bytes": F.col("payload_length").cast("long"), "digest": F.regexp_extract("payload_digest", "sha1:(.*)", 1)})

    def page(column: str) -> Column:
        number = F.regexp_extract(column, "<urn:page:(-?[0-9]+)>", 1)
        return F.when(number != "", number.cast("long"))

    return responses.unionByName(revisits).select(
        page("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
        page("refers_to").alias("refers_to"))


ORACLES["op5_warc"] = """
WITH filled AS (
    SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages
), hashed AS (
    SELECT *, sha1(payload) AS h, (page_id IS NOT DISTINCT FROM first_id OR first_id IS NULL) AS response FROM filled
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
               (CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
       ), 'string_agg', '') AS payload_digest,
       CASE WHEN response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN NOT response THEN first_id END AS refers_to
FROM hashed
"""


@register
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5)


ORACLES["op6_exact_top_k"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@register
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new ledger, so every distinct text counts as unseen."""
    documents = table(spark, sf_dir, "documents")
    ledger = secrets.BlobLedger(spark, new_folder(spark, "blob-ledger"))
    ledger.scan(documents, "doc_id", "text")
    found = ledger.by_path(documents, "text", carried=["doc_id"])
    counts = [F.size(rule.kind).cast("long").alias(f"n_{rule.kind}") for rule in secrets.RULES]
    return found.select("row.doc_id", *counts, secrets.listed().alias("spans")).select(
        "doc_id", *(f"n_{rule.kind}" for rule in secrets.RULES), F.sha2("spans", 256).alias("base_sha256"), "spans")


def _spans_sql(name: str, rule: int, pattern: str, measured: int = 0, least: int = 0) -> str:
    """Matches of one kind, with positions by the lengths of the matches and of the texts between them."""
    return f"""{name} AS (
    SELECT doc_id, {rule} AS rule, '{name}' AS kind, CAST(ends[i] - sizes[i] AS BIGINT) AS s, CAST(ends[i] AS BIGINT) AS e
    FROM (
        SELECT doc_id, sizes, kept, i, list_transform(range(1, len(sizes) + 1),
               lambda j: list_sum(sizes[1:j]) + list_sum(gaps[1:j])) AS ends
        FROM (
            SELECT doc_id, list_transform(regexp_extract_all(t, {pattern}, 0), lambda x: length(x)) AS sizes,
                   list_transform(regexp_extract_all(t, {pattern}, {measured}), lambda x: length(x) >= {least}) AS kept,
                   list_transform(regexp_split_to_array(t, {pattern}), lambda x: length(x)) AS gaps
            FROM texts WHERE regexp_matches(t, {pattern})
        ), range(1, len(sizes) + 1) r(i)
    ) WHERE kept[i]
)"""


_ASSIGN = """'((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""

ORACLES["op8_secret_scan"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_spans_sql("assign", 0, _ASSIGN, 2, 8)},
{_spans_sql("access", 1, "'AKIA[A-Z0-9]{12,}'")},
{_spans_sql("hex", 2, "'[0-9a-f]{32,}'")},
spans AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
counted AS (
    SELECT doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access,
           count(*) FILTER (rule = 2) AS n_hex,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rule) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN counted USING (doc_id)
"""


@register
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, with their markup and address, and documents, whose source counts as their host. The languages of
    documents train the text model and are no evidence."""
    documents, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = langid.train(documents, "text", "lang")
    none = F.lit(None).cast("string")
    of_pages = langid.pages_evidence(pages, "page_id", "url", "html", model.languages)
    of_documents = langid.evidence(documents, F.col("doc_id"), F.col("text"), none, none, F.col("source"))
    no_id = F.lit(None).cast("long")
    found = langid.identify(of_pages, model).withColumns({"page_id": F.col("id"), "doc_id": no_id}).unionByName(
        langid.identify(of_documents, model).withColumns({"page_id": no_id, "doc_id": F.col("id")}))
    return found.select("doc_id", "page_id", "lang", "probability", "text_lang", "declared")


@register
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(documents, "text", quality.train(documents, "text"))
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= 0.5).alias("kept"))


@register
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), "doc_id", "text")


@register
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), "doc_id", "text")


def _crc_steps(value: str, times: int) -> str:
    """SQL of ``times`` steps of the checksum's shift register."""
    for _ in range(times):
        value = f"list_transform({value}, lambda c: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return value


# The checksum goes byte by byte through a table that its own shift register gives; bytes come from the hexadecimal text.
# Near words share a text with one code point left out, at the same place if they are equally long.
ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {_crc_steps("range(0, 256)", 8)} AS t),
runs AS (
    SELECT doc_id, lower_run AS run, count(*) AS c FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\u00C0-\u00FF]+')) AS lower_run
        FROM documents
    ) WHERE length(lower_run) >= 5 GROUP BY ALL
), hashed AS (
    SELECT run, c, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
        lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) AS h
    FROM (SELECT run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs), crc
), words AS MATERIALIZED (
    SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
        FROM hashed
    ) WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), cut AS MATERIALIZED (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, length(word) + 1) t(i)
), near AS MATERIALIZED (
    SELECT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
    UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word
), best AS (
    SELECT near.word, count(*) AS n_near, arg_min(near.other, (-o.n, near.other)) AS other, max(o.n) AS other_n
    FROM near JOIN words o ON near.other = o.word GROUP BY near.word
), formed AS MATERIALIZED (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
           CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), steps AS (
    SELECT word, word AS at FROM formed
    UNION ALL
    SELECT steps.word, formed.form FROM steps JOIN formed ON steps.at = formed.word WHERE formed.form IS NOT NULL
)
SELECT f.word, f.form, steps.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN steps ON f.word = steps.word JOIN formed l ON steps.at = l.word AND l.form IS NULL
"""


@register
def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


ORACLES["op12_embedding_near_dedup"] = """
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS r, vec_id, CASE
        WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS v
    FROM embeddings
), links AS MATERIALIZED (
    SELECT a.r AS a, b.r AS b FROM rows a JOIN rows b ON a.r <> b.r AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT r AS a, r AS b FROM rows
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), named AS (
    SELECT reach.a AS r, min(rows.vec_id) AS component_id FROM reach JOIN rows ON reach.b = rows.r GROUP BY reach.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = rows.r) AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN named USING (r)
"""


@register
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.encode(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def _codes_sql() -> str:
    """Rounds as a chain of common table expressions; a squared distance is x.x - 2 x.e + e.e, exact in doubles."""
    steps = ["""
rows AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v, row_number() OVER () AS r
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT r, p, x, list_inner_product(x, x) AS xx
    FROM (SELECT r, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM rows, range(4) t(p))
), book0 AS MATERIALIZED (
    SELECT p, i, x AS e, list_inner_product(x, x) AS ee FROM parts JOIN (
        SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS i FROM rows QUALIFY i < 256
    ) USING (r)
)"""]
    for number in range(5):
        steps.append(f"""
near{number} AS MATERIALIZED (
    SELECT r, parts.p, arg_min(i, (xx - 2 * list_inner_product(x, e) + ee, i)) AS i,
           min(xx - 2 * list_inner_product(x, e) + ee) AS d
    FROM parts JOIN book{number} b ON parts.p = b.p GROUP BY r, parts.p
)""")
        if number < 4:
            steps.append(f"""
mean{number} AS (
    SELECT p, i, list(floor(s / c) ORDER BY k) AS e FROM (
        SELECT parts.p, n.i, k, sum(x[k]) AS s, count(*) AS c
        FROM parts JOIN near{number} n ON parts.r = n.r AND parts.p = n.p, range(1, len(x) + 1) t(k)
        GROUP BY parts.p, n.i, k
    ) GROUP BY p, i
), book{number + 1} AS MATERIALIZED (
    SELECT p, i, e, list_inner_product(e, e) AS ee FROM (
        SELECT b.p, b.i, coalesce(m.e, b.e) AS e FROM book{number} b LEFT JOIN mean{number} m ON b.p = m.p AND b.i = m.i)
)""")
    return f"""WITH {",".join(steps)},
digest AS (
    SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ','
                             ORDER BY p, i)) AS codebooks_sha256 FROM book4
), coded AS (
    SELECT r, string_agg(format('{{:02x}}', i), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near4 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM rows JOIN coded USING (r), digest"""


ORACLES["op13_vector_codes"] = _codes_sql()
