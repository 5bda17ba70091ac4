"""Registered queries: one per operator of the inventory, each with its DuckDB
restatement where SQL can express it.

Every query reads whole tables under ``sf_dir`` (or data Spark derives from
them).  Floats are rounded to 6 digits on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.operators import keyword
from sheaf.operators.chunk import split_text
from sheaf.plans import oracle as O
from sheaf.plans.corpus import doc_corpus
from sheaf.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

KEYWORD_QUERY = "revenue growth of the company and its market"
MATCH_ALL_QUERY = "the of and"
TOP_K = 10


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- X11: overlapping split alone ---------------------------------------------
@register("x11_overlap_split", f"""
WITH RECURSIVE {O.doc_src()},
{O.split_ctes('doc_src', sections=False)}
SELECT accession_number, CAST(row_number() OVER (PARTITION BY accession_number ORDER BY s) - 1 AS INTEGER) AS piece_no,
       CAST(s AS INTEGER) AS piece_start, CAST(e AS INTEGER) AS piece_end, piece
FROM pieces""")
def x11_overlap_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = tables.read(spark, sf_dir, "documents").select(tables.accession_of("doc_id").alias("accession_number"), "text")
    return split_text(d, "text", ["accession_number"]).select(
        "accession_number", "piece_no", F.col("start").alias("piece_start"), F.col("end").alias("piece_end"), "piece")


# --- X10 + X11 + X12 + W1: chunks of every document ---------------------------
@register("x12_chunks", f"""
WITH RECURSIVE {O.doc_src()},
{O.split_ctes('doc_src')}
SELECT accession_number, chunk_index, section, content FROM chunks""")
def x12_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_corpus(spark, sf_dir, with_index=False).chunks.select(
        "accession_number", "chunk_index", "section", "content")


_BM25_BASE = f"""
WITH RECURSIVE {O.doc_src()},
{O.split_ctes('doc_src')},
{O.bm25_ctes()}"""


# --- K9: postings per chunk (tf, dl) and term statistics ----------------------
@register("k9_chunk_postings", _BM25_BASE + """
SELECT accession_number, chunk_index, CAST(max(dl) AS INTEGER) AS dl, count(*) AS n_terms, sum(tf) AS sum_tf,
       max(tf) AS max_tf
FROM post GROUP BY accession_number, chunk_index""")
def k9_chunk_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = doc_corpus(spark, sf_dir).index.postings
    return p.groupBy("accession_number", "chunk_index").agg(
        F.max("dl").alias("dl"), F.count(F.lit(1)).alias("n_terms"),
        F.sum("tf").alias("sum_tf"), F.max("tf").cast("long").alias("max_tf"))


@register("a7_term_stats", _BM25_BASE + """
SELECT term, df FROM tdf""")
def a7_term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_corpus(spark, sf_dir).index.terms.select("term", "df")


@register("a7_corpus_stats", _BM25_BASE + """
SELECT CAST(n AS BIGINT) AS n_chunks, round(avgdl, 6) AS avgdl FROM cstats""")
def a7_corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = doc_corpus(spark, sf_dir).index.corpus
    return c.select("n_chunks", F.round("avgdl", 6).alias("avgdl"))


# --- Q1: keyword search ---------------------------------------------------------
def _keyword_sql(query: str, k: int, ticker: str | None = None, form: str | None = None,
                 match_all: bool = False) -> str:
    filt = []
    if ticker:
        filt.append(f"f.ticker = {O.q(ticker.upper())}")
    if form:
        filt.append(f"f.form = {O.q(form.upper())}")
    need = "HAVING count(*) = (SELECT count(*) FROM qt)" if match_all else ""
    where = ("WHERE " + " AND ".join(filt)) if filt else ""
    return _BM25_BASE + f""",
{O.doc_filings_cte()},
qt AS (SELECT DISTINCT unnest({O.tokens(O.q(query))}) AS term),
sc AS (
  SELECT accession_number, chunk_index, sum({O.bm25_score()}) AS rank
  FROM post JOIN qt USING (term) JOIN tdf USING (term), cstats
  GROUP BY accession_number, chunk_index {need}
)
SELECT c.content, round(sc.rank, 6) AS rank, c.accession_number, c.chunk_index, {O.metadata_json('c', 'f')} AS metadata
FROM sc JOIN chunks c USING (accession_number, chunk_index) JOIN doc_filings f USING (accession_number)
{where}
ORDER BY round(sc.rank, 6) DESC, c.accession_number, c.chunk_index
LIMIT {k}"""


def _keyword_spark(query: str, k: int, ticker=None, form=None, match_all=False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = doc_corpus(spark, sf_dir)
        out = keyword.keyword_search(c.index, c.chunks, c.filings, query, k, ticker, form, match_all)
        return out.select("content", F.round("rank", 6).alias("rank"), "accession_number", "chunk_index", "metadata")
    return run


register("q1_keyword_any", _keyword_sql(KEYWORD_QUERY, TOP_K))(_keyword_spark(KEYWORD_QUERY, TOP_K))
register("q1_keyword_all", _keyword_sql(MATCH_ALL_QUERY, TOP_K, match_all=True))(
    _keyword_spark(MATCH_ALL_QUERY, TOP_K, match_all=True))
register("q1_keyword_filtered", _keyword_sql(KEYWORD_QUERY, TOP_K, ticker="en", form="src3"))(
    _keyword_spark(KEYWORD_QUERY, TOP_K, ticker="en", form="src3"))


# --- T3: keyword top-k for every benchmark query --------------------------------
@register("t3_keyword_batch", _BM25_BASE + f""",
qt AS (SELECT DISTINCT item_id AS query_id, unnest({O.tokens('text')}) AS term FROM benchmark),
sc AS (
  SELECT query_id, accession_number, chunk_index, sum({O.bm25_score()}) AS rank
  FROM post JOIN qt USING (term) JOIN tdf USING (term), cstats
  GROUP BY query_id, accession_number, chunk_index
),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(rank, 6) DESC, accession_number, chunk_index) AS rank_no
  FROM sc
)
SELECT query_id, CAST(rank_no AS INTEGER) AS rank_no, accession_number, chunk_index, round(rank, 6) AS rank
FROM rk WHERE rank_no <= 5""")
def t3_keyword_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = doc_corpus(spark, sf_dir)
    qs = tables.read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    out = keyword.keyword_search_batch(c.index, c.chunks, qs, top_k=5)
    return out.select("query_id", F.col("rank_no").cast("int").alias("rank_no"), "accession_number",
                      "chunk_index", F.round("rank", 6).alias("rank"))


# --- semantic: X16, X17, Q2, P15, T3 --------------------------------------------
_EMB_BASE = """
WITH e AS (
  SELECT concat('L', CAST(label AS VARCHAR)) AS accession_number, CAST(vec_id AS INTEGER) AS chunk_index,
         label, embedding FROM embeddings
),
dims AS (
  SELECT pos, avg(CAST(x AS DOUBLE)) AS m
  FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM e) GROUP BY pos
),
cen0 AS (SELECT list(CAST(m AS FLOAT) ORDER BY pos) AS v FROM dims),
cen AS (
  SELECT list_transform(v, lambda x: CAST(CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(v, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))) AS FLOAT)) AS v
  FROM cen0
)"""


def _cos_sql(a: str, b: str) -> str:
    dot = f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: CAST({a}[i] AS DOUBLE) * CAST({b}[i] AS DOUBLE)))"
    na = f"list_sum(list_transform({a}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))"
    nb = f"list_sum(list_transform({b}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))"
    return (f"(CASE WHEN {na} * {nb} = 0 THEN CAST('nan' AS DOUBLE) "
            f"ELSE 1 - least(greatest({dot} / sqrt({na} * {nb}), -1), 1) END)")


def _emb_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("L"), F.col("label").cast("string")).alias("accession_number"),
        F.col("vec_id").cast("int").alias("chunk_index"), "label", "embedding")


@register("x16_cosine_distance", _EMB_BASE + f"""
SELECT accession_number, chunk_index, round({_cos_sql('e.embedding', 'cen.v')}, 6) AS distance FROM e, cen""")
def x16_cosine_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.operators.semantic import centroid, semantic_scores
    ch = _emb_chunks(spark, sf_dir)
    return semantic_scores(ch.drop("label"), centroid(ch)).select(
        "accession_number", "chunk_index", F.round("distance", 6).alias("distance"))


@register("x17_l2_normalize", """
SELECT CAST(vec_id AS BIGINT) AS vec_id,
       list_transform(embedding, lambda x: CAST(CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))) AS FLOAT)) AS unit
FROM embeddings""")
def x17_l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.functions.vector import l2_normalize
    return tables.read(spark, sf_dir, "embeddings").select("vec_id", l2_normalize("embedding").alias("unit"))


@register("q2_semantic", _EMB_BASE + f""",
sc AS (SELECT accession_number, chunk_index, {_cos_sql('e.embedding', 'cen.v')} AS distance FROM e, cen)
SELECT accession_number, chunk_index, round(distance, 6) AS distance, round(1 - distance, 4) AS similarity
FROM sc ORDER BY round(distance, 6) ASC NULLS LAST, accession_number, chunk_index LIMIT {TOP_K}""")
def q2_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.operators.semantic import centroid, semantic_search
    from sheaf.plans.search import similarity
    ch = _emb_chunks(spark, sf_dir)
    top = semantic_search(ch.drop("label"), centroid(ch), TOP_K)
    return top.select("accession_number", "chunk_index", F.round("distance", 6).alias("distance"),
                      similarity(F.col("distance")).alias("similarity"))


@register("t3_semantic_batch", """
WITH e AS (
  SELECT concat('L', CAST(label AS VARCHAR)) AS accession_number, CAST(vec_id AS INTEGER) AS chunk_index,
         label, embedding FROM embeddings
),
dims AS (
  SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m
  FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM e) GROUP BY label, pos
),
q0 AS (SELECT label, list(CAST(m AS FLOAT) ORDER BY pos) AS v FROM dims GROUP BY label),
qv AS (
  SELECT CAST(label AS BIGINT) AS query_id,
         list_transform(v, lambda x: CAST(CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(v, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))) AS FLOAT)) AS v
  FROM q0
),
sc AS (SELECT query_id, accession_number, chunk_index, """ + _cos_sql("e.embedding", "qv.v") + """ AS distance FROM e, qv),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 6) ASC NULLS LAST, accession_number, chunk_index) AS rank_no FROM sc)
SELECT query_id, CAST(rank_no AS INTEGER) AS rank_no, accession_number, chunk_index, round(distance, 6) AS distance
FROM rk WHERE rank_no <= 5""")
def t3_semantic_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.functions.vector import l2_normalize
    from sheaf.operators.semantic import semantic_search_batch
    ch = _emb_chunks(spark, sf_dir)
    per_dim = (ch.select("label", F.posexplode("embedding").alias("pos", "x"))
               .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m")))
    qs = per_dim.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"].cast("float")).alias("v"))
    qs = qs.select(F.col("label").cast("long").alias("query_id"), l2_normalize("v").alias("vec"))
    out = semantic_search_batch(ch.drop("label"), qs, top_k=5)
    return out.select("query_id", "rank_no", "accession_number", "chunk_index", F.round("distance", 6).alias("distance"))


# --- HTML extraction: X1-X9 -------------------------------------------------------
@register("x6_html_blocks", f"""
WITH {O.pages_src()},
{O.html_ctes('pg_src')}
SELECT accession_number, CAST(block_no AS BIGINT) AS block_no, txt AS text FROM blocks""")
def x6_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.operators.html import extract_blocks
    return extract_blocks(tables.page_html(spark, sf_dir)).select(
        "accession_number", F.col("block_no").cast("long").alias("block_no"), "text")


@register("x5_html_tables", f"""
WITH {O.filing_html_src()},
{O.html_ctes('fh_src')}
SELECT accession_number, CAST(table_no AS BIGINT) AS table_no, txt AS text FROM tbls WHERE txt <> ''""")
def x5_html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.operators.html import extract_tables
    return extract_tables(tables.filing_html(spark, sf_dir)).select(
        "accession_number", F.col("table_no").cast("long").alias("table_no"), "text")


@register("x9_html_text", f"""
WITH {O.filing_html_src()},
{O.html_ctes('fh_src')}
SELECT accession_number, text FROM doc_text""")
def x9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.operators.html import extract_text
    return extract_text(tables.filing_html(spark, sf_dir))


@register("x10_sections", f"""
WITH RECURSIVE {O.filing_html_src()},
{O.html_ctes('fh_src')},
{O.split_ctes('doc_text')}
SELECT accession_number, CAST(sec_no AS INTEGER) AS section_no, section, txt AS section_text FROM secs""")
def x10_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.operators.chunk import sections
    from sheaf.operators.html import extract_text
    return sections(extract_text(tables.filing_html(spark, sf_dir)), "text", ["accession_number"])


# --- events: S2, S3, J2, P1, P9 ----------------------------------------------------
def _event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event JSON built from ``filing_events``; every 11th has a wrong type,
    every 13th lacks ``document_url``, every 17th is not JSON, every 19th has a
    bad date."""
    ev = tables.filing_events(spark, sf_dir)
    k = F.regexp_extract("local_path", r"/data/(\d+)\.htm", 1).cast("long")
    obj = F.struct(
        F.when(k % 11 == 0, F.lit("filing.updated")).otherwise(F.lit("filing.downloaded")).alias("event_type"),
        F.lit(1).alias("schema_version"), "ticker", "company_name",
        F.when(k % 19 == 0, F.lit("2024-13-45")).otherwise(F.date_format("filing_date", "yyyy-MM-dd")).alias("filing_date"),
        "form", "accession_number", "local_path",
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("document_url")).alias("document_url"),
        F.date_format("downloaded_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("downloaded_at"))
    value = F.when(k % 17 == 0, F.concat(F.lit("{not json "), k.cast("string"))).otherwise(F.to_json(obj))
    return ev.select(k.alias("event_no"), value.alias("value"))


_EVENT_JSON_SQL = O.filing_events_cte() + """,
ej AS (
  SELECT page_id AS event_no,
    CASE WHEN page_id % 17 = 0 THEN concat('{not json ', CAST(page_id AS VARCHAR)) ELSE
      '{"event_type":' || to_json(CASE WHEN page_id % 11 = 0 THEN 'filing.updated' ELSE 'filing.downloaded' END)
      || ',"schema_version":1,"ticker":' || to_json(ticker) || ',"company_name":' || to_json(company_name)
      || ',"filing_date":' || to_json(CASE WHEN page_id % 19 = 0 THEN '2024-13-45' ELSE strftime(filing_date, '%Y-%m-%d') END)
      || ',"form":' || to_json(form) || ',"accession_number":' || to_json(accession_number)
      || ',"local_path":' || to_json(local_path)
      || CASE WHEN page_id % 13 = 0 THEN '' ELSE ',"document_url":' || to_json(document_url) END
      || ',"downloaded_at":' || to_json(strftime(downloaded_at, '%Y-%m-%dT%H:%M:%S.%fZ')) || '}'
    END AS value
  FROM fe
)"""

_FIELDS = ("event_type", "schema_version", "ticker", "company_name", "filing_date", "form", "accession_number",
           "local_path", "document_url", "downloaded_at")


def _validate_sql(src: str) -> str:
    missing = "concat_ws(', ', " + ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in _FIELDS) + ")"
    return f"""
SELECT event_no, CASE
    WHEN NOT is_obj THEN 'malformed json'
    WHEN {missing} <> '' THEN 'missing field: ' || {missing}
    WHEN event_type <> 'filing.downloaded' THEN 'unsupported event_type: ' || event_type
    WHEN TRY_CAST(schema_version AS INTEGER) IS NULL THEN 'invalid schema_version'
    WHEN try_strptime(filing_date, '%Y-%m-%d') IS NULL THEN 'invalid filing_date'
    WHEN TRY_CAST(downloaded_at AS TIMESTAMP) IS NULL THEN 'invalid downloaded_at' END AS reject_reason,
  ticker, accession_number, form
FROM {src}"""


@register("s3_event_validation", "WITH " + _EVENT_JSON_SQL + """,
raw AS (
  SELECT event_no, CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END AS is_obj,
""" + ",\n".join(f"    CASE WHEN json_valid(value) THEN (CASE WHEN json_type(value) = 'OBJECT' THEN json_extract_string(value, '$.{f}') END) END AS {f}"
                 for f in _FIELDS) + """
  FROM ej
),
v AS (""" + _validate_sql("raw") + """)
SELECT event_no, reject_reason IS NULL AS valid, reject_reason, ticker, accession_number, form FROM v""")
def s3_event_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.sources.events import parse_events
    ev = parse_events(_event_json(spark, sf_dir), "value", ["event_no"])
    return ev.select("event_no", "valid", "reject_reason", "ticker", "accession_number", "form")


@register("j2_enrich", "WITH " + O.filing_events_cte() + """,
meta AS (
  SELECT accession_number, ticker, company_name, form, filing_date, concat('/data/meta', local_path) AS local_path,
         CASE WHEN ticker = 'TK3' THEN NULL ELSE document_url END AS document_url, downloaded_at
  FROM fe WHERE right(accession_number, 1) <> '0'
),
j AS (
  SELECT f.accession_number, m.accession_number IS NOT NULL AS enriched,
         CASE WHEN m.accession_number IS NOT NULL THEN m.local_path ELSE f.local_path END AS local_path,
         CASE WHEN m.accession_number IS NOT NULL THEN m.document_url ELSE f.document_url END AS document_url
  FROM fe f LEFT JOIN meta m ON m.accession_number = f.accession_number
)
SELECT accession_number, enriched, local_path, document_url, document_url IS NOT NULL AS valid,
       CASE WHEN document_url IS NULL THEN 'missing field: document_url' END AS reject_reason
FROM j""")
def j2_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.sources.events import enrich, typed_rows
    ev = typed_rows(tables.filing_events(spark, sf_dir))
    out = enrich(ev, tables.filing_metadata(spark, sf_dir))
    return out.select("accession_number", "enriched", "local_path", "document_url", "valid", "reject_reason")


@register("p9_forms", "WITH " + O.filing_events_cte() + """,
v AS (
  SELECT accession_number, form AS raw FROM fe
  UNION ALL SELECT accession_number, lower(replace(form, '-', ' ')) FROM fe
),
c AS (
  SELECT accession_number, raw,
         replace(replace(replace(replace(upper(""" + O.strip("raw") + """), ' ', ''), '10Q', '10-Q'), '10K', '10-K'), '8K', '8-K') AS canonical
  FROM v
)
SELECT accession_number, raw, canonical, canonical IN ('10-K', '10-Q', '8-K') AS supported,
       upper(raw) IN ('10-K', '10-Q', '10-K/A', '10-Q/A') AS allowed
FROM c""")
def p9_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.config import DEFAULT_ALLOWED_FORMS, FORM_SELECTIONS
    from sheaf.functions.text import canonical_form_col
    ev = tables.filing_events(spark, sf_dir)
    v = ev.select("accession_number", F.col("form").alias("raw")).unionByName(
        ev.select("accession_number", F.lower(F.regexp_replace("form", "-", " ")).alias("raw")))
    c = v.withColumn("canonical", canonical_form_col("raw"))
    return c.select("accession_number", "raw", "canonical", F.col("canonical").isin(*FORM_SELECTIONS).alias("supported"),
                    F.upper("raw").isin(*[f.upper() for f in DEFAULT_ALLOWED_FORMS]).alias("allowed"))


# --- Q6 ingest outcomes, A3 load report ----------------------------------------------
def _ingest_sql(force: bool) -> str:
    allowed = "('10-K', '10-Q', '10-K/A', '10-Q/A')"
    return f"""
WITH RECURSIVE {O.ingest_events_cte()},
{O.filing_html_src()},
{O.html_ctes('fh_src')},
{O.split_ctes('doc_text')},
nch AS (SELECT accession_number, count(*) AS n FROM chunks GROUP BY accession_number),
fs AS (SELECT regexp_replace(local_path, '/data/\\.\\./', '/') AS p, * FROM iev),
st AS (
  SELECT fs.event_no, fs.accession_number, fs.ticker,
    CASE WHEN upper(form) NOT IN {allowed} THEN 'skipped'
         WHEN NOT starts_with(p, '/data/') THEN 'failed'
         WHEN starts_with(p, '/data/missing/') THEN 'failed'
         WHEN trim(d.text) = '' THEN 'failed'
         WHEN coalesce(nch.n, 0) = 0 THEN 'failed' ELSE 'loaded' END AS status,
    CASE WHEN upper(form) NOT IN {allowed} THEN 'form not allowed'
         WHEN NOT starts_with(p, '/data/') THEN 'outside data folder'
         WHEN starts_with(p, '/data/missing/') THEN 'file not found'
         WHEN trim(d.text) = '' THEN 'no extractable text'
         WHEN coalesce(nch.n, 0) = 0 THEN 'no chunks' END AS reason,
    CASE WHEN upper(form) IN {allowed} AND starts_with(p, '/data/') AND NOT starts_with(p, '/data/missing/')
         THEN coalesce(nch.n, 0) ELSE 0 END AS chunk_count
  FROM fs LEFT JOIN doc_text d ON d.accession_number = fs.accession_number
          LEFT JOIN nch ON nch.accession_number = fs.accession_number
)"""


@register("q6_ingest_outcomes", _ingest_sql(False) + """
SELECT CAST(event_no AS BIGINT) AS event_no, accession_number, ticker, status, reason,
       CAST(chunk_count AS INTEGER) AS chunk_count
FROM st""")
def q6_ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.plans.ingest import ingest
    from sheaf.sources.events import typed_rows
    ev = typed_rows(tables.ingest_events(spark, sf_dir), ["event_no"])
    res = ingest(ev, tables.filing_documents(spark, sf_dir), base_dir="/data")
    return res.outcomes.select("event_no", "accession_number", "ticker", "status", "reason", "chunk_count")


@register("a3_load_report", _ingest_sql(True) + """,
fails AS (
  SELECT ticker, accession_number || ': ' || reason AS m,
         row_number() OVER (PARTITION BY ticker ORDER BY event_no) AS n
  FROM st WHERE status = 'failed'
)
SELECT s.ticker, count(*) AS found,
       CAST(sum(CASE WHEN status = 'loaded' THEN 1 ELSE 0 END) AS BIGINT) AS processed,
       CAST(sum(CASE WHEN status = 'skipped' THEN 1 ELSE 0 END) AS BIGINT) AS skipped,
       CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       CAST(sum(CASE WHEN status = 'loaded' THEN chunk_count ELSE 0 END) AS BIGINT) AS total_chunks,
       coalesce((SELECT list(m ORDER BY n) FROM fails f WHERE f.ticker = s.ticker AND n <= 20), []) AS errors
FROM st s GROUP BY s.ticker""")
def a3_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.plans.ingest import ingest, load_report
    from sheaf.sources.events import typed_rows
    ev = typed_rows(tables.ingest_events(spark, sf_dir), ["event_no"])
    res = ingest(ev, tables.filing_documents(spark, sf_dir), base_dir="/data", skip_if_processed=False)
    return load_report(res.outcomes)


# --- quality and store views: A1, A2, A6, J5, A9, T4, K2/K3/K7 view, P18 ------------------
_CHUNK_BASE = f"""
WITH RECURSIVE {O.doc_src()},
{O.split_ctes('doc_src')},
{O.doc_filings_cte()}"""


@register("a2_chunks_per_filing", _CHUNK_BASE + """
SELECT accession_number, count(*) AS n_chunks FROM chunks GROUP BY accession_number""")
def a2_chunks_per_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.plans.quality import chunks_per_filing
    return chunks_per_filing(doc_corpus(spark, sf_dir, with_index=False).chunks)


@register("a1_q4_stats", _CHUNK_BASE + """
SELECT (SELECT count(*) FROM doc_filings) AS filing_count, (SELECT count(*) FROM chunks) AS chunk_count,
       true AS bm25_ready""")
def a1_q4_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.operators.keyword import lengths_of
    from sheaf.plans.quality import index_ready
    from sheaf.plans.search import stats
    c = doc_corpus(spark, sf_dir, with_index=False)
    return stats(c.filings, c.chunks, index_ready(lengths_of(c.chunks), c.chunks))


@register("a6_j5_key_checks", _CHUNK_BASE + """
SELECT 'filing_chunks' AS check_name, CAST(count(*) AS BIGINT) AS violations FROM (
  SELECT accession_number, chunk_index FROM chunks GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'filings', CAST(count(*) AS BIGINT) FROM (
  SELECT accession_number FROM doc_filings GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orphans', CAST(count(*) AS BIGINT) FROM chunks c
  WHERE NOT EXISTS (SELECT 1 FROM doc_filings f WHERE f.accession_number = c.accession_number)""")
def a6_j5_key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.plans.quality import duplicate_keys, orphan_chunks
    c = doc_corpus(spark, sf_dir, with_index=False)
    a = duplicate_keys(c.chunks, ["accession_number", "chunk_index"]).agg(F.count(F.lit(1)).alias("violations"))
    b = duplicate_keys(c.filings, ["accession_number"]).agg(F.count(F.lit(1)).alias("violations"))
    o = orphan_chunks(c.chunks, c.filings).agg(F.count(F.lit(1)).alias("violations"))
    return (a.select(F.lit("filing_chunks").alias("check_name"), "violations")
            .unionByName(b.select(F.lit("filings").alias("check_name"), "violations"))
            .unionByName(o.select(F.lit("orphans").alias("check_name"), "violations")))


@register("t4_latest_filings", "WITH " + O.doc_filings_cte() + """
SELECT accession_number, ticker, form, strftime(filing_date, '%Y-%m-%d') AS filing_date FROM doc_filings
ORDER BY filing_date DESC, accession_number LIMIT 10""")
def t4_latest_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.plans.quality import latest_filings
    return latest_filings(tables.doc_filings(spark, sf_dir)).select(
        "accession_number", "ticker", "form", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"))


@register("k2_current_view", _CHUNK_BASE + """,
cnt AS (SELECT accession_number, count(*) AS n FROM chunks GROUP BY 1),
v AS (
  SELECT f.accession_number, 1 AS batch_id, TIMESTAMP '2024-01-01 00:00:00' AS processed_at, false AS deleted,
         CAST(c.n AS INTEGER) AS chunk_count FROM doc_filings f JOIN cnt c USING (accession_number)
  UNION ALL
  SELECT f.accession_number, 2, TIMESTAMP '2024-02-01 00:00:00', false, CAST(c.n + 1 AS INTEGER)
  FROM doc_filings f JOIN cnt c USING (accession_number) WHERE f.ticker = 'EN'
  UNION ALL
  SELECT accession_number, 3, TIMESTAMP '2024-03-01 00:00:00', true, 0 FROM doc_filings WHERE form = 'SRC0'
),
cur AS (SELECT accession_number, arg_max(struct_pack(batch_id := batch_id, deleted := deleted, chunk_count := chunk_count),
                                         struct_pack(p := processed_at, b := batch_id)) AS s FROM v GROUP BY 1)
SELECT accession_number, CAST(s.batch_id AS BIGINT) AS batch_id, s.chunk_count AS chunk_count FROM cur WHERE NOT s.deleted""")
def k2_current_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/K3/K7 view logic over three in-memory versions: everything, a
    re-upsert of ticker EN, and tombstones for form SRC0."""
    from sheaf.plans.quality import chunks_per_filing
    from sheaf.plans.store import current_filings
    c = doc_corpus(spark, sf_dir, with_index=False)
    n = chunks_per_filing(c.chunks)
    base = c.filings.join(n, "accession_number").select("accession_number", "ticker", "form", "n_chunks")
    v1 = base.select("accession_number", F.lit(1).cast("long").alias("batch_id"),
                     F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_at"), F.lit(False).alias("deleted"),
                     F.col("n_chunks").cast("int").alias("chunk_count"))
    v2 = base.filter(F.col("ticker") == "EN").select(
        "accession_number", F.lit(2).cast("long").alias("batch_id"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("processed_at"), F.lit(False).alias("deleted"),
        (F.col("n_chunks") + 1).cast("int").alias("chunk_count"))
    v3 = c.filings.filter(F.col("form") == "SRC0").select(
        "accession_number", F.lit(3).cast("long").alias("batch_id"),
        F.lit("2024-03-01 00:00:00").cast("timestamp").alias("processed_at"), F.lit(True).alias("deleted"),
        F.lit(0).alias("chunk_count"))
    cur = current_filings(v1.unionByName(v2).unionByName(v3))
    return cur.select("accession_number", "batch_id", "chunk_count")


@register("p18_vector_check", """
SELECT count(*) AS n_vectors, max(len(embedding)) AS dim,
       CAST(sum(CASE WHEN len(embedding) <> 64 THEN 1 ELSE 0 END) AS BIGINT) AS bad_length FROM embeddings""")
def p18_vector_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.plans.quality import vector_check
    return vector_check(tables.read(spark, sf_dir, "embeddings"), 64)


# --- ingest outputs and store views through written tables -------------------------------
def _ingested(spark: SparkSession, sf_dir: str, twice: bool = False, done: DataFrame | None = None):
    from sheaf.plans.ingest import ingest
    from sheaf.sources.events import typed_rows
    ev = tables.ingest_events(spark, sf_dir)
    if twice:
        ev = ev.unionByName(ev.withColumn("event_no", F.col("event_no") + 1_000_000_000))
    return ingest(typed_rows(ev, ["event_no"]), tables.filing_documents(spark, sf_dir), base_dir="/data", current_filings=done)


@register("q6_filings", _ingest_sql(False) + """
SELECT accession_number, ticker, CAST(chunk_count AS INTEGER) AS chunk_count FROM st WHERE status = 'loaded'""")
def q6_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the filings rows that a batch writes."""
    return _ingested(spark, sf_dir).filings.select("accession_number", "ticker", "chunk_count")


@register("q6_chunks", _ingest_sql(False) + """
SELECT c.accession_number, c.chunk_index, c.section, c.content FROM chunks c JOIN st USING (accession_number)
WHERE status = 'loaded'""")
def q6_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the chunk rows that a batch writes."""
    return _ingested(spark, sf_dir).chunks.select("accession_number", "chunk_index", "section", "content")


@register("j3_skip_processed", _ingest_sql(False) + """
SELECT CAST(event_no AS BIGINT) AS event_no, CASE WHEN event_no % 10 = 0 THEN 'skipped' ELSE status END AS status,
       CASE WHEN event_no % 10 = 0 THEN 'already processed' ELSE reason END AS reason FROM st""")
def j3_skip_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth filing is stored already."""
    done = tables.ingest_events(spark, sf_dir).filter("event_no % 10 = 0").select("accession_number")
    return _ingested(spark, sf_dir, done=done).outcomes.select("event_no", "status", "reason")


@register("w4_duplicates", _ingest_sql(False) + """
SELECT CAST(event_no AS BIGINT) AS event_no, status, reason, CAST(chunk_count AS INTEGER) AS chunk_count FROM st
UNION ALL
SELECT CAST(event_no AS BIGINT) + 1000000000, CASE WHEN status = 'loaded' THEN 'skipped' ELSE status END,
       CASE WHEN status = 'loaded' THEN 'duplicate in batch' ELSE reason END,
       CASE WHEN status = 'loaded' THEN 0 ELSE CAST(chunk_count AS INTEGER) END FROM st""")
def w4_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event comes twice in one batch."""
    return _ingested(spark, sf_dir, twice=True).outcomes.select("event_no", "status", "reason", "chunk_count")


def _written_store(spark: SparkSession, sf_dir: str):
    """Every document's filing and chunks as one batch, then tombstones for form SRC0."""
    from sheaf.plans.quality import chunks_per_filing
    from sheaf.plans.store import FilingStore
    from sheaf.session import ensure_checkpoint_dir
    c = doc_corpus(spark, sf_dir, with_index=False)
    store = FilingStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheaf-store-{uuid.uuid4().hex}")
    batch = F.lit(1).cast("long").alias("batch_id")
    filings = c.filings.join(chunks_per_filing(c.chunks), "accession_number").select(
        "*", F.col("n_chunks").cast("int").alias("chunk_count"), F.lit(False).alias("deleted"), batch,
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_at"))
    store.write_batch(filings, c.chunks.select("*", batch))
    store.delete(c.filings.filter("form = 'SRC0'").select("accession_number"))
    return store


@register("k3_current_chunks", _CHUNK_BASE + """
SELECT c.accession_number, c.chunk_index, c.section, c.content FROM chunks c JOIN doc_filings f USING (accession_number)
WHERE f.form IS DISTINCT FROM 'SRC0'""")
def k3_current_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk view of a store after a batch and tombstones."""
    return _written_store(spark, sf_dir).chunks().select("accession_number", "chunk_index", "section", "content")


@register("a5_index_ready", _CHUNK_BASE + """
SELECT count(*) AS chunk_count, count(DISTINCT f.accession_number) AS filing_count, true AS bm25_ready
FROM chunks c JOIN doc_filings f USING (accession_number) WHERE f.form IS DISTINCT FROM 'SRC0'""")
def a5_index_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, Q4: counts and computed readiness of a store whose index lives with it."""
    from sheaf.plans.search import stats
    store = _written_store(spark, sf_dir)
    return stats(store.filings(), store.chunks(), store.index_ready()).select("chunk_count", "filing_count", "bm25_ready")


@register("k9_store_postings", _BM25_BASE + ",\n" + O.doc_filings_cte() + """
SELECT p.term, count(*) AS df, CAST(sum(p.tf) AS BIGINT) AS tf FROM post p JOIN doc_filings f USING (accession_number)
WHERE f.form IS DISTINCT FROM 'SRC0' GROUP BY p.term""")
def k9_store_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 as the store keeps it: term statistics after deletes, nothing rebuilt."""
    found = _written_store(spark, sf_dir).keyword_index().postings
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("tf"))


@register("x15_metadata_roundtrip", _CHUNK_BASE + """
SELECT accession_number, chunk_index, section FROM chunks""")
def x15_metadata_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata text decoded again."""
    from sheaf.functions.meta import parse_metadata
    c = doc_corpus(spark, sf_dir, with_index=False).chunks
    return c.select("accession_number", "chunk_index", parse_metadata("metadata")["section"].alias("section"))


# --- S8, A9, P2, P19 ----------------------------------------------------------------------
@register("s8_metadata_for_ticker", "WITH " + O.filing_events_cte() + """
SELECT accession_number, form FROM fe
WHERE ticker = 'TK1' AND form IN ('10-K', '10-Q') AND accession_number NOT LIKE '%0'""")
def s8_metadata_for_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.sources.events import metadata_for_ticker
    return metadata_for_ticker(tables.filing_metadata(spark, sf_dir), "tk1", ["10-k", "10-q"]).select("accession_number", "form")


@register("a9_chunk_count_mismatch", _CHUNK_BASE + """,
n AS (SELECT accession_number, count(*) AS n FROM chunks GROUP BY 1)
SELECT f.accession_number, CAST(coalesce(n.n, 0) + 1 AS INTEGER) AS chunk_count, CAST(coalesce(n.n, 0) AS BIGINT) AS n_chunks
FROM doc_filings f LEFT JOIN n USING (accession_number) WHERE f.ticker = 'FR'""")
def a9_chunk_count_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filings of ticker FR claim one chunk too many."""
    from sheaf.plans.quality import chunk_count_mismatch, chunks_per_filing
    c = doc_corpus(spark, sf_dir, with_index=False)
    claimed = c.filings.join(chunks_per_filing(c.chunks), "accession_number", "left").select(
        "accession_number", (F.coalesce("n_chunks", F.lit(0)) + (F.col("ticker") == "FR").cast("int")).cast("int").alias("chunk_count"))
    return chunk_count_mismatch(claimed, c.chunks).select("accession_number", "chunk_count", F.col("n_chunks").cast("long"))


@register("p2_allow_list", """
SELECT doc_id, array_to_string(list_filter(list_transform(string_split(concat(' ', lang, ' , ', source, ',, ', upper(lang)), ','),
       lambda x: trim(x)), lambda x: x <> ''), '|') AS allowed FROM documents""")
def p2_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.functions.text import allow_list_col
    d = tables.read(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit(" "), "lang", F.lit(" , "), "source", F.lit(",, "), F.upper("lang")).alias("v"))
    return d.select("doc_id", F.array_join(allow_list_col("v"), "|").alias("allowed"))


@register("p19_model_dimension", """
SELECT source, CASE CAST(substr(source, 4) AS INTEGER) % 5 WHEN 0 THEN 1024 WHEN 1 THEN 384 WHEN 2 THEN 768 WHEN 3 THEN 1024 ELSE 0 END AS dim,
       count(*) AS docs FROM documents WHERE source IS NOT NULL GROUP BY 1, 2""")
def p19_model_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P19 over a model name per source."""
    from sheaf.plans.quality import model_dimension
    names = F.array(*[F.lit(x) for x in ("Org/BGE-M3", "org/bge-small-en", "bge-base-v1", "org/bge-large", "other")])
    d = tables.read(spark, sf_dir, "documents").filter("source IS NOT NULL").select(
        "source", F.get(names, F.substring("source", 4, 9).cast("int") % 5).alias("model"))
    return d.groupBy("source", model_dimension("model").alias("dim")).agg(F.count(F.lit(1)).alias("docs"))


# --- the store after batches, replacements, deletes and merges: K2, K9, Q1, J3 ---------------------------
def _shared_folder(spark: SparkSession, name: str) -> str:
    from sheaf.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheaf-{name}-{uuid.uuid4().hex}"


def _merged_store(spark: SparkSession, sf_dir: str):
    """A third of the filings in an earlier wording, all filings in three batches, tombstones for form
    SRC0, then a merge of the finished batches."""
    from sheaf.plans.layout import stored
    from sheaf.plans.quality import chunks_per_filing
    from sheaf.plans.store import FilingStore
    c = doc_corpus(spark, sf_dir, with_index=False)
    chunks = stored(c.chunks, "chunks")
    part = F.pmod(F.xxhash64("accession_number"), F.lit(3)).cast("int")
    filings = c.filings.join(chunks_per_filing(chunks), "accession_number").select(
        "*", F.col("n_chunks").cast("int").alias("chunk_count"), F.lit(False).alias("deleted"), part.alias("part"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_at"))
    chunks = chunks.withColumn("part", part)
    store = FilingStore(spark, _shared_folder(spark, "store"))
    old = chunks.filter("part = 0").withColumn("content", F.concat(F.lit("superseded wording "), "content"))
    for batch, (f, k) in enumerate([(filings.filter("part = 0"), old)] + [(filings.filter(f"part = {p}"), chunks.filter(f"part = {p}")) for p in range(3)]):
        no = F.lit(batch).cast("long").alias("batch_id")
        store.write_batch(f.select("*", no), k.select("*", no), "loader", batch)
    store.delete(c.filings.filter("form = 'SRC0'").select("accession_number"))
    store.merge(2)
    return store


_LIVE_BASE = f"""
WITH RECURSIVE {O.doc_src()},
{O.split_ctes('doc_src')},
{O.doc_filings_cte()},
live AS (SELECT c.* FROM chunks c JOIN doc_filings f USING (accession_number) WHERE f.form IS DISTINCT FROM 'SRC0'),
{O.bm25_ctes('live')}"""


@register("k9_store_merged", _LIVE_BASE + """
SELECT p.term, max(t.df) AS df, CAST(sum(p.tf) AS BIGINT) AS tf, max(CAST(s.n AS BIGINT)) AS n_chunks, round(max(s.avgdl), 6) AS avgdl
FROM post p JOIN tdf t USING (term), cstats s GROUP BY p.term""")
def k9_store_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of the current versions and statistics from changes, after batches, deletes and a merge."""
    index = _merged_store(spark, sf_dir).keyword_index()
    tf = index.postings.groupBy("term").agg(F.sum("tf").cast("long").alias("tf"))
    return tf.join(index.terms, "term").crossJoin(F.broadcast(index.corpus)).select(
        "term", "df", "tf", "n_chunks", F.round("avgdl", 6).alias("avgdl"))


def _store_keyword_sql(query: str, k: int, ticker: str | None = None) -> str:
    where = f"WHERE f.ticker = {O.q(ticker.upper())}" if ticker else ""
    return _LIVE_BASE + f""",
qt AS (SELECT DISTINCT unnest({O.tokens(O.q(query))}) AS term),
sc AS (SELECT accession_number, chunk_index, sum({O.bm25_score()}) AS rank FROM post JOIN qt USING (term) JOIN tdf USING (term), cstats
       GROUP BY accession_number, chunk_index)
SELECT c.content, round(sc.rank, 6) AS rank, c.accession_number, c.chunk_index
FROM sc JOIN chunks c USING (accession_number, chunk_index) JOIN doc_filings f USING (accession_number)
{where}
ORDER BY round(sc.rank, 6) DESC, c.accession_number, c.chunk_index LIMIT {k}"""


def _store_keyword(query: str, k: int, ticker: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Q1, X19, T1 on the stored index: block-max pruning, the terms' buckets only."""
        out = _merged_store(spark, sf_dir).keyword_search(query, k, ticker)
        return out.select("content", F.round("rank", 6).alias("rank"), "accession_number", "chunk_index")
    return run


register("q1_store_any", _store_keyword_sql(KEYWORD_QUERY, TOP_K))(_store_keyword(KEYWORD_QUERY, TOP_K))
register("q1_store_filtered", _store_keyword_sql(MATCH_ALL_QUERY, TOP_K, "en"))(_store_keyword(MATCH_ALL_QUERY, TOP_K, "en"))


@register("j3_store_processed", _CHUNK_BASE + """,
has AS (SELECT DISTINCT accession_number FROM chunks)
SELECT f.accession_number FROM doc_filings f JOIN has USING (accession_number) WHERE f.form IS DISTINCT FROM 'SRC0' AND f.ticker = 'FR'""")
def j3_store_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which filings of ticker FR are current, from their buckets' versions."""
    store = _merged_store(spark, sf_dir)
    return store.processed(tables.doc_filings(spark, sf_dir).filter("ticker = 'FR'").select("accession_number"))


# --- documents by path: S6, J4 ----------------------------------------------------------------------------
def _document_files(spark: SparkSession, sf_dir: str):
    from sheaf.sources.documents import DocumentFiles, write_documents
    folder = _shared_folder(spark, "documents")
    write_documents(tables.filing_documents(spark, sf_dir), "/data", folder)
    return DocumentFiles(spark, "/data", folder)


@register("j4_fetch", f"""
WITH {O.ingest_events_cte()},
{O.filing_html_src()}
SELECT e.local_path AS path, CAST(length(h.html) AS INTEGER) AS n_chars, md5(h.html) AS html_md5
FROM iev e JOIN fh_src h USING (accession_number)
WHERE e.form IN ('10-K', '10-K/A') AND NOT starts_with(e.local_path, '/data/..') AND NOT starts_with(e.local_path, '/data/missing')""")
def j4_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all documents in a folder, those that the events of two forms want are opened."""
    from sheaf.functions.paths import inside, normalize_path
    files = _document_files(spark, sf_dir)
    wanted = tables.ingest_events(spark, sf_dir).filter(F.col("form").isin("10-K", "10-K/A")).select(normalize_path("local_path").alias("path"))
    got = files.fetch(wanted.filter(inside(F.col("path"), "/data")))
    return got.select("path", F.length("html").alias("n_chars"), F.md5("html").alias("html_md5"))


@register("j4_ingest_by_path", ORACLE["q6_ingest_outcomes"])
def j4_ingest_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 with documents that are opened by path."""
    from sheaf.plans.ingest import ingest
    from sheaf.sources.events import typed_rows
    ev = typed_rows(tables.ingest_events(spark, sf_dir), ["event_no"])
    res = ingest(ev, _document_files(spark, sf_dir), base_dir="/data")
    return res.outcomes.select("event_no", "accession_number", "ticker", "status", "reason", "chunk_count")


# --- Q3 with its echo fields, P12, P16, P17 ----------------------------------------------------------------
@register("q3_search_reply", _keyword_sql(KEYWORD_QUERY, TOP_K, ticker="en").replace("SELECT c.content,", f"""
SELECT {O.q(KEYWORD_QUERY)} AS query, 'keyword' AS mode, {TOP_K} AS top_k, CAST(count(*) OVER () AS INTEGER) AS count,
       CAST(row_number() OVER (ORDER BY rank DESC, accession_number, chunk_index) AS INTEGER) AS place, accession_number, chunk_index, rank
FROM (SELECT round(sc.rank, 6) AS by_rank, c.content,""").replace("round(sc.rank, 6) AS rank,", "round(sc.rank, 4) AS rank,") + ")")
def q3_search_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: the reply of a request with blanks and capitals, its result rows numbered."""
    from sheaf.plans.search import search_reply
    c = doc_corpus(spark, sf_dir)
    reply = search_reply(f"  {KEYWORD_QUERY} ", c.chunks, c.filings, c.index, top_k=TOP_K, ticker="en", mode=" Keyword ")
    rows = reply.select("query", "mode", "top_k", "count", F.posexplode("results").alias("place", "r"))
    return rows.select("query", "mode", "top_k", "count", (F.col("place") + 1).alias("place"), "r.accession_number", "r.chunk_index", "r.rank")


# --- S4, S5, W3, Q5, K5, K6, A4 ------------------------------------------------------------------------------
@register("s4_event_files", ORACLE["s3_event_validation"])
def s4_event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per file."""
    from sheaf.sources.documents import write_documents
    from sheaf.sources.events import read_event_files
    folder = _shared_folder(spark, "events")
    ev = _event_json(spark, sf_dir).select(F.concat(F.lit("/events/"), F.col("event_no").cast("string"), F.lit(".json")).alias("path"),
                                           F.col("value").alias("html"))
    write_documents(ev, "/events", folder)
    no = F.regexp_extract("path", r"(\d+)\.json$", 1).cast("long").alias("event_no")
    return read_event_files(spark, folder).select(no, "valid", "reject_reason", "ticker", "accession_number", "form")


@register("s5_manifest", "WITH " + O.filing_events_cte() + """
SELECT accession_number, true AS valid, CASE WHEN ticker = 'TK1' THEN '' ELSE document_url END AS document_url,
       '2026-01-01T00:00:00Z' AS downloaded_at FROM fe""")
def s5_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest without download times and without some addresses."""
    from sheaf.sources.events import from_manifest
    url = F.when(F.col("ticker") != "TK1", F.col("document_url")).alias("document_url")
    rows = from_manifest(tables.filing_events(spark, sf_dir).select("accession_number", "ticker", "company_name", "form", "filing_date", "local_path", url))
    return rows.select("accession_number", "valid", "document_url", F.date_format("downloaded_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("downloaded_at"))


@register("w3_first_metadata", "WITH " + O.filing_events_cte() + """,
m AS (SELECT accession_number, ticker, form FROM fe UNION ALL SELECT accession_number, 'AAA', form FROM fe WHERE form = '10-K'
      UNION ALL SELECT accession_number, ticker, '0' FROM fe WHERE form = '10-Q')
SELECT accession_number, min(ticker) AS ticker, min(form) AS form FROM m GROUP BY accession_number""")
def w3_first_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several documents of one accession number the smallest row."""
    from sheaf.sources.events import first_metadata
    fe = tables.filing_events(spark, sf_dir).select("accession_number", "ticker", "form")
    more = fe.filter("form = '10-K'").withColumn("ticker", F.lit("AAA")).unionByName(fe.filter("form = '10-Q'").withColumn("form", F.lit("0")))
    return first_metadata(fe.unionByName(more).withColumn("_id", F.rand(1)))


@register("q5_bulk_load", f"""
WITH RECURSIVE {O.ingest_events_cte()},
{O.filing_html_src()},
{O.html_ctes('fh_src')},
{O.split_ctes('doc_text')},
nch AS (SELECT accession_number, count(*) AS n FROM chunks GROUP BY accession_number)
SELECT 'TK1' AS ticker, count(*) AS found, count(nch.n) AS processed, CAST(0 AS BIGINT) AS skipped, count(*) - count(nch.n) AS failed,
       CAST(coalesce(sum(nch.n), 0) AS BIGINT) AS total_chunks, (SELECT count(*) FROM chunks c JOIN fe f USING (accession_number)
          WHERE f.ticker = 'TK1' AND f.form IN ('10-K', '10-Q') AND right(f.accession_number, 1) <> '0') AS stored_chunks
FROM fe LEFT JOIN nch USING (accession_number)
WHERE ticker = 'TK1' AND form IN ('10-K', '10-Q') AND right(accession_number, 1) <> '0'""")
def q5_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: the report of loading a ticker's filings of two forms, and the chunks that the store then holds."""
    from sheaf.plans.ingest import bulk_load
    from sheaf.plans.store import FilingStore
    store = FilingStore(spark, _shared_folder(spark, "bulk"))
    report = bulk_load(store, tables.filing_metadata(spark, sf_dir), tables.filing_documents(spark, sf_dir), "tk1", ["10k", " 10 Q "], base_dir="/data")
    return report.select("ticker", "found", "processed", "skipped", "failed", "total_chunks", F.lit(store.chunks().count()).alias("stored_chunks"))


@register("k5_k6_truncate", _CHUNK_BASE + """,
has AS (SELECT DISTINCT accession_number FROM chunks),
n AS (SELECT (SELECT count(*) FROM live_f) AS filings, (SELECT count(*) FROM chunks c JOIN live_f USING (accession_number)) AS chunks
      FROM (SELECT 1))
SELECT 'written' AS step, filings, chunks, chunks AS indexed FROM n
UNION ALL SELECT 'index emptied', filings, 0, 0 FROM n UNION ALL SELECT 'filings emptied', 0, 0, 0""".replace(
    "n AS (SELECT", "live_f AS (SELECT accession_number FROM doc_filings JOIN has USING (accession_number) WHERE form IS DISTINCT FROM 'SRC0'),\nn AS (SELECT", 1))
def k5_k6_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5, K6, A1, A4: counts of a store as written, without its search index, and emptied."""
    from sheaf.plans.quality import indexed_chunk_count
    store, rows = _written_store(spark, sf_dir), []
    for step, empty in (("written", None), ("index emptied", store.truncate_search_index), ("filings emptied", lambda: store.truncate("filings"))):
        if empty:
            empty()
        rows.append((step, store.filings().count(), store.chunks().count(), indexed_chunk_count(store.index_ready(), store.chunks())))
    return spark.createDataFrame(rows, "step string, filings long, chunks long, indexed long")


@register("k10_ivf_search")
def k10_ivf_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored vector index, asked for the neighbours of the mean vector (approximate: rows only)."""
    from sheaf.operators.ivf import VectorIndex, build_ivf
    from sheaf.operators.semantic import centroid
    ch, path = _emb_chunks(spark, sf_dir), _shared_folder(spark, "ivf")
    build_ivf(ch, path)
    return VectorIndex(spark, path).search(centroid(ch), TOP_K).select("accession_number", "chunk_index", F.round("distance", 6).alias("distance"))


# --- P14, S1, E1 ---------------------------------------------------------------------------------------------
def _nested_json(d: str) -> str:
    return (f"json_object('doc', json_object('lang', {d}.lang, 'n', {d}.n_chars % 5), 'tags', json_array({d}.source, upper({d}.lang), {d}.n_chars % 3), "
            f"'long', {d}.n_chars > 1000)")


@register("p14_containment", f"""
WITH m AS (SELECT doc_id, {_nested_json('d')} AS j FROM documents d)
SELECT doc_id, coalesce(json_extract_string(j, '$.doc.lang') = 'en', false) AS in_object,
       list_contains(json_extract_string(j, '$.tags[*]'), 'DE') AS in_array,
       coalesce(json_extract_string(j, '$.doc.lang') = 'fr' AND CAST(json_extract(j, '$.doc.n') AS INTEGER) = 2
                AND CAST(json_extract(j, '$.long') AS BOOLEAN) AND list_contains(json_extract_string(j, '$.tags[*]'), 'FR'), false) AS in_all
FROM m""")
def p14_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted values in a nested object, in an array, and in both; the last through the inverted table."""
    from sheaf.functions.containment import holds, leaves, search_leaves
    from sheaf.plans.layout import stored
    d = tables.read(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.col("n_chars").cast("long").alias("n"))
    j = F.to_json(F.struct(F.struct("lang", (F.col("n") % 5).alias("n")).alias("doc"), (F.col("n") > 1000).alias("long"),
                           F.array("source", F.upper("lang"), (F.col("n") % 3).cast("string")).alias("tags")))
    rows = stored(d.select("doc_id", j.alias("j")), "metadata")
    wanted = {"doc": {"lang": "fr", "n": 2}, "long": True, "tags": ["FR"]}
    found = search_leaves(leaves(rows, "j", ["doc_id"]), rows, "j", ["doc_id"], wanted).select("doc_id", F.lit(True).alias("in_all"))
    return rows.join(found, "doc_id", "left").select("doc_id", holds("j", {"doc": {"lang": "en"}}).alias("in_object"), holds("j", {"tags": ["DE"]}).alias("in_array"),
                                                     F.coalesce("in_all", F.lit(False)).alias("in_all"))


@register("s1_event_log", ORACLE["s3_event_validation"])
def s1_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to the partitions of a log by tasks, read back by the log source."""
    import pandas as pd

    from sheaf.sources.event_log import append, read_log
    from sheaf.sources.events import parse_events
    folder = _shared_folder(spark, "log")

    def put(key, f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"first": [append(folder, list(f.sort_values("event_no")["value"]), int(key[0]))]})

    ev = _event_json(spark, sf_dir).withColumn("part", (F.col("event_no") % 4).cast("int"))
    ev.groupBy("part").applyInPandas(put, "first long").collect()                       # one row per partition
    no = F.row_number().over(Window.partitionBy("part").orderBy("event_no")) - 1
    numbers = ev.select("part", "event_no", no.cast("long").alias("offset"))
    got = read_log(spark, folder).withColumnRenamed("partition", "part").join(numbers, ["part", "offset"])
    return parse_events(got.select("event_no", "value"), "value", ["event_no"]).select("event_no", "valid", "reject_reason", "ticker", "accession_number", "form")


@register("e1_vector_cache", _CHUNK_BASE + """
SELECT CAST(count(*) AS BIGINT) AS chunks, CAST(count(DISTINCT content) AS BIGINT) AS encoded, CAST(0 AS BIGINT) AS encoded_again,
       CAST(count(*) AS BIGINT) AS unit_vectors FROM chunks""")
def e1_vector_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct text is encoded once, and a second run encodes nothing."""
    from sheaf.functions.vector import sq_norm
    from sheaf.operators.embed import HashingEncoder
    from sheaf.operators.vector_cache import VectorCache, embed_cached
    from sheaf.plans.layout import stored
    chunks = stored(doc_corpus(spark, sf_dir, with_index=False).chunks, "chunks")
    cache = VectorCache(spark, _shared_folder(spark, "vectors"))
    first = embed_cached(chunks, cache, encoder=HashingEncoder(32))[1]
    got, again = embed_cached(chunks, cache, encoder=HashingEncoder(32))
    unit = F.sum((F.abs(sq_norm("embedding") - 1) < 1e-5).cast("long")).alias("unit_vectors")
    return got.agg(F.count(F.lit(1)).alias("chunks"), unit).select("chunks", F.lit(first).cast("long").alias("encoded"),
                                                                   F.lit(again).cast("long").alias("encoded_again"), "unit_vectors")


# --- P17 -----------------------------------------------------------------------------------------------------
@register("p17_rendered", _keyword_sql(KEYWORD_QUERY, 5).replace("SELECT c.content,", """
SELECT rtrim(string_agg('[' || place || '] ' || coalesce(ticker, '?') || ' ' || coalesce(form, '?') || ' (' || accession_number || ', chunk ' || chunk_index
       || ') rank=' || printf('%.4f', rank) || chr(10) || trim(content) || chr(10), chr(10) ORDER BY place), chr(10)) AS text
FROM (SELECT CAST(row_number() OVER (ORDER BY round(sc.rank, 6) DESC, c.accession_number, c.chunk_index) AS INTEGER) AS place, f.ticker, f.form, c.content,""") + ")")
def p17_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows as one text."""
    from sheaf.plans.search import render
    c = doc_corpus(spark, sf_dir)
    found = keyword.keyword_search(c.index, c.chunks, c.filings, KEYWORD_QUERY, 5)
    return render(found.select("content", F.round("rank", 6).alias("rank"), "accession_number", "chunk_index", "metadata"))
