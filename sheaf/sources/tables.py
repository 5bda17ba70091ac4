"""Base tables and the derived views the engine runs on.

``read(spark, sf_dir, name)`` reads one of the given Parquet tables.  The
derived views turn them into the engine's inputs (filing events, metadata
documents, filing HTML, chunk vectors, a filings corpus).  Every view is a plain
projection or join of the base tables, so Catalyst prunes columns and pushes
filters into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def accession_of(id_col: str) -> F.Column:
    """A unique accession-like key for an integer id (no truncation at any size)."""
    c = F.col(id_col).cast("long")
    return F.concat(
        F.lpad(F.floor(c / 1_000_000).cast("string"), 10, "0"), F.lit("-24-"),
        F.lpad(F.pmod(c, F.lit(1_000_000)).cast("string"), 6, "0"),
    )


def filing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of filings built from ``pages`` and ``events`` (mixed forms:
    one lower-case, one outside the allow list).  Columns follow the event."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    events = read(spark, sf_dir, "events").select("event_id", "ts")
    k = F.col("page_id")
    form = (F.when(k % 6 == 0, "10-K").when(k % 6 == 1, "10-Q").when(k % 6 == 2, "8-K")
            .when(k % 6 == 3, "10-K/A").when(k % 6 == 4, "10-q").otherwise("4"))
    return (
        pages.join(events, events.event_id == pages.page_id, "left")      # a page without an event keeps its filing
        .select(
            accession_of("page_id").alias("accession_number"),
            F.concat(F.lit("TK"), (k % 7).cast("string")).alias("ticker"),
            F.concat(F.lit("Company "), (k % 7).cast("string")).alias("company_name"),
            form.alias("form"),
            F.date_add(F.lit("2024-01-01").cast("date"), (k % 365).cast("int")).alias("filing_date"),
            F.concat(F.lit("/data/"), k.cast("string"), F.lit(".htm")).alias("local_path"),
            F.col("url").alias("document_url"),
            F.coalesce("ts", F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("downloaded_at"),
        )
    )


def filing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata documents for 9 in 10 filings; TK3 documents lack a field."""
    ev = filing_events(spark, sf_dir)
    return ev.filter(F.substring("accession_number", -1, 1) != "0").select(
        "accession_number", "ticker", "company_name", "form", "filing_date",
        F.concat(F.lit("/data/meta"), F.col("local_path")).alias("local_path"),
        F.when(F.col("ticker") == "TK3", F.lit(None).cast("string")).otherwise(F.col("document_url")).alias("document_url"),
        "downloaded_at",
    )


def filing_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filings' pages, keyed like filings."""
    return _filing_pages(spark, sf_dir).drop("page_id")


def _filing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with a nested hidden part, a table, ix tags and an ITEM header."""
    pages = read(spark, sf_dir, "pages")
    k = F.col("page_id")
    insert = F.concat(
        F.lit('<div style="display: none"><ix:header>hidden <div>deep</div></ix:header></div>'
              '<table><tr><th>Name</th><th>Votes</th></tr><tr><td>TK'),
        (k % 7).cast("string"),
        F.lit("</td><td><ix:nonFraction>"), k.cast("string"),
        F.lit("</ix:nonFraction></td></tr></table><article><p>preface</p><p>ITEM "),
        (k % 9 + 1).cast("string"), F.lit(". Section text</p>"),
    )
    return pages.select("page_id", accession_of("page_id").alias("accession_number"),
                        F.replace(F.col("html"), F.lit("<article>"), insert).alias("html"))


def page_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` keyed like filings."""
    return read(spark, sf_dir, "pages").select(accession_of("page_id").alias("accession_number"), "html")


def doc_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing row per ``documents`` row: ticker = upper(lang), form = upper(source)."""
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    k = F.col("doc_id")
    return d.select(
        accession_of("doc_id").alias("accession_number"),
        F.upper("lang").alias("ticker"),
        F.concat(F.lit("Company "), F.upper("lang")).alias("company_name"),
        F.upper("source").alias("form"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(k, F.lit(365)).cast("int")).alias("filing_date"),
        F.concat(F.lit("/data/docs/"), k.cast("string"), F.lit(".txt")).alias("local_path"),
        F.lit("").alias("document_url"),
    )


def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filing_events`` as an arrival-ordered batch (``event_no`` = page id),
    with two path defects: every 23rd filing points outside the data folder,
    every 29th at a file that does not exist."""
    ev = filing_events(spark, sf_dir)
    k = F.regexp_extract("local_path", r"/data/(\d+)\.htm", 1).cast("long")
    path = (F.when(k % 23 == 0, F.concat(F.lit("/data/../etc/"), k.cast("string"), F.lit(".htm")))
            .when(k % 29 == 0, F.concat(F.lit("/data/missing/"), k.cast("string"), F.lit(".htm")))
            .otherwise(F.col("local_path")))
    return ev.select(k.alias("event_no"), *[path.alias(c) if c == "local_path" else F.col(c) for c in ev.columns])


def filing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filing_html`` served at the event path and at the metadata path."""
    h = _filing_pages(spark, sf_dir).select(F.col("page_id").alias("k"), "html")
    a = h.select(F.concat(F.lit("/data/"), F.col("k").cast("string"), F.lit(".htm")).alias("path"), "html")
    b = h.select(F.concat(F.lit("/data/meta/data/"), F.col("k").cast("string"), F.lit(".htm")).alias("path"), "html")
    return a.unionByName(b)
