"""Batch ingest of filing events.

One call processes every event of a batch together: the checks are column
predicates and joins, extraction and chunking are DataFrame operators, and
each event ends with exactly one outcome row::

    loaded   - chunks produced (and written, unless a later copy replaced it)
    skipped  - already processed, form not allowed, or a duplicate in the batch
    failed   - invalid event, path outside the data folder, file not found,
               no extractable text, no chunks
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.config import LOAD_REPORT_MAX_ERRORS, Settings
from sheaf.functions.meta import metadata_json
from sheaf.functions.paths import inside, normalize_path
from sheaf.functions.text import normalize_forms, py_strip
from sheaf.operators.chunk import chunks_sql
from sheaf.operators.embed import embed
from sheaf.operators.html import extract_text
from sheaf.operators.vector_cache import VectorCache, embed_cached
from sheaf.plans.layout import stored
from sheaf.sources.documents import DocumentFiles, wanted_documents
from sheaf.sources.events import TYPED_COLUMNS

# fixed values: outcome reasons
R_INVALID = "invalid event: "
R_DONE = "already processed"
R_FORM = "form not allowed"
R_OUTSIDE = "outside data folder"
R_MISSING = "file not found"
R_EMPTY = "no extractable text"
R_NO_CHUNKS = "no chunks"
R_DUPLICATE = "duplicate in batch"
R_ENCODING = "encoding failed: "

OUTCOME_COLUMNS = ["batch_id", "event_no", "accession_number", "ticker", "status", "reason", "chunk_count"]


@dataclass
class IngestResult:
    filings: DataFrame     # one row per written filing (a version of the filings table)
    chunks: DataFrame      # its chunks: accession_number, chunk_index, content, metadata, section, batch_id
    outcomes: DataFrame    # one row per event


def stage(events: DataFrame, documents: DataFrame | DocumentFiles, settings: Settings = Settings(),
          current_filings: DataFrame | None = None, skip_if_processed: bool = True,
          base_dir: str | None = None) -> DataFrame:
    """Per-event state before the writes: event columns, ``event_no``,
    ``status``, ``reason``, ``_chunks`` (array) and ``chunk_count``.

    ``events`` need ``event_no`` (arrival order) plus the validated event
    columns; ``documents`` are ``(path, html)`` or a ``DocumentFiles``.
    """
    ev = events.select("event_no", *TYPED_COLUMNS, "valid", "reject_reason")
    status = F.when(~F.col("valid"), F.lit("failed"))
    reason = F.when(~F.col("valid"), F.concat(F.lit(R_INVALID), F.col("reject_reason")))
    if skip_if_processed and current_filings is not None:
        done = current_filings.select(F.col("accession_number").alias("_key")).distinct().withColumn("_done", F.lit(True))
        ev = ev.withColumn("_key", _spread_nulls("accession_number")).join(done, "_key", "left").drop("_key")
        status = status.when(F.col("_done"), F.lit("skipped"))
        reason = reason.when(F.col("_done"), F.lit(R_DONE))
    allowed = [f.upper() for f in settings.allowed_forms]
    status = status.when(~F.upper("form").isin(allowed), F.lit("skipped"))
    reason = reason.when(~F.upper("form").isin(allowed), F.lit(R_FORM))
    ev = ev.withColumn("_path", normalize_path("local_path"))
    if base_dir:
        status = status.when(~inside(F.col("_path"), base_dir), F.lit("failed"))
        reason = reason.when(~inside(F.col("_path"), base_dir), F.lit(R_OUTSIDE))
    ev = ev.withColumns({"status": status, "reason": reason})
    ev = ev.withColumn("_path", F.when(F.col("status").isNull(), F.col("_path")))
    # Only the open events' documents are read
    docs = wanted_documents(documents, ev.filter("_path IS NOT NULL").select("_path").distinct())
    s = ev.withColumn("_path", _spread_nulls("_path")).join(docs, "_path", "left")
    still = F.col("status").isNull() & F.col("html").isNotNull()
    s = extract_text(s.withColumn("_still", still), "event_no", "html")
    s = s.withColumn("_chunks", F.expr(chunks_sql("coalesce(text, '')", settings.chunk_size, settings.chunk_overlap)))
    s = s.withColumn("chunk_count", F.when(F.col("_still"), F.size("_chunks")).otherwise(0))
    empty = py_strip(F.col("text")) == ""
    end = (F.when(F.col("status").isNotNull(), F.struct("status", "reason"))
           .when(~F.col("_still"), F.struct(F.lit("failed").alias("status"), F.lit(R_MISSING).alias("reason")))
           .when(empty, F.struct(F.lit("failed").alias("status"), F.lit(R_EMPTY).alias("reason")))
           .when(F.col("chunk_count") == 0, F.struct(F.lit("failed").alias("status"), F.lit(R_NO_CHUNKS).alias("reason")))
           .otherwise(F.struct(F.lit("loaded").alias("status"), F.lit(None).cast("string").alias("reason"))))
    return s.withColumn("_end", end).select("event_no", *TYPED_COLUMNS, "_end.status", "_end.reason", "_chunks", "chunk_count")


def _spread_nulls(col: str) -> F.Column:
    """A join key: nulls become keys of their own that meet nothing, so they do not share a task."""
    return F.coalesce(F.col(col), F.concat(F.lit("\x00"), F.col("event_no").cast("string")))


def choose_writes(staged: DataFrame, skip_if_processed: bool = True) -> DataFrame:
    """Duplicates of one accession number in a batch.  With skipping on,
    the first successful event wins and later ones count as skipped; when
    forced, every copy is processed and the last one is what stays written.

    The winner per accession is a partial+final aggregate joined back, so a
    hot accession does not land in one window partition.
    """
    loaded = staged.filter(F.col("status") == "loaded")
    pick = F.min("event_no") if skip_if_processed else F.max("event_no")
    win = loaded.groupBy(F.col("accession_number").alias("_key")).agg(pick.alias("_win"))
    s = staged.withColumn("_key", _spread_nulls("accession_number")).join(win, "_key", "left").drop("_key")
    loser = (F.col("status") == "loaded") & (F.col("event_no") != F.col("_win"))
    if skip_if_processed:
        s = s.withColumn("reason", F.when(loser, F.lit(R_DUPLICATE)).otherwise(F.col("reason")))
        s = s.withColumn("chunk_count", F.when(loser, F.lit(0)).otherwise(F.col("chunk_count")))
        s = s.withColumn("status", F.when(loser, F.lit("skipped")).otherwise(F.col("status")))
    return s.withColumn("written", (F.col("status") == "loaded") & (F.col("event_no") == F.col("_win"))).drop("_win")


def ingest(events: DataFrame, documents: DataFrame | DocumentFiles, settings: Settings = Settings(), batch_id: int = 0,
           current_filings: DataFrame | None = None, skip_if_processed: bool = True, base_dir: str | None = None,
           processed_at=None, encoder=None, materialize: bool = True, vectors: VectorCache | None = None) -> IngestResult:
    """Q6: the whole batch.  ``materialize`` writes the per-event state once to the
    shared checkpoint folder, and the three outputs start from there.  A filing with a
    chunk that the encoder cannot encode ends as ``failed``; the rest of the batch goes on.
    ``vectors``: a cache, so that only texts are encoded that it lacks."""
    s = stage(events, documents, settings, current_filings, skip_if_processed, base_dir)
    s = choose_writes(stored(s, "ingest") if materialize else s, skip_if_processed)
    ts = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    outcomes = s.select(F.lit(batch_id).cast("long").alias("batch_id"), F.col("event_no").cast("long"),
                        "accession_number", "ticker", "status", "reason", F.col("chunk_count").cast("int"))
    w = s.filter("written")
    filings = w.select("accession_number", "ticker", "company_name", "form", "filing_date", "document_url",
                       "local_path", "downloaded_at", ts.alias("processed_at"),
                       F.col("chunk_count").cast("int").alias("chunk_count"), F.lit(False).alias("deleted"),
                       F.lit(batch_id).cast("long").alias("batch_id"))
    chunks = (w.select("accession_number", "ticker", "company_name", "form", "filing_date", "local_path",
                       "document_url", F.posexplode("_chunks").alias("chunk_index", "_c"))
              .select("accession_number", F.col("chunk_index").cast("int"), F.col("_c.section").alias("section"),
                      F.col("_c.content").alias("content"), metadata_json(F.col("_c.section")).alias("metadata"),
                      F.lit(batch_id).cast("long").alias("batch_id")))
    if encoder is not None:
        made = embed_cached(chunks, vectors, "content", encoder, error_col="_error")[0] if vectors else embed(chunks, "content", encoder, error_col="_error")
        chunks = stored(made, "vectors")
        bad = chunks.filter("_error IS NOT NULL").groupBy("accession_number").agg(F.min("_error").alias("_error"))
        filings = filings.join(bad, "accession_number", "left_anti")
        lost = w.select("event_no", "accession_number").join(bad, "accession_number").select("event_no", "_error")
        outcomes = outcomes.join(lost, "event_no", "left").select(
            *[{"status": F.when(F.col("_error").isNull(), F.col("status")).otherwise("failed"),
               "reason": F.when(F.col("_error").isNull(), F.col("reason")).otherwise(F.concat(F.lit(R_ENCODING), F.col("_error"))),
               "chunk_count": F.when(F.col("_error").isNull(), F.col("chunk_count")).otherwise(0)}.get(c, F.col(c)).alias(c)
              for c in outcomes.columns])
        chunks = chunks.join(bad.select("accession_number"), "accession_number", "left_anti").drop("_error")
    return IngestResult(filings, chunks, outcomes)


def load_report(outcomes: DataFrame, found: DataFrame | None = None,
                max_errors: int = LOAD_REPORT_MAX_ERRORS) -> DataFrame:
    """A3: per ticker ``found, processed, skipped, failed, total_chunks,
    errors`` (at most ``max_errors`` messages, in event order).

    Counts are partial+final aggregates; the error list keeps only the first
    ``max_errors`` rows per ticker through ``row_number() <= n``, which Spark
    cuts per map task before the shuffle, so a ticker with millions of
    failures never collects them in one place.
    """
    from pyspark.sql.window import Window

    counts = outcomes.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("found"),
        F.sum(F.when(F.col("status") == "loaded", 1).otherwise(0)).alias("processed"),
        F.sum(F.when(F.col("status") == "skipped", 1).otherwise(0)).alias("skipped"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("status") == "loaded", F.col("chunk_count")).otherwise(0)).alias("total_chunks"))
    fails = outcomes.filter(F.col("status") == "failed")
    w = Window.partitionBy("ticker").orderBy("event_no")
    first = fails.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= max_errors)
    errs = first.groupBy("ticker").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_n", F.concat_ws(": ", "accession_number", "reason").alias("m")))),
                    lambda x: x["m"]).alias("errors"))
    out = counts.join(errs, "ticker", "left").select(
        "ticker", F.col("found").cast("long"), F.col("processed").cast("long"), F.col("skipped").cast("long"),
        F.col("failed").cast("long"), F.col("total_chunks").cast("long"),
        F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))
    if found is not None:
        out = found.join(out, "ticker", "left")
    return out


def bulk_load(store, metadata: DataFrame, documents: DataFrame | DocumentFiles, ticker: str, forms: list[str] | None = None,
              settings: Settings = Settings(), base_dir: str | None = None, encoder=None, reprocess: bool = True) -> DataFrame:
    """Q5: load all filings of one ticker from the metadata documents (S8) with the
    chosen forms (P9), by default even if they were loaded before, and report (A3)."""
    from sheaf.sources.events import first_metadata, from_manifest, metadata_for_ticker

    found = first_metadata(metadata_for_ticker(metadata, ticker, normalize_forms(forms)))
    events = stored(from_manifest(found).withColumn("event_no", F.monotonically_increasing_id()), "events")
    done = None if reprocess else store.processed(events.select("accession_number"))
    res = ingest(events, documents, settings, current_filings=done, skip_if_processed=not reprocess,
                 base_dir=base_dir, encoder=encoder)
    store.write_batch(res.filings, res.chunks)
    return load_report(res.outcomes)
