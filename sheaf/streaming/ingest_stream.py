"""Continuous ingest (R1-R6) with Structured Streaming.

A stream of event values (Kafka ``value`` or lines of JSON files) feeds
``foreachBatch``: each micro-batch is decoded, enriched, processed and written
as one store batch, keyed by the run that belongs to the checkpoint and the
micro-batch id.  Offsets are committed in the checkpoint only after
``foreachBatch`` returns.  A replayed micro-batch is judged as if it had not been
written and replaces its own partitions, outcomes included; a new checkpoint is a
new run and touches nothing that is stored.
Bad records become ``failed`` outcomes; the stream goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sheaf.config import Settings
from sheaf.plans.ingest import ingest
from sheaf.plans.layout import scratch_scope, stored
from sheaf.plans.store import FilingStore, run_id_of
from sheaf.session import ensure_checkpoint_dir
from sheaf.sources.documents import DocumentFiles
from sheaf.sources.events import enrich, parse_events

START_POSITIONS = ("earliest", "latest", "committed")


def kafka_events(spark: SparkSession, servers: str, topic: str = "filing.downloaded",
                 start: str = "committed") -> DataFrame:
    """S1 + R2: the topic as a stream of ``value, event_no``.

    ``committed`` resumes from the query's checkpoint; ``earliest``/``latest``
    apply to a new checkpoint (start again from the beginning = new folder).
    Needs the Kafka connector on the classpath.
    """
    if start not in START_POSITIONS:
        raise ValueError(f"unsupported offset mode: {start}")
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic))
    if start != "committed":
        reader = reader.option("startingOffsets", start)
    raw = reader.load()
    order = F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")
    return raw.select(F.col("value").cast("string").alias("value"), order.alias("event_no"))


def file_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as an event stream (tests, replays); the
    events are numbered inside each micro-batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("value")


def process_batch(batch: DataFrame, batch_id: int, store: FilingStore, documents: DataFrame | DocumentFiles, run_id: str,
                  metadata: DataFrame | None = None, settings: Settings = Settings(),
                  skip_if_processed: bool = True, base_dir: str | None = None, encoder=None) -> None:
    """One micro-batch: decode -> enrich -> ingest -> chunks, index, filings, outcomes.  Its
    intermediate tables go when it is done."""
    ensure_checkpoint_dir(batch.sparkSession)
    with scratch_scope(batch.sparkSession):
        _process(batch, batch_id, store, documents, run_id, metadata, settings, skip_if_processed, base_dir, encoder)


def _process(batch, batch_id, store, documents, run_id, metadata, settings, skip_if_processed, base_dir, encoder) -> None:
    if "event_no" not in batch.columns:    # file source: arrival order inside the batch
        batch = batch.withColumn("event_no", F.monotonically_increasing_id())
    events = parse_events(batch.select("value", "event_no"), "value", ["event_no"])
    if metadata is not None:
        events = enrich(events, metadata).drop("enriched")
    events = stored(events, "events")
    done = store.processed(events.select("accession_number"), but=(run_id, batch_id)) if skip_if_processed else None
    res = ingest(events, documents, settings, batch_id=batch_id, current_filings=done,
                 skip_if_processed=skip_if_processed, base_dir=base_dir, encoder=encoder, materialize=True)
    store.write_batch(res.filings, res.chunks, run_id, batch_id)
    (res.outcomes.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "batch_id").parquet(f"{store.root.rstrip('/')}/outcomes"))


def start(events: DataFrame, store: FilingStore, documents: DataFrame | DocumentFiles, checkpoint: str,
          metadata: DataFrame | None = None, settings: Settings = Settings(), trigger: dict | None = None,
          skip_if_processed: bool = True, base_dir: str | None = None, encoder=None,
          name: str | None = None) -> StreamingQuery:
    """Start the ingest stream (R6: an already running query with the same
    name is an error)."""
    spark = events.sparkSession
    run_id = run_id_of(spark, checkpoint)
    if name and any(q.name == name for q in spark.streams.active):
        raise RuntimeError(f"stream {name} is already running")
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, bid: process_batch(df, bid, store, documents, run_id, metadata, settings, skip_if_processed,
                                      base_dir, encoder))
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return writer.start()


def stop(query: StreamingQuery, timeout_s: float = 30.0) -> None:
    """Stop and wait up to ``timeout_s`` seconds."""
    query.stop()
    query.awaitTermination(timeout_s)


def status(query: StreamingQuery | None) -> dict:
    """State, last progress and last error of the stream."""
    if query is None:
        return {"state": "stopped", "last_error": None, "progress": None}
    exc = query.exception()
    return {"state": "running" if query.isActive else "stopped",
            "last_error": str(exc) if exc else None,
            "progress": query.lastProgress, "status": query.status}
