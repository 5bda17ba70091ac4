"""Filing events: decode, validate, files, manifests, metadata documents.

An event is one JSON object with ten required fields.  Decoding keeps every
row: bad rows get ``valid = false`` and a ``reject_reason`` instead of raising,
so a batch (or a micro-batch of a stream) is never lost to one bad record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.config import EVENT_TYPE, MANIFEST_DOCUMENT_URL, MANIFEST_DOWNLOADED_AT, SCHEMA_VERSION

# fixed value: the event's fields, in order
EVENT_FIELDS = ("event_type", "schema_version", "ticker", "company_name", "filing_date", "form",
                "accession_number", "local_path", "document_url", "downloaded_at")

# fields that must be JSON strings
TEXT_FIELDS = ("ticker", "company_name", "form", "accession_number", "local_path", "document_url")

RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in EVENT_FIELDS])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("filing_date", T.DateType()),
    T.StructField("form", T.StringType()),
    T.StructField("accession_number", T.StringType()),
    T.StructField("local_path", T.StringType()),
    T.StructField("document_url", T.StringType()),
    T.StructField("downloaded_at", T.TimestampType()),
])

TYPED_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]


def decode_events(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON text (or UTF-8 bytes) -> raw string fields + ``_is_object`` +
    ``_not_text`` (text fields that hold another JSON type than a string)."""
    keep = list(keep or [c for c in df.columns if c != value_col])
    txt = F.col(value_col).cast("string")
    kind = lambda f: F.schema_of_variant(F.try_variant_get(F.try_parse_json(txt), f"$.{f}", "variant"))
    other = F.array(*[F.when(~kind(f).isin("STRING", "VOID"), F.lit(f)) for f in TEXT_FIELDS])
    return df.select(*keep, F.json_object_keys(txt).isNotNull().alias("_is_object"),
                     F.filter(other, lambda x: x.isNotNull()).alias("_not_text"),
                     F.from_json(txt, RAW_SCHEMA).alias("_e")).select(*keep, "_is_object", "_not_text", "_e.*")


def validate(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """S3: typed event columns + ``valid`` + ``reject_reason`` (first failure).

    Rules: a JSON object; all ten fields present; ``event_type`` is
    ``filing.downloaded``; ``schema_version`` an integer; ``filing_date`` a date
    (yyyy-MM-dd); ``downloaded_at`` an ISO timestamp.  Extra fields are ignored.
    """
    keep = list(keep or [c for c in raw.columns if c not in EVENT_FIELDS and c not in ("_is_object", "_not_text")])
    is_obj = F.col("_is_object") if "_is_object" in raw.columns else F.lit(True)
    not_text = F.col("_not_text") if "_not_text" in raw.columns else F.array().cast("array<string>")
    missing = F.filter(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in EVENT_FIELDS]),
                       lambda x: x.isNotNull())
    version = F.expr("try_cast(schema_version AS INT)")
    fdate = F.expr("try_to_date(CAST(filing_date AS STRING), 'yyyy-MM-dd')")
    dts = F.expr("try_to_timestamp(CAST(downloaded_at AS STRING))")
    reason = (F.when(~is_obj, F.lit("malformed json"))
              .when(F.size(missing) > 0, F.concat(F.lit("missing field: "), F.array_join(missing, ", ")))
              .when(F.size(not_text) > 0, F.concat(F.lit("not a text field: "), F.array_join(not_text, ", ")))
              .when(F.col("event_type") != EVENT_TYPE, F.concat(F.lit("unsupported event_type: "), F.col("event_type")))
              .when(version.isNull(), F.lit("invalid schema_version"))
              .when(fdate.isNull(), F.lit("invalid filing_date"))
              .when(dts.isNull(), F.lit("invalid downloaded_at")))
    return raw.select(
        *keep, "event_type", version.alias("schema_version"), "ticker", "company_name", fdate.alias("filing_date"),
        "form", "accession_number", "local_path", "document_url", dts.alias("downloaded_at"),
        reason.isNull().alias("valid"), reason.alias("reject_reason"))


def parse_events(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """S2 + S3 in one step."""
    keep = list(keep or [c for c in df.columns if c != value_col])
    return validate(decode_events(df, value_col, keep), keep)


def read_event_files(spark: SparkSession, path: str) -> DataFrame:
    """One JSON event per file (whole file read as one record)."""
    raw = spark.read.format("binaryFile").load(path).select("path", F.col("content").alias("value"))
    raw = raw.select("path", F.expr("make_valid_utf8(CAST(value AS STRING))").alias("value"))
    return parse_events(raw, "value", ["path"])


def from_manifest(df: DataFrame) -> DataFrame:
    """A manifest row names a filing by its fields; the optional
    ``document_url`` and ``downloaded_at`` get their defaults."""
    cols = set(df.columns)
    url = F.coalesce(F.col("document_url"), F.lit(MANIFEST_DOCUMENT_URL)) if "document_url" in cols \
        else F.lit(MANIFEST_DOCUMENT_URL)
    dl = F.coalesce(F.col("downloaded_at").cast("string"), F.lit(MANIFEST_DOWNLOADED_AT)) if "downloaded_at" in cols \
        else F.lit(MANIFEST_DOWNLOADED_AT)
    raw = df.select(
        F.lit(EVENT_TYPE).alias("event_type"), F.lit(str(SCHEMA_VERSION)).alias("schema_version"),
        F.col("ticker").cast("string"), F.col("company_name").cast("string"),
        F.col("filing_date").cast("string"), F.col("form").cast("string"),
        F.col("accession_number").cast("string"), F.col("local_path").cast("string"),
        url.alias("document_url"), dl.alias("downloaded_at"))
    return validate(raw, [])


def typed_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed rows (a manifest, metadata documents) through the same
    validation; ``event_type`` and ``schema_version`` default to the fixed
    values when the input has no such column, as for a manifest."""
    keep = list(keep or [])
    fixed = {"event_type": F.lit(EVENT_TYPE), "schema_version": F.lit(str(SCHEMA_VERSION))}

    def field(c):
        if c in df.columns:
            return F.col(c).cast("string").alias(c)
        return fixed.get(c, F.lit(None).cast("string")).alias(c)

    raw = df.select(*keep, *[field(c) for c in EVENT_FIELDS])
    return validate(raw, keep)


# --- metadata documents (S7, S8, W3) --------------------------------------------
def first_metadata(meta: DataFrame) -> DataFrame:
    """S7 + W3: one document per accession number, ``_id`` removed.

    The store's "first" is unspecified; we take the smallest row, as a
    partial+final aggregate (safe when one accession has very many copies).
    """
    cols = [c for c in meta.columns if c not in ("_id", "accession_number")]
    best = F.min(F.struct(*[F.col(c) for c in cols]))
    return meta.groupBy("accession_number").agg(best.alias("_m")).select("accession_number", "_m.*")


def metadata_for_ticker(meta: DataFrame, ticker: str, forms: list[str] | None = None) -> DataFrame:
    """Documents of ``upper(ticker)``; ``form IN upper(forms)`` unless the
    list is empty or None."""
    out = meta.filter(F.col("ticker") == ticker.upper())
    if forms:
        out = out.filter(F.col("form").isin([f.upper() for f in forms]))
    return out.drop("_id") if "_id" in out.columns else out


def enrich(events: DataFrame, meta: DataFrame) -> DataFrame:
    """When a metadata document exists for the accession number its fields
    replace the whole event (a field it lacks makes the event invalid; no
    per-column fallback); otherwise the event stays as it is.

    ``events`` are validated events (typed); the result is re-validated.
    """
    m = first_metadata(meta)
    fields = [c for c in EVENT_FIELDS if c not in ("event_type", "schema_version", "accession_number")]
    keep = [c for c in events.columns if c not in EVENT_FIELDS and c not in ("valid", "reject_reason")]
    joined = events.alias("e").join(
        m.select("accession_number", *[F.col(c) for c in fields if c in m.columns]).alias("m"),
        F.col("e.accession_number") == F.col("m.accession_number"), "left")
    found = F.col("m.accession_number").isNotNull()
    chosen = []
    for c in EVENT_FIELDS:
        ev = F.col(f"e.{c}").cast("string")
        if c == "event_type":
            doc = F.lit(EVENT_TYPE)
        elif c == "schema_version":
            doc = F.lit(str(SCHEMA_VERSION))
        elif c == "accession_number":
            doc = F.col("m.accession_number")
        elif c in m.columns:
            doc = F.col(f"m.{c}").cast("string")
        else:
            doc = F.lit(None).cast("string")
        chosen.append(F.when(found, doc).otherwise(ev).alias(c))
    raw = joined.select(*[F.col(f"e.{c}").alias(c) for c in keep], *chosen,
                        found.alias("enriched"), F.col("e.valid").alias("_was_valid"),
                        F.col("e.reject_reason").alias("_was_reason"))
    out = validate(raw, keep + ["enriched", "_was_valid", "_was_reason"])
    # an invalid event without a document stays invalid for its own reason
    return out.select(
        *keep, *TYPED_COLUMNS, "enriched",
        F.when(F.col("enriched"), F.col("valid")).otherwise(F.col("_was_valid")).alias("valid"),
        F.when(F.col("enriched"), F.col("reject_reason")).otherwise(F.col("_was_reason")).alias("reject_reason"))

