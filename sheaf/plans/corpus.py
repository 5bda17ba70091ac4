"""The searchable corpus built from the given tables.

``documents`` stands for extracted filing text (ticker = upper(lang), form =
upper(source)).  Filing fields ride along through chunking, so chunk metadata
needs no join back to the filings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.config import CHUNK_OVERLAP, CHUNK_SIZE
from sheaf.functions.meta import FILING_FIELDS, metadata_json
from sheaf.operators.chunk import chunk_text
from sheaf.operators.keyword import KeywordIndex, build_index
from sheaf.plans.layout import spread, stored
from sheaf.sources import tables


@dataclass
class Corpus:
    filings: DataFrame
    chunks: DataFrame          # accession_number, chunk_index, section, content, metadata
    index: KeywordIndex | None = None


def doc_corpus(spark: SparkSession, sf_dir: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               with_index: bool = True) -> Corpus:
    """Filings and chunks from a single scan of ``documents`` (no join)."""
    d = spread(tables.read(spark, sf_dir, "documents"), "doc_id")
    k = F.col("doc_id")
    src = d.select(
        tables.accession_of("doc_id").alias("accession_number"),
        F.upper("lang").alias("ticker"),
        F.concat(F.lit("Company "), F.upper("lang")).alias("company_name"),
        F.upper("source").alias("form"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(k, F.lit(365)).cast("int")).alias("filing_date"),
        F.concat(F.lit("/data/docs/"), k.cast("string"), F.lit(".txt")).alias("local_path"),
        F.lit("").alias("document_url"),
        "text",
    )
    filings = src.drop("text")
    chunks = chunk_text(src, "text", list(FILING_FIELDS), size, overlap).select(
        "accession_number", "chunk_index", "section", "content", metadata_json("section").alias("metadata"))
    if with_index:      # postings, terms, statistics, keys and content all start from the chunks: cut them once
        chunks = stored(chunks, "chunks")
    return Corpus(filings, chunks, build_index(chunks) if with_index else None)
