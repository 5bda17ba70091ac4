"""Data-quality checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.config import MODEL_DIMENSIONS


def chunks_per_filing(chunks: DataFrame) -> DataFrame:
    """A2: partial+final count per accession number."""
    return chunks.groupBy("accession_number").agg(F.count(F.lit(1)).alias("n_chunks"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (must be empty)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def orphan_chunks(chunks: DataFrame, filings: DataFrame) -> DataFrame:
    """Chunks whose filing is missing (must be empty)."""
    return chunks.join(filings.select("accession_number"), "accession_number", "left_anti")


def chunk_count_mismatch(filings: DataFrame, chunks: DataFrame) -> DataFrame:
    """Stored ``chunk_count`` against the chunks actually present."""
    counted = chunks_per_filing(chunks)
    return (filings.select("accession_number", "chunk_count").join(counted, "accession_number", "left")
            .select("accession_number", "chunk_count", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"))
            .filter(F.col("chunk_count") != F.col("n_chunks")))


def vector_check(chunks: DataFrame, dim: int, col: str = "embedding") -> DataFrame:
    """P18 + P19: vector count, the dimension found in the data, and rows of
    the wrong length."""
    return chunks.agg(F.count(F.lit(1)).alias("n_vectors"), F.max(F.size(col)).alias("dim"),
                      F.sum(F.when(F.size(col) != dim, 1).otherwise(0)).alias("bad_length"))


def model_dimension(model_col) -> F.Column:
    """Vector length implied by a model name (0 when unknown)."""
    c = F.lower(F.col(model_col) if isinstance(model_col, str) else model_col)
    out = F.lit(0)
    for name, dim in reversed(MODEL_DIMENSIONS):
        out = F.when(c.contains(name), F.lit(dim)).otherwise(out)
    return out


def index_ready(indexed: DataFrame | None, chunks: DataFrame) -> bool:
    """A5: the keys of ``indexed`` (``keyword.lengths_of`` rows, chunks without a token
    included) are exactly those of the current chunks."""
    if indexed is None:
        return False
    key = ["accession_number", "chunk_index"]
    a, b = indexed.select(*key), chunks.select(*key)
    return a.join(b, key, "left_anti").isEmpty() and b.join(a, key, "left_anti").isEmpty()


def indexed_chunk_count(ready: bool, chunks: DataFrame) -> int:
    """A4: 0 when the index is not ready."""
    return chunks.count() if ready else 0


def latest_filings(filings: DataFrame, n: int = 10) -> DataFrame:
    """T4: newest filings first (accession number breaks ties)."""
    return filings.orderBy(F.col("filing_date").desc_nulls_last(), "accession_number").limit(n)


def schema_report(tables: dict[str, DataFrame], notes: dict[str, str] | None = None) -> DataFrame:
    """A10: table, column, type, nullable, note (from the DataFrames' schemas)."""
    notes = notes or {}
    rows = []
    for tname, df in tables.items():
        for pos, f in enumerate(df.schema.fields):
            rows.append((tname, pos, f.name, f.dataType.simpleString(), f.nullable, notes.get(f.name)))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table string, position int, column string, type string, nullable boolean, "
                                       "note string")
