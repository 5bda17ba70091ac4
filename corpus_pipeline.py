"""A corpus pipeline over ``documents``, five of the operators one after the other.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``docs``.

1. language_id: documents without any letter (null and empty texts too) have no
   language and go; the model learns from the documents given.
2. simhash_near_dedup: of each group of linked fingerprints the row with the
   smallest doc_id stays (a null doc_id after all others, of equal ids the first row).
3. benchmark_decontamination: documents with a word inside an occurrence of a benchmark window go.
4. source_mixing: each document stands as often as the mix takes it (never, once or twice).
5. sharding: the columns of ``docs`` and shard, slot; documents of equal text, such
   as the mix's copies, are linked.

Rows, not ids, are decided on, so repeated and null ids lose nothing else.
Very long texts go through every stage whole, never cut.
Empty inputs give empty results; columns named like a result of an operator are kept as they are,
but for shard and slot, which the last stage replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import settle, table


def _kept(df: DataFrame) -> DataFrame:
    return df.select("kept.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a letter; an empty table stays empty."""
    from sheaf.llm.langid import UNKNOWN, fit, identify

    return _kept(identify(docs, fit(docs), docs.columns).filter(F.col("lang_pred") != UNKNOWN))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: the smallest doc_id's, null ids after all others, of equal ids the first."""
    from sheaf.llm.simhash import near_dedup

    rows = docs.withColumn("_sheaf_row", F.monotonically_increasing_id())
    found = near_dedup(rows, ["doc_id", "_sheaf_row"])
    found = settle(found.select("root", F.struct(F.col("kept.doc_id").isNull().alias("last"), F.col("kept.doc_id").alias("id"),
                                                 F.col("kept._sheaf_row").alias("row")).alias("me")), "groups")
    stays = found.groupBy("root").agg(F.min("me").alias("stays"), F.count("*").alias("n")).filter("n > 1")
    gone = found.join(stays, "root").filter("me.row <> stays.row").select(F.col("me.row").alias("_sheaf_row"))
    return rows.join(gone, "_sheaf_row", "left_anti").select(*[rows[c] for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a word of a benchmark window; null and empty texts stay."""
    from sheaf.llm.decontam import decontaminate

    return _kept(decontaminate(docs, table(spark, sf_dir, "benchmark"), docs.columns).filter(F.size("spans") == 0))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: never, once or twice."""
    from sheaf.llm.mixing import mix

    rows = docs.withColumn("_sheaf_row", F.monotonically_increasing_id())
    copies = mix(rows, keep=["_sheaf_row"]).filter("copies > 0").select(F.col("kept._sheaf_row").alias("_sheaf_row"), "copies")
    taken = rows.join(copies.withColumnRenamed("copies", "_sheaf_copies"), "_sheaf_row")
    return (taken.withColumn("_sheaf_copy", F.explode(F.sequence(F.lit(1), F.col("_sheaf_copies").cast("int"))))
            .select(*[rows[c] for c in docs.columns]))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot; a column of these names in ``docs`` is replaced."""
    from sheaf.llm.sharding import shard_documents

    rows = docs.withColumn("_sheaf_row", F.monotonically_increasing_id())
    placed = shard_documents(rows, ["doc_id", "_sheaf_row"]).select(F.col("kept._sheaf_row").alias("_sheaf_row"), "shard", "slot")
    own = [rows[c] for c in docs.columns if c not in ("shard", "slot")]
    return rows.join(placed, "_sheaf_row").select(*own, placed["shard"], placed["slot"])


STAGES = [("language_id", language_id), ("simhash_near_dedup", simhash_near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("source_mixing", source_mixing), ("sharding", sharding)]

#: Fingerprint links and label propagation have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs, name)
    return docs
