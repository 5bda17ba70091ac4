"""Vectors that were made once are not made again.

A cache table keeps the vector of a text by the text's hash and the encoder, bucketed by hash.
``embed_cached`` encodes the distinct texts that the cache lacks, adds them, and joins; a
second run over the same texts encodes nothing, whichever filings they stand in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.embed import HashingEncoder, embed
from sheaf.plans.layout import stored

BUCKETS = 16
DDL = "text_hash string, embedding array<float>"


@dataclass
class VectorCache:
    """``folder``/encoder=<name>/bucket=<k>/ on shared storage; only added to."""

    spark: SparkSession
    folder: str

    def _place(self, encoder) -> str:
        return f"{self.folder.rstrip('/')}/encoder={encoder.name}-{encoder.dim}"

    def read(self, encoder, buckets: list[int] | None = None) -> DataFrame:
        """(text_hash, embedding) of one encoder, one row per text; only the ``buckets`` are listed."""
        base = self._place(encoder)
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(conf)
        there = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        names = [n for n in there if n.startswith("bucket=") and (buckets is None or int(n[7:]) in buckets)]
        if not names:
            return self.spark.createDataFrame([], DDL)
        rows = self.spark.read.schema(f"{DDL}, bucket int").option("basePath", base).parquet(*[f"{base}/{n}" for n in sorted(names)])
        return rows.groupBy("text_hash").agg(F.first("embedding").alias("embedding"))      # two writers may have added one

    def add(self, encoder, rows: DataFrame) -> None:
        bucket = F.pmod(F.xxhash64("text_hash"), F.lit(BUCKETS)).cast("int")
        rows.select("text_hash", "embedding", bucket.alias("bucket")).hint("rebalance", F.col("bucket")).write.mode("append").partitionBy(
            "bucket").parquet(self._place(encoder))


def embed_cached(df: DataFrame, cache: VectorCache, text_col: str = "content", encoder=None, out_col: str = "embedding",
                 error_col: str | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``out_col`` (as ``embed`` does), and how many texts had to be encoded.

    A text that cannot be encoded gets a null vector, its message in ``error_col`` (without
    one the job fails), and is tried again next time.
    """
    enc = encoder or HashingEncoder()
    rows = df.withColumn("_hash", F.sha2(F.coalesce(text_col, F.lit("")), 256))
    texts = stored(rows.groupBy(F.col("_hash").alias("text_hash")).agg(F.first(F.coalesce(text_col, F.lit(""))).alias("_text")), "texts")
    bucket = F.pmod(F.xxhash64("text_hash"), F.lit(BUCKETS)).cast("int")
    buckets = [r.b for r in texts.select(bucket.alias("b")).distinct().collect()]          # BUCKETS numbers at most
    # hashes tell what is new; the texts themselves are neither shuffled for it nor written again
    new = stored(texts.select("text_hash").join(cache.read(enc, buckets).select("text_hash"), "text_hash", "left_anti"), "new")
    count = new.count()
    failed = df.sparkSession.createDataFrame([], "text_hash string, error string")
    if count:
        todo = texts if count == texts.count() else texts.join(new, "text_hash", "left_semi")
        made = stored(embed(todo, "_text", enc, "embedding", error_col="_error" if error_col else None).drop("_text"), "made")
        if error_col:
            failed = made.filter("_error IS NOT NULL").select("text_hash", F.col("_error").alias("error"))
            made = made.filter("_error IS NULL")
        cache.add(enc, made)
    out = rows.join(cache.read(enc, buckets).select(F.col("text_hash").alias("_hash"), F.col("embedding").alias(out_col)), "_hash", "left")
    if error_col:
        out = out.join(failed.select(F.col("text_hash").alias("_hash"), F.col("error").alias(error_col)), "_hash", "left")
    return out.drop("_hash"), count
