"""Semantic (cosine) search: Q2, J7, T2, T3, K10.

* One query vector: the distance is a column expression against a constant
  (a literal or a scalar subquery), so the plan is scan -> project ->
  TakeOrderedAndProject; no join at all.
* A batch of query vectors: a grid of query blocks and chunk blocks.  A cell compares one
  block of each as a matrix and keeps the best k per query, and a final
  ``row_number() <= k`` picks the global top k.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.config import SEARCH_TOP_K
from sheaf.functions.vector import cosine_distance, l2_normalize
from sheaf.operators.keyword import KEY, apply_filing_filters


def vector_literal(vec) -> Column:
    return F.array(*[F.lit(float(x)).cast("float") for x in vec])


def centroid(df: DataFrame, col: str = "embedding") -> list[float]:
    """Unit-length mean vector of a vector column.

    The per-dimension mean is a partial+final aggregate keyed by position, safe
    at any row count; only the single resulting vector (``dim`` floats) comes
    back to the driver, to be used as the query constant.
    """
    per_dim = (df.select(F.posexplode(col).alias("pos", "x"))
               .groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("m")))
    vec = per_dim.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))),
                                  lambda s: s["m"].cast("float")).alias("v"))
    row = vec.select(l2_normalize("v").alias("u")).first()
    return list(row.u or [])


def semantic_scores(chunks: DataFrame, query_vec, col: str = "embedding") -> DataFrame:
    q = query_vec if isinstance(query_vec, Column) else vector_literal(query_vec)
    return chunks.select(*[c for c in chunks.columns if c != col], cosine_distance(col, q).alias("distance"))


def semantic_search(chunks: DataFrame, query_vec, top_k: int = SEARCH_TOP_K, filings: DataFrame | None = None,
                    ticker: str | None = None, form: str | None = None) -> DataFrame:
    """Q2: top-k chunks by cosine distance (NaN last), ties by key."""
    scored = semantic_scores(chunks, query_vec)
    if filings is not None:
        scored = apply_filing_filters(scored, filings, ticker, form)
    order = [F.round("distance", 6).asc_nulls_last(), F.col("accession_number"), F.col("chunk_index")]
    return scored.orderBy(*order).limit(top_k)


QUERY_BLOCK = 1024         # queries of a cell
CHUNK_BYTES = 64 << 20     # of chunk vectors (4 bytes a value) in a cell
SLICE = 4096               # chunks compared with a cell's queries at once


def _best_of_cell(k: int, col: str):
    """cogroup body: the k best chunks of a cell for each of the cell's queries."""

    def run(chunks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(chunks) and len(queries):
            qids, qmat = queries["query_id"].to_numpy(), np.stack(queries["vec"].to_numpy()).astype(np.float64)
            qnorm = np.linalg.norm(qmat, axis=1)
            acc, idx = chunks["accession_number"].to_numpy(), chunks["chunk_index"].to_numpy()
            best: list[list[tuple]] = [[] for _ in qids]          # (rounded distance, key.., distance)
            for lo in range(0, len(chunks), SLICE):
                mat = np.stack(chunks[col].to_numpy()[lo:lo + SLICE]).astype(np.float64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    sim = (qmat @ mat.T) / np.outer(qnorm, np.linalg.norm(mat, axis=1))
                dist = 1.0 - np.clip(sim, -1.0, 1.0)
                dist[~np.isfinite(sim)] = np.nan
                key = np.where(np.isnan(dist), np.inf, np.round(dist, 6))
                for q, row in enumerate(key):
                    near = np.flatnonzero(row <= np.partition(row, k - 1)[k - 1]) if len(row) > k else np.arange(len(row))
                    best[q] += [(row[i], acc[lo + i], int(idx[lo + i]), dist[q, i]) for i in near]
                    if len(best[q]) > 2 * k:
                        best[q].sort(key=lambda t: t[:3])
                        del best[q][k:]
            rows = [(int(q), a, i, d) for q, mine in zip(qids, best, strict=True) for _, a, i, d in sorted(mine, key=lambda t: t[:3])[:k]]
        return pd.DataFrame(rows, columns=["query_id", *KEY, "distance"])

    return run


def semantic_search_batch(chunks: DataFrame, queries: DataFrame, top_k: int = SEARCH_TOP_K, col: str = "embedding",
                          query_block: int = QUERY_BLOCK, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """T3/J7 batch: ``queries(query_id long, vec array<float>)`` against ``chunks``.

    A grid of cells: queries are dealt into blocks of about ``query_block``, chunks into blocks of about
    ``chunk_bytes``, both by hash; a cell is a task's share, one block of each, and keeps k
    rows per query.  Nothing passes the driver but two counts, and the plan is the same for any number of queries.
    """
    spark = chunks.sparkSession
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    n_chunks = chunks.filter(F.col(col).isNotNull()).count()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    q_blocks = max(1, -(-size.n // query_block))
    c_blocks = max(1, min(n_chunks, max(least, -(-n_chunks * 4 * max(1, size.dim or 1) // chunk_bytes))))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (chunks.filter(F.col(col).isNotNull()).select(*KEY, col, F.pmod(F.xxhash64(*KEY), F.lit(c_blocks)).cast("int").alias("cb"))
            .select("*", every(q_blocks).alias("qb")))
    right = (queries.filter("vec IS NOT NULL").select(F.col("query_id").cast("long").alias("query_id"), "vec",
                                                      F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int").alias("qb"))
             .select("*", every(c_blocks).alias("cb")))
    scored = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(
        _best_of_cell(top_k, col), "query_id long, accession_number string, chunk_index int, distance double")
    w = Window.partitionBy("query_id").orderBy(F.round("distance", 6).asc_nulls_last(), "accession_number",
                                               "chunk_index")
    return (scored.withColumn("rank_no", F.row_number().over(w)).filter(F.col("rank_no") <= top_k)
            .select("query_id", F.col("rank_no").cast("int").alias("rank_no"), "accession_number", "chunk_index",
                    "distance"))


def lsh_index(chunks: DataFrame, bucket_length: float = 0.5, num_tables: int = 8, col: str = "embedding",
              seed: int = 7):
    """Random-projection LSH model and the hashed chunk table."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.feature import BucketedRandomProjectionLSH

    vecs = chunks.select(*KEY, array_to_vector(l2_normalize(col)).alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket_length,
                                        numHashTables=num_tables, seed=seed).fit(vecs)
    return model, model.transform(vecs)


def lsh_search(model, hashed: DataFrame, query_vec, top_k: int = SEARCH_TOP_K) -> DataFrame:
    """Approximate top-k by LSH buckets; distance reported as cosine distance.

    For unit vectors the Euclidean order equals the cosine order.
    """
    from pyspark.ml.linalg import Vectors

    q = Vectors.dense([float(x) for x in query_vec])
    n = float(np.linalg.norm(q.toArray())) or 1.0
    qn = Vectors.dense((q.toArray() / n).tolist())
    res = model.approxNearestNeighbors(hashed, qn, top_k, distCol="euclid")
    return res.select(*KEY, (F.col("euclid") * F.col("euclid") / 2.0).alias("distance"))
