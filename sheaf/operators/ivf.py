"""A stored vector index: an inverted file with compact codes and exact reranking.

Vectors are dealt to the nearest of ``cells`` centroids, which k-means finds on a bounded
sample.  ``codes`` holds one byte per value and ``vectors`` the vectors as they are, both partitioned by
cell.  A query reads the codes of the cells nearest to it only, and then
the vectors of the best candidates, whose distances are exact.  How many cells a query
visits is measured when the index is built: the least number that finds the wished share of true
neighbours for a sample of vectors.

Layout under a folder: ``cells`` (cell, centroid, vectors), ``meta`` (dim, probes, recall), ``codes`` and
``vectors`` by ``cell=<k>``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.config import SEARCH_TOP_K
from sheaf.functions.vector import cosine_distance, sq_norm
from sheaf.operators.keyword import KEY
from sheaf.operators.semantic import semantic_search_batch, vector_literal
from sheaf.plans.layout import stored

MOST_CELLS = 4096
SAMPLE = 20_000            # vectors that k-means sees
QUERIES = 50               # of them, to measure recall with
RECALL = 0.95              # of the ten nearest, in the visited cells
RERANK = 8                 # candidates per wished row
SALTS = 4                  # files of a cell, at most


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1.0)


def _stack(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)


def build_ivf(chunks: DataFrame, path: str, cells: int | None = None, sample: int = SAMPLE, col: str = "embedding",
              recall: float = RECALL, seed: int = 7) -> None:
    """Index ``chunks`` (key, embedding) under ``path``.  ``cells``: by default the root of the number of
    vectors, ``MOST_CELLS`` at most.  Null, zero and non-finite vectors have no direction and are not indexed."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark, norm = chunks.sparkSession, sq_norm(col)
    usable = chunks.select(*KEY, F.col(col).alias("embedding")).filter(F.col(col).isNotNull() & (norm > 0) & (norm < float("inf")))
    n = usable.count()
    cells = max(1, min(MOST_CELLS, cells or round(n**0.5)))
    at = F.shiftrightunsigned(F.xxhash64(*KEY), 11)                      # 0 to 2**53
    some = stored(usable.filter(at < float(1 << 53) * min(1.0, 2.0 * sample / max(n, 1))).orderBy(at).limit(sample), "sample")
    if n:
        unit = some.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
        model = KMeans(k=cells, distanceMeasure="cosine", maxIter=10, seed=seed).fit(unit)
        centers = _unit(np.array(model.clusterCenters()))
    else:
        centers = np.zeros((0, 1))
    shared = spark.sparkContext.broadcast(centers)                        # MOST_CELLS rows at most

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            x = _unit(_stack(f["embedding"]))
            top = np.abs(x).max(axis=1)
            code = np.round(x / top[:, None] * 127).astype(np.int8)
            yield f.assign(cell=(x @ shared.value.T).argmax(axis=1).astype(np.int32), code=[c.tobytes() for c in code], scale=top / 127)

    dealt = stored(usable.mapInPandas(assign, "accession_number string, chunk_index int, embedding array<float>, cell int, code binary, scale double"), "dealt")
    salt = F.pmod(F.xxhash64(*KEY), F.lit(SALTS))
    for table, columns in (("codes", ["code", "scale"]), ("vectors", ["embedding"])):
        (dealt.select("cell", *KEY, *columns).repartition("cell", salt).sortWithinPartitions("cell", *KEY)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("cell").parquet(f"{path}/{table}"))
    sizes = {r["cell"]: r["n"] for r in dealt.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    rows = [(k, [float(v) for v in c], sizes.get(k, 0)) for k, c in enumerate(centers)]
    spark.createDataFrame(rows, "cell int, centroid array<double>, vectors long").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    probes, found = _probes(dealt, some, centers, recall)
    meta = spark.createDataFrame([(centers.shape[1], probes, found)], "dim int, probes int, recall double")
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def _probes(dealt: DataFrame, some: DataFrame, centers: np.ndarray, recall: float) -> tuple[int, float]:
    """The least number of nearest cells that hold ``recall`` of the ten nearest of a sample's vectors, and their share."""
    asked = some.limit(QUERIES).withColumn("query_id", F.monotonically_increasing_id())
    asked = stored(asked.select("query_id", F.col("embedding").alias("vec")), "asked")
    near = semantic_search_batch(dealt, asked, 11).join(dealt.select(*KEY, "cell"), KEY).select("query_id", "cell").collect()
    vectors = {r["query_id"]: np.array(r["vec"], float) for r in asked.collect()}
    if not near:
        return 1, 1.0
    order = {q: np.argsort(np.argsort(-(centers @ v), kind="stable")) for q, v in vectors.items()}
    place = np.sort([order[r["query_id"]][r["cell"]] for r in near])
    need = int(place[max(0, int(np.ceil(recall * len(place))) - 1)]) + 1
    return need, float((place < need).mean())


@dataclass
class VectorIndex:
    spark: SparkSession
    path: str

    def __post_init__(self):
        cells = self.spark.read.parquet(f"{self.path}/cells").filter("vectors > 0").orderBy("cell").collect()
        self.cells = np.array([r["cell"] for r in cells], np.int64)
        self.centers = np.array([r["centroid"] for r in cells], float)
        self.vectors = np.array([r["vectors"] for r in cells], np.int64)
        meta = self.spark.read.parquet(f"{self.path}/meta").first()
        self.dim, self.probes, self.recall = meta["dim"], meta["probes"], meta["recall"]

    def _read(self, table: str, cells, schema: str) -> DataFrame:
        paths = [f"{self.path}/{table}/cell={int(c)}" for c in cells]
        return self.spark.read.schema(f"{schema}, cell int").option("basePath", f"{self.path}/{table}").parquet(*paths)

    def nearest_cells(self, query_vec, probes: int | None = None) -> list[int]:
        q = np.asarray(query_vec, float)
        return self.cells[np.argsort(-(self.centers @ q), kind="stable")[:probes or self.probes]].tolist() if len(self.cells) else []

    def candidates(self, query_vec, n: int, probes: int | None = None) -> DataFrame:
        """(key, cell, near): the ``n`` codes of the visited cells that are most alike."""
        cells = self.nearest_cells(query_vec, probes)
        q = _unit(np.asarray([query_vec], float))[0]
        out = "accession_number string, chunk_index int, cell int, near double"
        if not cells or not q.any():
            return self.spark.createDataFrame([], out)

        def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = None
            for f in frames:
                if not len(f):
                    continue
                code = np.frombuffer(b"".join(f["code"]), np.int8).reshape(len(f), -1)
                f = f[[*KEY, "cell"]].assign(near=(code @ q) * f["scale"].to_numpy())
                held = (f if held is None else pd.concat([held, f])).nlargest(n, "near")
            if held is not None:
                yield held

        codes = self._read("codes", cells, "accession_number string, chunk_index int, code binary, scale double")
        return codes.mapInPandas(best, out).orderBy(F.desc("near"), *KEY).limit(n)

    def search(self, query_vec, top_k: int = SEARCH_TOP_K, probes: int | None = None, rerank: int = RERANK) -> DataFrame:
        """(key, distance) of the nearest found, exact distances, nearest first, ties by key."""
        found = stored(self.candidates(query_vec, rerank * top_k, probes), "candidates")          # rerank * k rows
        cells = [r["cell"] for r in found.select("cell").distinct().collect()]
        schema = "accession_number string, chunk_index int, distance double"
        if not cells:
            return self.spark.createDataFrame([], schema)
        names = [r["accession_number"] for r in found.select("accession_number").distinct().collect()]
        rows = self._read("vectors", cells, "accession_number string, chunk_index int, embedding array<float>")
        rows = rows.filter(F.col("accession_number").isin(names)).join(F.broadcast(found.select(*KEY, "cell")), [*KEY, "cell"])
        scored = rows.select(*KEY, cosine_distance("embedding", vector_literal(query_vec)).alias("distance"))
        return scored.orderBy(F.round("distance", 6), *KEY).limit(top_k)
