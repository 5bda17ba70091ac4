"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, so nearness by cosine is nearness by Euclidean
distance.  A table hashes a vector by ``FUNCTIONS`` random projections, shifted and cut
into steps of ``STEP``; the cells are its bucket.  A query visits, in each
table, the buckets whose cells differ from its own by at most one step, in order of
estimated success (the squared distances of its projections to the crossed cell
borders, summed), ``PROBES`` of them.  The tables' candidates are merged and
ranked by the exact measure.

The index is cut into shards of bounded size with their own tables, one row each,
written once.  Queries travel in blocks: each block meets each shard in some task, which
reads a few shards and then the blocks one after the other (no join, so nothing is
broadcast), and only its k best in those shards leave it.  Equal vectors are one entry that carries its
smallest ids, as many as an answer can need, so a vector on a third of all rows makes
no large bucket.  A query whose probes find too little in a shard scans that shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import product
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.llm.common import settle

TABLES = 12
FUNCTIONS = 6
STEP = 1.2
PROBES = 200
SEED = 42
SHARD_CELLS = 1 << 18          # numbers in a shard's vectors
BLOCK_QUERIES = 512
TASK_BYTES = 64 << 20          # of shards that a task holds,
SEARCH_TASKS = 48              # fewer if there are so many shards
CELLS_AT_ONCE = 1 << 22        # pairs of query and entry looked at together
NEAR = 1e-9                    # more than cosines by a matrix product differ from those by rows


class Hashes:
    """The tables' projections for vectors of one length, the same in every task."""

    def __init__(self, dim: int, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.directions = rng.normal(size=(TABLES, FUNCTIONS, dim))
        self.shifts = rng.uniform(0, STEP, size=(TABLES, FUNCTIONS))
        self.places = 4099 ** np.arange(FUNCTIONS, dtype=np.int64)
        self.moves = np.array(list(product((-1, 0, 1), repeat=FUNCTIONS)), np.int64)

    def cells(self, table: int, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (unit @ self.directions[table].T + self.shifts[table]) / STEP
        return np.floor(at).astype(np.int64), at - np.floor(at)

    def keys(self, cells: np.ndarray) -> np.ndarray:
        return cells @ self.places

    def probes(self, table: int, unit: np.ndarray) -> np.ndarray:
        """Bucket keys to visit, in any order."""
        cells, inside = self.cells(table, unit)
        crossing = np.stack([inside ** 2, np.zeros_like(inside), (1 - inside) ** 2], axis=2)      # down, stay, up
        cost = crossing[:, 0]
        for i in range(1, FUNCTIONS):                             # in the order of moves
            cost = (cost[:, :, None] + crossing[:, i, None, :]).reshape(len(unit), -1)
        best = np.argpartition(cost, PROBES - 1, axis=1)[:, :PROBES]
        last = np.take_along_axis(cost, best[:, -1:], axis=1)
        tied = np.flatnonzero((cost <= last).sum(axis=1) > PROBES)
        best[tied] = np.argsort(cost[tied], axis=1, kind="stable")[:, :PROBES]
        return self.keys(cells)[:, None] + self.keys(self.moves)[best]


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two (which changes no cosine by a bit), so that squares of very large or small numbers fit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part, one per vec_id."""
    v = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding"))
    fine = F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter(fine).filter(F.exists("embedding", lambda x: x != 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def build_index(vectors: DataFrame, k: int) -> tuple[DataFrame, int, int]:
    """``usable`` rows -> one row per shard (dim, shard, n, vectors, ids, keys, entries),
    settled, the number of shards per vector length, and of groups of shards that tasks hold."""
    place = Window.partitionBy("embedding").orderBy("vec_id")
    entries = (vectors.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k + 1)
               .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))     # at most k + 1
    entries = settle(entries.withColumn("dim", F.size("embedding")), "entries")
    numbers, rows = entries.agg(F.coalesce(F.sum("dim"), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-numbers // SHARD_CELLS))
    size = 8 * numbers + (8 * (k + 1) + 12 * TABLES) * rows
    groups = min(shards, max(SEARCH_TASKS, -(-size // TASK_BYTES)))
    placed = entries.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))

    def build(key, f: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        x = np.stack(f["embedding"].to_numpy()).astype("<f8")
        ids = np.full((len(f), k + 1), -1, "<i8")
        for i, own in enumerate(f["ids"]):
            ids[i, :len(own)] = own
        hashes, unit, keys, order = Hashes(dim), units(x), [], []
        for t in range(TABLES):
            bucket = hashes.keys(hashes.cells(t, unit)[0])
            order.append(np.argsort(bucket, kind="stable").astype("<i4"))
            keys.append(bucket[order[-1]].astype("<i8"))
        return pd.DataFrame({"dim": [dim], "shard": [int(key[1])], "n": [len(f)], "vectors": [x.tobytes()], "ids": [ids.tobytes()],
                             "keys": [np.stack(keys).tobytes()], "entries": [np.stack(order).tobytes()]})

    built = placed.groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard int, n int, vectors binary, ids binary, keys binary, entries binary")
    return settle(built, "index"), shards, groups


def query_blocks(queries: DataFrame) -> DataFrame:
    """(vec_id, embedding) -> one row per block (dim, block, query_ids, queries)."""
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    placed = queries.withColumns({"dim": F.size("embedding"), "block": F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")})

    def pack(key, f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dim": [int(key[0])], "block": [int(key[1])], "query_ids": [f["vec_id"].to_numpy().astype("<i8").tobytes()],
                             "queries": [np.stack(f["embedding"].to_numpy()).astype("<f8").tobytes()]})

    return placed.groupBy("dim", "block").applyInPandas(pack, "dim int, block int, query_ids binary, queries binary")


def shard_of(r: dict, k: int) -> SimpleNamespace:
    """A shard's row, read for ``search_shard``; per table its bucket keys, each once, and which one an entry has."""
    x = scaled(np.frombuffer(r["a"], "<f8").reshape(r["n"], r["dim"]))
    length = np.linalg.norm(x, axis=1)
    keys = np.frombuffer(r["c"], "<i8").reshape(TABLES, r["n"])
    entries = np.frombuffer(r["d"], "<i4").reshape(TABLES, r["n"])
    buckets = []
    for t in range(TABLES):
        new = np.r_[True, keys[t][1:] != keys[t][:-1]]
        of = np.empty(r["n"], np.int32)
        of[entries[t]] = np.cumsum(new) - 1
        buckets.append((keys[t][new], of))
    return SimpleNamespace(n=r["n"], x=x, length=length, ids=np.frombuffer(r["b"], "<i8").reshape(r["n"], k + 1), buckets=buckets)


def block_of(r: dict, hashes: Hashes) -> SimpleNamespace:
    """A query block's row, read for ``search_shard``; per table the keys to visit, each once, where its queries begin, and the queries."""
    own = np.frombuffer(r["b"], "<i8")
    q = scaled(np.frombuffer(r["a"], "<f8").reshape(len(own), r["dim"]))
    unit, probes = units(q), []
    for t in range(TABLES):
        keys = hashes.probes(t, unit).ravel()
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        probes.append((keys[first], np.r_[first, len(keys)], order // PROBES))
    return SimpleNamespace(own=own, q=q, length=np.linalg.norm(q, axis=1), probes=probes)


def visited(shard: SimpleNamespace, block: SimpleNamespace, lo: int, hi: int) -> np.ndarray:
    """Entry, query (from ``lo`` to ``hi``): whether the entry is in a bucket that the query visits."""
    seen = np.zeros((shard.n, hi - lo), bool)
    for (keys, of), (asked, first, who) in zip(shard.buckets, block.probes, strict=True):
        at = np.minimum(np.searchsorted(asked, keys), len(asked) - 1)
        there = np.flatnonzero(asked[at] == keys)
        at = at[there]
        n = first[at + 1] - first[at]
        queries = who[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at], n)]
        bucket = np.repeat(there, n)
        mine = (queries >= lo) & (queries < hi)
        visits = np.zeros((len(keys), hi - lo), bool)
        visits[bucket[mine], queries[mine] - lo] = True
        seen |= visits[of]
    return seen


def best_of(owner: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each owner."""
    order = np.lexsort((vec, -score, owner))
    owner = owner[order]
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][:len(owner)])
    keep = np.arange(len(owner)) - np.repeat(start, np.diff(np.r_[start, len(owner)])) < k
    return owner[keep], vec[order[keep]], score[order[keep]]


def search_shard(shard: SimpleNamespace, block: SimpleNamespace, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The k best of one shard for each query of one block: query's place in the block, vec_id, score."""
    wide = max(1, CELLS_AT_ONCE // shard.n)
    for lo in range(0, len(block.own), wide):
        hi = min(lo + wide, len(block.own))
        seen = np.ascontiguousarray(visited(shard, block, lo, hi).T)
        few = seen.sum(axis=1) <= k
        seen[few] = True
        near = (block.q[lo:hi] @ shard.x.T) / shard.length / block.length[lo:hi, None]
        near[~seen] = -np.inf
        if shard.n > k + 1:
            least = np.partition(near, shard.n - k - 1, axis=1)[:, shard.n - k - 1]
            seen &= near >= (least - NEAR)[:, None]
        i, j = np.nonzero(seen)
        a = 0
        while a < len(i):                                         # whole queries
            b = len(i)
            if b - a > CELLS_AT_ONCE // 32:
                b = max(int(np.searchsorted(i, i[a + CELLS_AT_ONCE // 32])), int(np.searchsorted(i, i[a], side="right")))
            one, entry = i[a:b] + lo, j[a:b]
            score = np.einsum("ij,ij->i", shard.x[entry], block.q[one]) / (shard.length[entry] * block.length[one])
            owner, every, same = np.repeat(one, k + 1), shard.ids[entry].ravel(), np.repeat(score, k + 1)
            good = (every >= 0) & (every != block.own[owner])
            yield best_of(owner[good], every[good], same[good], k)
            a = b


@contextmanager
def few_rows_a_batch(spark: SparkSession, rows: int = 4):
    """Rows that hold a shard each go to Python a few at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def nearest(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of ``vectors`` (vec_id,
    embedding) that ``is_query`` (a column over vec_id), its k nearest found among all others by cosine.

    Ties go to the smaller vec_id.  Rows with a null vec_id, or a vector that is null,
    empty, zero or holds a null or non-finite number, take no part; of several rows of one vec_id
    the smallest vector does.  Vectors of different lengths are never neighbours.  A
    query with fewer than k candidates gets them all; empty tables give no rows.
    """
    spark = vectors.sparkSession
    kept = settle(usable(vectors), "vectors")
    index, shards, groups = build_index(kept, k)
    blocks = settle(query_blocks(kept.filter(is_query)), "queries")
    none, group = F.lit(None).cast("binary"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    held = index.select("dim", F.pmod("shard", F.lit(groups)).alias("group"), F.lit(-1).alias("block"), "n",
                        F.col("vectors").alias("a"), F.col("ids").alias("b"), F.col("keys").alias("c"), F.col("entries").alias("d"))
    asked = blocks.select("dim", group.alias("group"), "block", F.lit(0).alias("n"),
                          F.col("queries").alias("a"), F.col("query_ids").alias("b"), none.alias("c"), none.alias("d"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * groups)
    # a group's shards come first, then every block
    met = held.unionByName(asked).repartition(tasks, "dim", "group").sortWithinPartitions("dim", "group", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hashes, together = None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if now != (r["dim"], r["group"]):
                    now, hashes, together = (r["dim"], r["group"]), Hashes(r["dim"]), []
                if r["block"] < 0:
                    together.append(shard_of(r, k))
                elif together:
                    block = block_of(r, hashes)
                    found = [f for shard in together for f in search_shard(shard, block, k)]
                    owner, vec, score = best_of(*(np.concatenate(c) for c in zip(*found, strict=True)), k)
                    yield pa.RecordBatch.from_arrays([pa.array(block.own[owner]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

    with few_rows_a_batch(spark):
        found = settle(met.mapInArrow(search, "query_id long, vec_id long, score double"), "found")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
