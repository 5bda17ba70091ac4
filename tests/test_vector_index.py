"""The stored vector index against exact search, and the grid of the batch searches."""

import os
import tempfile

import numpy as np
import pytest

from sheaf.operators import keyword, semantic
from sheaf.operators.ivf import VectorIndex, build_ivf

CHUNK = "accession_number string, chunk_index int, embedding array<float>"


def _clusters(spark, n=3000, dim=32, groups=25, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dim))
    x = centers[rng.integers(0, groups, n)] + 0.4 * rng.normal(size=(n, dim))
    return x, spark.createDataFrame([(f"f{k // 7}", k % 7, v.tolist()) for k, v in enumerate(x.astype(np.float32))], CHUNK)


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_stored_index_finds_the_nearest_and_reads_less(spark):
    x, chunks = _clusters(spark)
    odd = spark.createDataFrame([("zero", 0, [0.0] * 32), ("none", 0, None)], CHUNK)
    path = tempfile.mkdtemp(prefix="sheaf-ivf-")
    build_ivf(chunks.unionByName(odd), path)
    index = VectorIndex(spark, path)                                   # read back from disk
    assert index.dim == 32 and index.vectors.sum() == len(x) and index.probes < len(index.cells) and index.recall >= 0.95
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = 0
    for k in range(0, 3000, 250):
        exact = {(f"f{j // 7}", j % 7) for j in np.argsort(-(unit @ unit[k]), kind="stable")[:10]}
        got = index.search(x[k].tolist(), 10).collect()
        found += len(exact & {(r.accession_number, r.chunk_index) for r in got})
        assert [r.distance for r in got] == pytest.approx([1 - float(unit[int(r.accession_number[1:]) * 7 + r.chunk_index] @ unit[k]) for r in got], abs=1e-6)
    assert found >= 0.9 * 120
    codes = sum(_bytes(f"{path}/codes/cell={c}") for c in index.nearest_cells(x[0].tolist()))
    assert codes < 0.2 * _bytes(f"{path}/vectors")                     # what the first step of a query reads


def test_an_index_of_nothing(spark):
    path = tempfile.mkdtemp(prefix="sheaf-ivf-")
    build_ivf(spark.createDataFrame([("zero", 0, [0.0, 0.0])], CHUNK), path)
    assert VectorIndex(spark, path).search([1.0, 0.0], 3).count() == 0


def test_semantic_grid_of_many_cells_equals_single_queries(spark):
    x, chunks = _clusters(spark, n=200, dim=8)
    queries = spark.createDataFrame([(k, x[k * 7].tolist()) for k in range(12)] + [(99, [0.0] * 8)], "query_id long, vec array<float>")
    got = semantic.semantic_search_batch(chunks, queries, 4, query_block=5, chunk_bytes=1000)
    rows = {}
    for r in got.orderBy("query_id", "rank_no").collect():
        rows.setdefault(r.query_id, []).append((r.accession_number, r.chunk_index))
    for k in range(12):
        one = semantic.semantic_search(chunks, x[k * 7].tolist(), 4).collect()
        assert rows[k] == [(r.accession_number, r.chunk_index) for r in one]
    assert len(rows[99]) == 4                                          # no direction: the first keys
    more = spark.createDataFrame([(k, x[k].tolist()) for k in range(200)], "query_id long, vec array<float>")
    size = lambda q: semantic.semantic_search_batch(chunks, q, 4, query_block=5)._jdf.queryExecution().logical().treeString().count("\n")
    assert size(queries) == size(more)                                 # the plan does not grow with the queries


def test_keyword_grid_of_many_cells_equals_single_queries(spark, monkeypatch):
    monkeypatch.setattr(keyword, "QUERY_BLOCK", 2)
    monkeypatch.setattr(keyword, "CELL_CHUNKS", 9)
    monkeypatch.setattr(keyword, "SLICE", 3)
    rng = np.random.default_rng(3)
    words = ["pump", "valve", "river", "stone", "the"]
    rows = [(f"f{k // 4}", k % 4, " ".join(rng.choice(words, rng.integers(1, 12), p=[.1, .1, .1, .2, .5])), "{}") for k in range(90)]
    chunks = spark.createDataFrame(rows, "accession_number string, chunk_index int, content string, metadata string")
    index, filings = keyword.build_index(chunks), chunks.select("accession_number").distinct()
    asked = ["pump valve", "the", "river the stone", "nowhere", "...", "pump"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, text string")
    for match_all in (False, True):
        got = {}
        for r in keyword.keyword_search_batch(index, chunks, queries, 3, match_all).orderBy("query_id", "rank_no").collect():
            got.setdefault(r.query_id, []).append((r.accession_number, r.chunk_index, round(r["rank"], 6), r.content))
        for k, q in enumerate(asked):
            one = keyword.keyword_search(index, chunks, filings, q, 3, match_all=match_all).collect()
            assert got.get(k, []) == [(r.accession_number, r.chunk_index, round(r["rank"], 6), r.content) for r in one]
