"""Keyword top-k without scoring every match: blocks of postings with upper bounds.

Chunks are dealt into cells of about ``CELL`` chunks, pieces of a filing that follow
one another into the same one.  The postings of a term in a cell are one row, a block:
its greatest term frequency and its least chunk length bound what any chunk in it can score for the
term, and the sum over a query's terms bounds a cell.  A first pass scores the cells with the
greatest bounds and gives the k-th best score so far; only cells whose bound reaches that are
scored in the second pass.  The result is exact: a skipped cell holds no better chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import tokens
from sheaf.operators.keyword import CHUNKS_AT_ONCE, KEY, _bm25, counted, words_of
from sheaf.plans.layout import stored

CELL = 128             # chunks of a cell, about
TOGETHER = 32          # chunks of a filing that share a cell
CHUNKS_PER_TASK = 50_000   # whose blocks one task makes and writes
BLOCK_DDL = ("term string, cell long, n int, max_tf int, min_dl int, "
             "list array<struct<accession_number: string, chunk_index: int, tf: int, dl: int>>")


def blocks_of(chunks: DataFrame, n_chunks: int) -> DataFrame:
    """The ``n_chunks`` chunks (key, content) of a write -> its blocks.

    Chunks meet by cell, and a task makes the blocks of its cells: a text is shuffled once, its postings never."""
    cells = max(1, -(-n_chunks // CELL))
    group = F.floor(F.col("chunk_index") / TOGETHER)
    cell = F.pmod(F.xxhash64("accession_number", group), F.lit(cells)).cast("long")
    spark = chunks.sparkSession
    tasks = max(1, min(cells, max(spark.sparkContext.defaultParallelism, -(-n_chunks // CHUNKS_PER_TASK))))
    dealt = chunks.select(cell.alias("cell"), *KEY, "content").repartition(tasks, "cell").sortWithinPartitions("cell", *KEY)
    kinds = pa.struct([("accession_number", pa.string()), ("chunk_index", pa.int32()), ("tf", pa.int32()), ("dl", pa.int32())])

    def made(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        column = lambda c: part.column(c).combine_chunks() if part.column(c).num_chunks != 1 else part.column(c).chunk(0)
        of = column("cell").to_numpy(zero_copy_only=False)
        words, row, dl = words_of(column("_t"))
        terms, cell_, term, row, tf = counted(words, np.cumsum(np.r_[0, of[1:] != of[:-1]])[row], row)
        start = np.flatnonzero(np.r_[True, (cell_[1:] != cell_[:-1]) | (term[1:] != term[:-1])]) if len(row) else np.zeros(0, np.int64)
        number = lambda x: pa.array(x.astype(np.int32))
        size, none = np.diff(np.r_[start, len(row)]), np.zeros(0, np.int64)
        least, most = (f.reduceat(x, start) if len(row) else none for f, x in ((np.minimum, dl[row]), (np.maximum, tf)))
        at = pa.array(row)
        lists = pa.StructArray.from_arrays([column("accession_number").take(at), column("chunk_index").cast(pa.int32()).take(at), number(tf), number(dl[row])], fields=list(kinds))
        return pa.RecordBatch.from_arrays([terms.take(pa.array(term[start])), pa.array(of[row[start]].astype(np.int64)), number(size), number(most), number(least),
                                           pa.ListArray.from_arrays(number(np.r_[start, len(row)]), lists)], ["term", "cell", "n", "max_tf", "min_dl", "list"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []                             # chunks of cells that are not over
        for batch in batches:
            of, a = batch.column("cell").to_numpy(zero_copy_only=False), 0
            for b in np.flatnonzero(of[1:] != of[:-1]) + 1:         # a cell ends; enough of them together
                if b - a + sum(h.num_rows for h in held) >= CHUNKS_AT_ONCE:
                    yield made(pa.Table.from_batches([*held, batch.slice(a, b - a)]))
                    held, a = [], int(b)
            if a < batch.num_rows:
                held.append(batch.slice(a))
            if sum(h.num_rows for h in held) >= CHUNKS_AT_ONCE and held[0].column("cell")[0] != held[-1].column("cell")[-1]:
                whole = pa.Table.from_batches(held)
                of = whole.column("cell").to_numpy()
                last = int(np.searchsorted(of, of[-1]))
                yield made(whole.slice(0, last))
                held = whole.slice(last).to_batches()
        if held:
            yield made(pa.Table.from_batches(held))

    return dealt.select("cell", *KEY, tokens("content").alias("_t")).mapInArrow(run, BLOCK_DDL)


def postings_in(blocks: DataFrame, *keep: str) -> DataFrame:
    """Blocks -> postings: the ``keep`` columns, term, key, tf, dl."""
    return blocks.select(*keep, "term", F.explode("list").alias("_p")).select(*keep, "term", "_p.*")


@dataclass
class Pruned:
    """A search's result, the cells that hold a term of it, and those that were scored."""

    top: DataFrame             # entry, key, rank: at most k rows
    all: DataFrame
    near: DataFrame

    @property
    def cells(self) -> int:
        return self.all.count()

    @property
    def scored(self) -> int:
        return self.near.count()


def pruned_top_k(blocks: DataFrame, df: dict[str, int], n: float, avgdl: float, k: int,
                 keep: Callable[[DataFrame], DataFrame], match_all: bool = False, first: int | None = None) -> Pruned:
    """The k chunks of greatest BM25 score.

    ``blocks``: (entry, and the columns of ``blocks_of``) of the terms in ``df``, a cell
    being (entry, cell).  ``keep`` takes scored rows (entry, key, rank) and leaves
    those that may be in the result.  ``first``: cells of the first pass.
    """
    spark = blocks.sparkSession
    terms = spark.createDataFrame([(t, float(d)) for t, d in df.items()], "term string, df double")
    blocks = blocks.join(F.broadcast(terms), "term")                # a query's terms
    double = lambda c: F.col(c).cast("double")
    weight = lambda tf, dl: _bm25(double(tf), double(dl), F.col("df"), F.lit(n), F.lit(avgdl))
    cells = blocks.groupBy("entry", "cell").agg(F.sum(weight("max_tf", "min_dl")).alias("bound"), F.count("*").alias("n_terms"))
    cells = stored(cells.filter(F.col("n_terms") == len(df)) if match_all else cells, "cells")
    order = [F.round("rank", 6).desc(), *KEY]

    def score(some: DataFrame) -> DataFrame:
        scored = (postings_in(blocks.join(some.select("entry", "cell"), ["entry", "cell"]), "entry", "df")
                  .groupBy("entry", *KEY).agg(F.sum(weight("tf", "dl")).alias("rank"), F.count("*").alias("n_match")))
        scored = scored.filter(F.col("n_match") == len(df)) if match_all else scored
        return keep(scored.select("entry", *KEY, "rank")).orderBy(*order).limit(k)

    start = cells.orderBy(F.desc("bound"), "entry", "cell").limit(first or max(16, 2 * k))
    best = score(start).select(F.round("rank", 6).alias("r")).collect()               # k numbers
    enough = min(r.r for r in best) - 1e-6 if len(best) == k else float("-inf")
    near = cells.filter(F.col("bound") >= enough)
    return Pruned(score(near), cells, near)
