"""Benchmark decontamination with an FM-index per shard of documents.

The benchmark's windows of words are the test phrases.  Documents run through
map-only tasks; every ``SHARD_WORDS`` words that could matter become one shard: its
words, as integers, are indexed (``fmindex``), all phrases are searched backwards
at once, occurrences located and their spans merged into hit words.

Words outside the benchmark's vocabulary can be in no occurrence, so a shard
keeps only runs of known words at least as long as the shortest phrase, each
ended by a separator.  That is exact and makes the index small.

Phrases go to the tasks in blocks of bounded size; a benchmark of many blocks
costs one pass over the documents per block, never a larger broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import running_totals, settle, small_batches
from sheaf.llm.fmindex import FMIndex

WINDOW = 10
SHARD_WORDS = 500_000
#: Bytes of documents that wait for their shard's index.
SHARD_BYTES = 64 << 20
#: Characters of benchmark text in one broadcast block.
BLOCK_CHARS = 8_000_000
#: Words are runs of 0-9, a-z (A-Z lower-cased) and non-ASCII
#: characters, whose UTF-8 bytes are all 128 or more; other bytes become spaces.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Phrases:
    """The distinct windows of a block of benchmark items, as integers."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 2) for w in words_of(text)]
            if ids:
                for k in range(max(1, len(ids) - window + 1)):
                    owners.setdefault(tuple(ids[k:k + window]), set()).add(item)
        self.vocabulary = vocabulary                              # 1 is the separator
        self.items = [sorted(x) for x in owners.values()]
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.rows = np.zeros((len(owners), window), np.int64)
        for k, w in enumerate(owners):
            self.rows[k, :len(w)] = w
        self.shortest = int(self.lengths.min()) if owners else 0


class Shard:
    """Documents gathered for one index."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.parts, self.docs, self.at, self.size = phrases, [], [], [], 0

    def add(self, doc: int, words: list[bytes]) -> None:
        p = self.phrases
        if not p.shortest or len(words) < p.shortest:
            return
        get = p.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.r_[0, ids > 0, 0].astype(np.int8)))
        for start, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if end - start >= p.shortest:
                self.parts.append(np.r_[ids[start:end], 1])
                self.docs.append((doc, start, self.size))
                self.size += end - start + 1

    def hits(self) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """doc -> spans [start, end) of occurrences, items found."""
        if not self.parts:
            return {}
        p = self.phrases
        index = FMIndex(np.concatenate(self.parts))
        lo, hi = index.search(p.rows, p.lengths)
        found = np.flatnonzero(hi > lo)
        count = (hi - lo)[found]
        phrase = np.repeat(found, count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo[found], count)
        at = index.locate(rows)
        starts = np.array([s for _, _, s in self.docs], np.int64)
        run = np.searchsorted(starts, at, side="right") - 1
        out: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        order = np.lexsort((at, run))
        for k in order.tolist():
            doc, start, base = self.docs[run[k]]
            spans, items = out.setdefault(doc, ([], set()))
            a = start + int(at[k]) - base
            b = a + int(p.lengths[phrase[k]])
            spans.append((a, b))
            items.update(p.items[phrase[k]])
        return out


def scan(batches: Iterator[pa.RecordBatch], phrases, shard_words: int) -> Iterator[pa.RecordBatch]:
    """Batches of kept, text, n_words, spans, items -> the same with this block's
    hits added, one shard of documents at a time."""
    shard, counts, slices = Shard(phrases.value), [], []

    def emit() -> pa.RecordBatch:
        whole = pa.Table.from_batches(slices).combine_chunks()
        hits = shard.hits()
        spans, items = whole.column("spans").to_pylist(), whole.column("items").to_pylist()
        for k, (more, names) in hits.items():
            spans[k], items[k] = merged([*spans[k], *more]), sorted({*items[k], *names})
        kinds = whole.schema
        whole = whole.set_column(2, kinds.field(2), pa.array(counts, kinds.field(2).type))
        whole = whole.set_column(3, kinds.field(3), pa.array(spans, kinds.field(3).type))
        whole = whole.set_column(4, kinds.field(4), pa.array(items, kinds.field(4).type))
        yield from whole.to_batches(max_chunksize=2000)

    for batch in batches:
        for text in batch.column("text").cast(pa.binary()):
            words = words_of(text.as_py() or b"")
            shard.add(len(counts), words)
            counts.append(len(words))
        slices.append(batch)
        if shard.size >= shard_words or sum(b.nbytes for b in slices) >= SHARD_BYTES:
            yield from emit()
            shard, counts, slices = Shard(phrases.value), [], []
    if slices:
        yield from emit()


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def item_blocks(items: DataFrame, block_chars: int) -> list[list[tuple[str, bytes]]]:
    """The benchmark in blocks of about ``block_chars`` characters (one item at least)."""
    items = items.select(items["item_id"].cast("string").alias("item"), items["text"].cast("string").alias("text"))
    items = items.filter("item IS NOT NULL AND text IS NOT NULL").withColumns({"all": F.lit(0), "chars": F.length("text").cast("long")})
    if (items.agg(F.sum("chars")).first()[0] or 0) <= block_chars:
        return [[(r["item"], r["text"].encode()) for r in items.select("item", "text").collect()]]
    placed = settle(running_totals(items, "all", ["item", "text"], "chars", "before", "items")
                    .withColumn("block", F.floor(F.col("before") / block_chars)), "items")
    last = placed.agg(F.max("block")).first()[0]
    return [[(r["item"], r["text"].encode()) for r in placed.filter(F.col("block") == k).select("item", "text").collect()]
            for k in range(last + 1)]


def decontaminate(docs: DataFrame, items: DataFrame, keep: Sequence[str], window: int = WINDOW,
                  shard_words: int = SHARD_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: kept (a struct of the ``keep`` columns), n_words,
    spans (merged word spans [start, end) to remove), items (found ids, sorted as strings).

    An item's windows are its ``window`` consecutive words; a shorter one with
    any word is one window.  Null or empty texts have no words and no hits.  Items
    with a null id or text are skipped; one id on several rows is one item.  Empty
    tables give no rows, or rows without hits.  ``keep`` columns may have any name.
    """
    spark = docs.sparkSession
    small_batches(spark)
    found = docs.select(F.struct(*[docs[c] for c in keep]).alias("kept"), docs["text"].cast("string").alias("text"),
                        F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() AS array<array<long>>)").alias("spans"),
                        F.expr("cast(array() AS array<string>)").alias("items"))
    for block in item_blocks(items, block_chars):
        phrases = spark.sparkContext.broadcast(Phrases(block, window))
        found = found.mapInArrow(lambda b, p=phrases: scan(b, p, shard_words), found.schema)
    return found.drop("text")
