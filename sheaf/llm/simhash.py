"""SimHash near-dedup: fingerprints linked by Golay keys.

A fingerprint bit is the majority of that bit over the hashes of a text's word
shingles.  Distinct fingerprints (copies collapse by a partial aggregate) get the
keys of ``golay``; those that share a key are candidates, verified by their exact
bit distance.  Verification comes in two steps so that a large group of near copies
never becomes all its pairs: first each member of a key meets the key's smallest
fingerprint, then only members of different components meet one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.llm.common import settle, small_batches
from sheaf.llm.components import components
from sheaf.llm.golay import fingerprint_keys

SHINGLE = 4
MOST_BITS = 4          # what the Golay keys guarantee
SEED = 42


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint: A-Z lower-cased, words split at space and U+0009 to
    U+000D, ``shingle`` words a shingle (fewer words: one shingle of them all),
    XXH64; a bit is 1 if more than half the hashes have it.  No words: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[:len(last)].tolist(), last.tolist(), strict=True)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: kept (a struct of the ``keep`` columns), fp (a signed long)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("kept"), F.lit(0).cast("long").alias("fp"),
                       docs["text"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text").cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(fp.view(np.int64), pa.int64())], ["kept", "fp"])

    return rows.mapInArrow(run, rows.select("kept", "fp").schema)


def golay_keys(prints: DataFrame) -> DataFrame:
    """(fp) -> (key, fp)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = f["fp"].to_numpy()
            for k in range(0, len(fp), 2000):
                at, key = fingerprint_keys(fp[k:k + 2000].view(np.uint64))
                yield pd.DataFrame({"key": key, "fp": fp[k:k + 2000][at]})

    return prints.select("fp").mapInPandas(run, "key long, fp long")


def print_roots(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Distinct fingerprints (fp) -> (fp, root) of those linked to another one."""
    if most_bits > MOST_BITS:
        raise ValueError(f"the keys find fingerprints up to {MOST_BITS} bits apart")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= most_bits
    key = Window.partitionBy("key")
    shared = golay_keys(prints).withColumns({"other": F.min("fp").over(key), "top": F.max("fp").over(key)})
    shared = settle(shared.filter("other <> top").select("key", "fp", "other"), "keys")
    first = settle(components(shared.filter("fp <> other").filter(close).select(F.col("fp").alias("a"), F.col("other").alias("b"))), "roots")
    rooted = (shared.join(first, shared["fp"] == first["node"], "left")
              .select("key", "fp", F.coalesce("root", "fp").alias("root")))
    mixed = rooted.withColumns({"low": F.min("root").over(key), "high": F.max("root").over(key)}).filter("low <> high")
    mixed = settle(mixed.select("key", "fp", "root"), "mixed")
    right = mixed.select("key", F.col("fp").alias("other"), F.col("root").alias("other_root"))
    links = mixed.join(right, "key").filter(F.col("root") < F.col("other_root")).filter(close)
    second = components(links.select(F.col("root").alias("a"), F.col("other_root").alias("b")).distinct())
    second = second.select(F.col("node").alias("root"), F.col("root").alias("whole"))
    # members of the first step under their final root; single fingerprints that only the second links
    members = first.select(F.col("node").alias("fp"), "root").unionByName(
        second.join(first, second["root"] == first["node"], "left_anti").select(F.col("root").alias("fp"), "root"))
    return members.join(second, "root", "left").select("fp", F.coalesce("whole", "root").alias("root"))


def near_dedup(docs: DataFrame, keep: list[str], shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of ``docs``: kept (a struct of the ``keep`` columns, doc_id
    among them), fp, root (one fingerprint per component), component_id (smallest
    doc_id whose fingerprint is reachable by links of up to ``most_bits`` bits, itself included).

    Null and empty texts have fingerprint 0 and link like any other.  Rows with a
    null doc_id take part; a component of such rows alone has id null.  Repeated rows
    share a fingerprint and so a component.  An empty table gives no rows.
    """
    prints = settle(fingerprints(docs, keep, shingle), "prints")
    nodes = settle(prints.groupBy("fp").agg(F.min("kept.doc_id").alias("first")), "nodes")
    roots = settle(print_roots(nodes, most_bits), "roots")
    rooted = settle(nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "nodes")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(ids, "fp").select("kept", "fp", "root", "component_id")
