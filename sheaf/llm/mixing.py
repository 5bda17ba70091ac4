"""Mixing sources to target weights by systematic sampling.

Each source has a target of words.  A document's expected copies are its
source's target over its source's size.  Within a source the documents stand in
one fixed order, expected copies are summed along it, one offset in [0, 1) is
added, and a document is emitted once per integer boundary that its interval
crosses.  The order is by size, so the taken sizes follow the expected ones with an
error of about the largest document instead of a random walk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import running_totals, settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5            # all targets together, in sizes of the input
MOST = 2               # a target stops at so many times its source's size
SPACE = r"\x20\x09-\x0D"


def words_of(text):
    """Number of runs of characters other than space and U+0009 to U+000D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) -> source, source_size, source_no, target.

    Sources are numbered by code point, null last, and weigh ``weights`` in turn.
    They split ``share`` of all sizes by weight; a target stops at ``most`` times its
    source's size and the excess is split again by weight until none is above.
    The rounds run on the table of sources; the driver holds two sums a round.
    """
    one = sizes.select(F.lit(0).alias("all"), "source", "source_size", F.col("source").isNull().alias("last"), F.lit(1).alias("one"))
    placed = running_totals(one, "all", ["last", "source"], "one", "source_no", "sources")
    pattern = F.array(*[F.lit(w) for w in weights])
    placed = settle(placed.select("source", "source_size", "source_no",
                                  F.get(pattern, (F.col("source_no") % len(weights)).cast("int")).alias("weight"),
                                  (F.col("source_size") * most).alias("cap")), "sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, F.lit(False)
    while True:
        rest = placed.agg(F.sum(F.when(full, F.col("cap"))).alias("kept"), F.sum(F.when(~full, F.col("weight"))).alias("weight"),
                          F.count(F.when(full, 1)).alias("n")).first()
        if not rest["weight"]:
            break
        level = (share * total - (rest["kept"] or 0)) / rest["weight"]
        now = F.col("cap") < F.col("weight") * F.lit(level)      # once above, above at every later level
        if placed.filter(now).count() == rest["n"]:
            break
        full = now
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(float(level)))
    return placed.select("source", "source_size", "source_no", target.alias("target"))


def unit_hash(*parts):
    """A number in [0, 1) from the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, keep: Sequence[str], weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 42) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): kept (a struct of the ``keep``
    columns), source, size, source_size, target, copies, taken (= copies x size).

    Null text has size 0; a null source is a source of its own, the last.  A source
    of no words has target 0 and expected copies 0.  Equal rows are ordered
    arbitrarily among themselves, which changes no sum.  An empty table gives no rows.
    A very long text counts whole and is taken whole, so a source may miss its target by its size.
    The offset and the order depend on ``seed``, source and doc_id alone: reruns agree.
    """
    sized = settle(docs.select(F.struct(*[docs[c] for c in keep]).alias("kept"), docs["doc_id"].alias("doc_id"), docs["source"].cast("string").alias("source"),
                               words_of(docs["text"]).alias("size")), "sizes")
    targets = settle(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    named = targets.withColumnRenamed("source", "name")
    placed = sized.join(named, F.col("source").eqNullSafe(F.col("name"))).select(
        "kept", "doc_id", "source", "source_no", "size", "source_size", "target",
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))).alias("tie"), F.lit(1).alias("one"))
    placed = running_totals(placed, "source_no", ["size", "tie", "doc_id"], "one", "before", "mix")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit_hash(F.lit(f"{seed}-offset"), F.coalesce("source", F.lit("")))
    crossed = F.floor(offset + rate * (F.col("before") + 1)) - F.floor(offset + rate * F.col("before"))
    return (placed.withColumn("copies", crossed.cast("long"))
            .select("kept", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))
