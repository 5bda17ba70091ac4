"""Quality scores by regularised quadratic discriminant analysis.

Every text is reduced to ``FEATURES`` statistics, transformed towards normal
(logarithms of counts and of shares).  Each class has a mean and a covariance, shrunk
towards the diagonal of the pooled one.  A score is the logistic of the difference
of the two log densities (squared Mahalanobis distance and log determinant from a
Cholesky factor kept per class) and of the log priors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import settle, small_batches

FEATURES = ("characters", "words", "word_length", "upper", "digits", "marks", "marked_words", "bare_marks", "doubled_marks",
            "distinct", "top_word", "next_same", "lines", "line_length", "repeated_lines", "commonest_mark")
SHRINKAGE = 0.1
RIDGE = 1e-3
TINY = 1e-3            # added to a share before its logarithm
LOWER = bytes(range(97, 123))
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SPACES = b" \t\n\r\x0b\x0c"
#: ASCII characters that are neither letters, digits nor white space, nor the marks of ordinary sentences.
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'\"-;:()")
STRIP = bytes(b for b in range(256) if b not in MARKS)


def statistics(text: bytes | None) -> list[float]:
    """The transformed statistics of a whole text; null counts as empty.  Marks, capitals and digits are those of
    ASCII, so in other scripts these shares are constant."""
    text = text or b""
    words = text.split()
    n, w = len(text), len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    if not w:
        return [0.0] * len(FEATURES)

    def share(part: float, whole: float) -> float:
        return float(np.log(part / whole + TINY)) if whole else float(np.log(TINY))

    solid = n - sum(map(text.count, (b" ", b"\n", b"\t")))
    marks = text.translate(None, STRIP)
    counts = Counter(words)
    kinds = Counter(lines)
    marked = sum(k for x, k in counts.items() if x[-1] in MARKS)
    bare = sum(k for x, k in counts.items() if not x.translate(None, MARKS))
    doubled = sum(k for x, k in counts.items() if len(x) > 1 and x[-1] == x[-2] and x[-1] in MARKS)
    return [float(np.log1p(n)), float(np.log1p(w)), float(np.log(solid / w + 1)),
            share(n - len(text.translate(None, UPPER)), solid), share(n - len(text.translate(None, DIGITS)), solid),
            share(len(marks), solid), share(marked, w), share(bare, w), share(doubled, w),
            float(np.log(len(counts) / w)), share(max(counts.values()), w),
            share(sum(a == b for a, b in zip(words, words[1:], strict=False)), w),
            float(np.log1p(len(lines))), float(np.log1p(w / max(1, len(lines)))),
            share(len(lines) - len(kinds), max(1, len(lines))),
            share(max(Counter(marks).values(), default=0), solid)]


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per row of ``docs``: kept (a struct of the ``keep`` columns), x (array of doubles)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("kept"), docs["text"].cast("string").alias("text"),
                       F.expr("cast(array() AS array<double>)").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(x, pa.list_(pa.float64()))], ["kept", "x"])

    return rows.mapInArrow(run, rows.select("kept", "x").schema)


@dataclass
class Discriminant:
    """Per class 0, 1: mean, inverse Cholesky factor, log density at the mean plus log prior."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    levels: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Rows of statistics -> the probability of class 1.  Without labels of both
        classes the score is constant: their share of class 1, or 0.5 without any."""
        if not self.means:
            return np.full(len(x), self.levels[0])
        log = [level - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, level in zip(self.means, self.factors, self.levels, strict=True)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))


def fit(known: DataFrame, shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Discriminant:
    """(label, x) -> the model.  Counts, sums and products are summed by Spark; the
    driver gets one row per class and moment."""
    size = len(FEATURES)
    upper = np.triu_indices(size)

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for label, part in f.groupby("label"):
                x = np.stack(part["x"].to_numpy())
                v = np.r_[len(x), x.sum(axis=0), (x.T @ x)[upper]]
                yield pd.DataFrame({"label": np.int32(label), "k": np.arange(len(v), dtype=np.int32), "v": v})

    rows = known.select(F.col("label").cast("int").alias("label"), "x").mapInPandas(moments, "label int, k int, v double")
    got: dict[int, np.ndarray] = {}
    for r in rows.groupBy("label", "k").agg(F.sum("v").alias("v")).collect():
        got.setdefault(r["label"], np.zeros(1 + size + len(upper[0])))[r["k"]] = r["v"]
    if set(got) != {0, 1}:
        return Discriminant([], [], [float(next(iter(got))) if got else 0.5])
    n = {c: got[c][0] for c in (0, 1)}
    means = {c: got[c][1:1 + size] / n[c] for c in (0, 1)}
    spread = {}
    for c in (0, 1):
        square = np.zeros((size, size))
        square[upper] = got[c][1 + size:]
        square = square + np.triu(square, 1).T
        spread[c] = square / n[c] - np.outer(means[c], means[c])
    pooled = (n[0] * spread[0] + n[1] * spread[1]) / (n[0] + n[1])
    factors, levels = [], []
    for c in (0, 1):
        shrunk = (1 - shrinkage) * spread[c] + shrinkage * np.diag(np.diag(pooled)) + ridge * np.eye(size)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        levels.append(float(np.log(n[c] / (n[0] + n[1])) - np.log(np.diag(lower)).sum()))
    return Discriminant([means[0], means[1]], factors, levels)


def score_quality(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """One row per row of ``docs``: kept (a struct of the ``keep`` columns), score.

    Learns from ``labels`` (doc_id, quality) of documents whose crc32(doc_id) mod 3
    is not 1; several labels of a document count as the greatest, others than 0 and 1
    and nulls are skipped.  Null and empty texts are scored from the statistics 0.
    Repeated rows get equal scores; an empty table gives no rows.
    """
    spark = docs.sparkSession
    found = settle(features(docs.select(docs["text"], F.struct(*[docs[c] for c in keep]).alias("own"), docs["doc_id"].alias("id")),
                            ["own", "id"]).select("kept.own", "kept.id", "x"), "statistics")
    usable = (labels.select(labels["doc_id"].alias("id"), labels["quality"].cast("double").alias("label"))
              .filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").cast("int").alias("label"))
              .filter(F.crc32(F.col("id").cast("string")) % 3 != 1))
    model = spark.sparkContext.broadcast(fit(found.join(usable, "id").select("label", "x")))
    rows = found.select(F.col("own").alias("kept"), "x", F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(model.value.score(x), pa.float64())], ["kept", "score"])

    return rows.mapInArrow(run, rows.select("kept", "score").schema)
