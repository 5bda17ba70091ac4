"""Language ID by words first, then shorter and shorter character n-grams.

The model holds, per language, log frequencies of its words and of its character
n-grams of 5 letters down to 1, all that make up ``2**-SHARE`` of a language's words or n-grams.  A word that the
tables know is scored by its word frequencies.  An unseen word is scored by its
5-grams, if any is known, else by its 4-grams, and so on.  A text's language is the
one with the greatest sum over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.llm.common import settle, small_batches

#: The model is fitted on at most so many learnable documents per language (those
#: with the smallest hashes).
FIT_DOCS = 2000
#: Words, and n-grams of one order, that are less than 2**-18 of the sample's in every language are pruned, so
#: by arithmetic a language has at most 2**18 of each.
SHARE = 18
ORDERS = (5, 4, 3, 2, 1)
SMOOTH = 0.5
MEMORY = 1_000_000          # words whose scores a process remembers
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Numbers that are no decimal digits (superscripts, fractions, Roman numerals) are of ``\w``, but no letters.
NUMERALS = [c for c in map(chr, range(0x80, 0x110000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
#: Classes that are found at once: those of two bytes in a table, and a range for all others.
NUMERAL, ASTRAL = re.compile("[" + "".join(c for c in NUMERALS if c < "\U00010000") + "]"), re.compile("[\U00010000-\U0010ffff]")
BLANKED = dict.fromkeys(map(ord, NUMERALS), " ")


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    if not text.isascii() and (NUMERAL.search(text) or ASTRAL.search(text)):
        text = text.translate(BLANKED)
    return LETTERS.findall(text)


def grams(word: str, n: int) -> list[str]:
    edged = f"_{word}_" if n > 1 else word
    return [edged[k:k + n] for k in range(len(edged) - n + 1)]


@dataclass
class Model:
    """tables[order] = (gram -> row, rows of log frequencies per language); order 0 is whole words."""

    languages: list[str]
    tables: dict[int, tuple[dict[str, int], np.ndarray]]
    rows: dict[str, int] = field(default_factory=dict)          # words met, and their rows in
    matrix: np.ndarray | None = None                            # the scores

    def word(self, word: str) -> np.ndarray:
        index, scores = self.tables[0]
        if word in index:
            return scores[index[word]]
        for n in ORDERS:
            index, scores = self.tables[n]
            found = [r for r in map(index.get, grams(word, n)) if r is not None]
            if found:
                return scores[found].mean(axis=0)
        return np.zeros(len(self.languages))

    def learn(self, words: set[str]) -> None:
        """Remember the scores of words, ``MEMORY`` of them."""
        if len(self.rows) + len(words) > MEMORY:
            self.rows.clear()
        new = [w for w in words if w not in self.rows]
        end = len(self.rows) + len(new)
        if self.matrix is None or end > len(self.matrix):
            larger = np.zeros((2 * end, len(self.languages)))
            if self.matrix is not None:
                larger[:len(self.rows)] = self.matrix[:len(self.rows)]
            self.matrix = larger
        for w in new:
            self.matrix[len(self.rows)] = self.word(w)
            self.rows[w] = len(self.rows)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the likelihood; no letter or no model: ``und``, 0."""
        words = words_of(text)
        if not words or not self.languages:
            return UNKNOWN, 0.0
        at = np.fromiter(map(self.rows.get, words, repeat(-1)), np.int64, len(words))
        if at.min() < 0:
            self.learn(set(words))
            at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        total = self.matrix[at].sum(axis=0)
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(np.clip(total - total[best], -50, 0)).sum())


def learnable(docs: DataFrame) -> DataFrame:
    """Documents whose lang is given and whose crc32(doc_id) mod 4 is not 2 (a null text teaches nothing)."""
    return docs.filter("lang IS NOT NULL").filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, share: int = SHARE) -> Model:
    """Learn from ``docs`` (doc_id, text, lang).  The sample of texts and the model are
    bounded by the two parameters times the number of languages."""
    small_batches(docs.sparkSession)
    usable = learnable(docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")))
    # about twice the sample passes a threshold on the hash, the smallest hashes of those are it
    at = F.shiftrightunsigned(F.xxhash64("doc_id"), 11)
    ids = usable.select("lang", "doc_id", at.alias("at"))
    few = ids.groupBy("lang").agg((F.lit(2.0 * fit_docs) / F.count("*") * float(1 << 53)).alias("below"))
    place = Window.partitionBy("lang").orderBy("at", "doc_id")
    chosen = (ids.join(few, "lang").filter("at < below").withColumn("place", F.row_number().over(place))
              .filter(F.col("place") <= fit_docs).select("lang", "doc_id").distinct())
    sample = usable.join(F.broadcast(chosen), ["lang", "doc_id"]).select("lang", "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found: dict[tuple[str, int], Counter] = {}
            for lang, texts in f.groupby("lang")["text"]:
                words = found.setdefault((lang, 0), Counter())
                for t in texts:
                    words.update(words_of(t))
                for n in ORDERS:
                    by = found.setdefault((lang, n), Counter())
                    for w, k in words.items():
                        for g in grams(w, n):
                            by[g] += k
            rows = [(lang, n, g, k) for (lang, n), c in found.items() for g, k in c.items()]
            yield pd.DataFrame(rows, columns=["lang", "n", "gram", "k"])

    counted = sample.mapInPandas(count, "lang string, n int, gram string, k long").groupBy("lang", "n", "gram").agg(F.sum("k").alias("k"))
    counted = settle(counted, "grams")
    sums = counted.groupBy("lang", "n").agg(F.sum("k").alias("s"))
    kept = counted.join(sums, ["lang", "n"]).filter(F.col("k") * (1 << share) >= F.col("s")).select("n", "gram").distinct()
    got = counted.join(kept, ["n", "gram"]).select("lang", "n", "gram", "k").toArrow()      # bounded by the parameters
    totals = {(r["lang"], r["n"]): (r["s"], r["v"]) for r in
              counted.groupBy("lang", "n").agg(F.sum("k").alias("s"), F.count("*").alias("v")).collect()}
    languages = sorted({lang for lang, _ in totals})
    at = {lang: k for k, lang in enumerate(languages)}
    tables: dict[int, tuple[dict[str, int], np.ndarray]] = {}
    for n in (0, *ORDERS):
        part = got.filter(pc.equal(got["n"], n))
        index: dict[str, int] = {}
        row = np.array([index.setdefault(g, len(index)) for g in part["gram"].to_pylist()], np.int64)
        count = np.zeros((len(index), len(languages)))
        count[row, np.array([at[x] for x in part["lang"].to_pylist()], np.int64)] = part["k"].to_numpy()
        size = np.array([totals.get((lang, n), (0, 0))[0] for lang in languages], float)
        kinds = max([totals.get((lang, n), (0, 0))[1] for lang in languages], default=0) + 1
        tables[n] = (index, np.log((count + SMOOTH) / (size + SMOOTH * kinds)))
    return Model(languages, tables)


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """One row per row of ``docs``: kept (a struct of the ``keep`` columns), lang_pred,
    score.  Only the text is an input.  A null text or one without a letter gives
    ``und`` and 0; ties go to the smaller language; every other row gets a learned one."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)                # bounded, see fit
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("kept"), docs["text"].cast("string").alias("text"),
                       F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            got = [m.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array([a for a, _ in got], pa.string()),
                                              pa.array([b for _, b in got], pa.float64())], ["kept", "lang_pred", "score"])

    return rows.mapInArrow(run, rows.select("kept", "lang_pred", "score").schema)
