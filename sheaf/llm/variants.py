"""Spelling variants: words one code point apart, found on a relational trie.

The trie of all words is an edge table (node, c, next): from the node with that
prefix a step ``c`` and then a step ``next`` exist; ``END`` closes a word.  A frontier of
states (word, position, node, edits) starts on every node of a word's own path in its
second half (no edit yet) and spends its one edit there: another letter than the
word's own, or the word's letter left out.  States with one edit then follow the word's own
letters, two levels a round, by joins with the edge table; those that reach ``END``
are neighbours.  A trie of the reversed words covers edits in the first half, so a
frontier never meets the dense levels near a root, and a change is met once: from the
word with the smaller letter, or from the longer word at the last of equal letters.

Words of more than ``LONG`` code points would need a round for every two of
them; they meet by hashes of themselves with one place open or left out, and are compared.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import settle, small_batches

LEAST_LENGTH = 5       # code points of a word
LEAST_COUNT = 3        # occurrences of a word
FACTOR = 2             # a form occurs at least so many times as often as its word
SLIP = 97              # one run in so many loses a code point
LONG = 64
END = "$"
FLUSH = 400_000        # distinct words that a task holds before it passes them on
PIECE = 1 << 20        # bytes of a text that are cut into runs at once
#: Every byte as a letter's (small ones, and the two-byte ones up to U+00FF), else a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 128 <= b <= 191 or b == 0xC3 else 32 for b in range(256))
OTHERS = re.compile(rb"[\xc2\xc4-\xff][\x80-\xbf]*")
HASH_BASE, HASH_MOD = 0x1F3D5B79A2C4E6F80B1D3F5, (1 << 127) - 1


def runs(text: bytes) -> Counter:
    """The runs of letters of a whole text (UTF-8), A to Z in small letters, with their counts."""
    found: Counter = Counter()
    text = OTHERS.sub(b" ", text).translate(LETTERS)
    at = 0
    while at < len(text):
        stop = text.find(b" ", at + PIECE)
        stop = len(text) if stop < 0 else stop
        found.update(text[at:stop].split())
        at = stop
    return found


def word_counts(docs: DataFrame, slip: int = SLIP) -> DataFrame:
    """(word, n) of words of ``LEAST_LENGTH`` code points and more, every count.

    Of a run whose crc32 of ``<doc_id>:<run>`` is divisible by ``slip`` the code point at
    crc32 mod its length is left out.  A task counts what it reads before it passes words on."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("doc_id"), docs["text"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in total], pa.string()),
                                              pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                before = zlib.crc32(f"{doc_id}:".encode())
                for word, n in runs(text or b"").items():
                    if len(word) < LEAST_LENGTH:
                        continue
                    h = zlib.crc32(word, before)
                    if h % slip == 0:
                        letters = word.decode("utf-8", "replace")
                        k = h % len(letters)
                        word = (letters[:k] + letters[k + 1:]).encode()
                    total[word] += n
                if len(total) > FLUSH:
                    yield batch_of()
        yield batch_of()

    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.length("word") >= LEAST_LENGTH)


def trie_pairs(words: DataFrame) -> DataFrame:
    """(word, near) once for each pair of words, of at most ``LONG`` code points, that differ by one."""
    short = words.filter(F.length("word") <= LONG)
    half = F.floor(F.length("word") / 2).cast("int")
    ways = F.explode(F.array(
        F.struct(F.concat(F.lit("+"), "word", F.lit(END)).alias("s"), (1 + half).alias("start")),
        F.struct(F.concat(F.lit("-"), F.reverse("word"), F.lit(END)).alias("s"), (1 + F.length("word") - half).alias("start"))))
    steps = (short.select(ways.alias("way")).select("way.s", F.explode(F.sequence(F.col("way.start"), F.length("way.s") - 1)).alias("pos"))
             .withColumns({"node": F.expr("substring(s, 1, pos)"), "c": F.expr("substring(s, pos + 1, 1)"),
                           "next": F.expr("substring(s, pos + 2, 1)")}))
    edges = settle(steps.select("node", "c", "next").distinct().withColumn("depth", F.length("node")), "edges")
    own = settle(steps.filter(F.col("c") != END), "states")                 # no edit yet, one letter at least to come
    # another letter stands here; it leads on to the word's next letter
    e = edges.select("node", "next", F.col("c").alias("other"))
    other = own.join(e, ["node", "next"]).filter("other > c").select("s", (F.col("pos") + 2).alias("pos"), F.concat("node", "other", "next").alias("node"))
    # the letter is left out: of equal letters the last one in the word
    last = F.when(F.startswith("s", F.lit("+")), F.col("c") != F.col("next")).otherwise(F.col("c") != F.substring("node", -1, 1))
    left = own.filter(last).select("s", "pos", "node", F.col("next").alias("c"), F.expr("substring(s, pos + 3, 1)").alias("next"))
    less = left.join(edges, ["node", "c", "next"]).select("s", (F.col("pos") + 3).alias("pos"), F.concat("node", "c", "next").alias("node"))
    frontier = settle(other.unionByName(less), "frontier")
    done = []
    while True:
        at_end = F.endswith("node", F.lit(END))
        done.append(frontier.filter(at_end).select("s", "node"))
        going = frontier.filter(~at_end)
        least = going.agg(F.min("pos")).first()[0]
        if least is None:
            break
        going = going.select("s", "pos", "node", F.expr("substring(s, pos + 1, 1)").alias("c"), F.expr("substring(s, pos + 2, 1)").alias("next"))
        deep = edges.filter(F.col("depth") >= least - 1).drop("depth")       # a state's node is as deep as its place, or one less
        frontier = settle(going.join(deep, ["node", "c", "next"])
                          .select("s", (F.col("pos") + 2).alias("pos"), F.concat("node", "c", "next").alias("node")), "frontier")
    pairs = done[0]
    for more in done[1:]:
        pairs = pairs.unionByName(more)

    def read(col: str) -> F.Column:
        inner = F.expr(f"substring({col}, 2, length({col}) - 2)")
        return F.when(F.startswith(col, F.lit("+")), inner).otherwise(F.reverse(inner))

    return pairs.select(read("s").alias("word"), read("node").alias("near"))


def _keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, kind, at, key): the hashes of each long word whole, with one place open, with one left out."""
    powers = [1]
    for f in frames:
        for word in f["word"]:
            size, sums = len(word), [0]
            while len(powers) <= size:
                powers.append(powers[-1] * HASH_BASE % HASH_MOD)
            for c in word:
                sums.append((sums[-1] * HASH_BASE + ord(c)) % HASH_MOD)
            me = f"{size}:{sums[size]:x}"
            rows = [(word, me, "whole", -1, me)]
            for p in range(size):
                tail = (sums[size] - sums[p + 1] * powers[size - p - 1]) % HASH_MOD
                rows.append((None, me, "open", p, f"{size}:{p}:{(sums[p] * powers[size - p] + tail) % HASH_MOD:x}"))
                if p + 1 == size or word[p] != word[p + 1]:
                    rows.append((None, me, "less", p, f"{size - 1}:{(sums[p] * powers[size - p - 1] + tail) % HASH_MOD:x}"))
            for k in range(0, len(rows), 50_000):
                yield pd.DataFrame(rows[k:k + 50_000], columns=["word", "id", "kind", "at", "key"])


def long_pairs(words: DataFrame) -> DataFrame:
    """(word, near) once for each pair, the longer of more than ``LONG`` code points.  An
    open place's key is shared by as many words as there are letters at most."""
    long = words.filter(F.length("word") >= LONG).select("word")
    keys = settle(long.mapInPandas(_keys, "word string, id string, kind string, at int, key string"), "keys")
    whole = keys.filter("kind = 'whole'").select(F.col("id"), "word", "key")
    opened = keys.filter("kind = 'open'").select("id", "at", "key")
    same = opened.join(opened.select(F.col("id").alias("other"), "key"), "key").filter("id < other").select("id", "other", "at")
    less = keys.filter("kind = 'less'").select("id", "at", "key").join(whole.select(F.col("id").alias("other"), "key"), "key").select("id", "other", "at")
    near = whole.select(F.col("id").alias("other"), F.col("word").alias("near"))
    found = same.unionByName(less).join(whole.drop("key"), "id").join(near, "other").filter(F.length("word") > LONG)
    rest = F.expr("substring(near, at + 1 + length(near) - length(word) + 1, length(near))")
    alike = (F.expr("substring(word, 1, at) = substring(near, 1, at)")) & (F.expr("substring(word, at + 2, length(word))") == rest)
    return found.filter(alike & (F.col("word") != F.col("near"))).select("word", "near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): the last of the chain of forms, found by doubling."""
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = settle(now.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "roots")
        now = step.drop("moved")
        if step.filter("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT, factor: int = FACTOR, slip: int = SLIP) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of ``docs`` (doc_id, text).

    A word's form is its most frequent neighbour (of equal ones the smallest in code-point
    order) if that occurs ``factor`` times as often at least, else null; its root ends the
    chain of forms.  A null text has no words, a null id counts as an empty one,
    repeated rows count each, an empty table or one without words gives no rows.  A very long text is
    cut into runs piece by piece; other columns, whatever their names, play no part.
    """
    words = settle(word_counts(docs, slip).filter(F.col("n") >= least_count), "words")
    pairs = settle(trie_pairs(words).unionByName(long_pairs(words)), "pairs")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))
    best = (both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    found = words.join(best, "word", "left")
    enough = -F.col("best.less") >= factor * F.col("n")
    found = settle(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "found")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
