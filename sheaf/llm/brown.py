"""Language-model scores from a Brown class-based bigram model.

Words get classes by exchange: each word in turn of half of them moves to the class that raises the
likelihood of the class bigrams most.  A word's neighbours lie in one row of a Spark
table, so a round is one narrow pass: the driver holds only the classes of clustered
words and the matrix of class bigrams.  A text's probability is the product of
class transitions (Witten-Bell smoothed with class frequencies) and word emissions.

Words below ``2**-CLUSTERED`` of all training tokens, or met once, share the class of
rare words; unseen words are one more event of that class, as likely as words met once
were.  By arithmetic at most ``2**CLUSTERED`` words are clustered and at most ``2**KNOWN``
counts are broadcast; the counts of all other words are joined.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import settle, small_batches

CLUSTERED = 17         # words of at least 2**-17 of the training tokens are clustered
KNOWN = 20             # counts of words of at least 2**-20 are broadcast
CLASSES = 64
ROUNDS = 8
END = b""              # the token after a text's last word
END_CLASS, RARE_CLASS = 0, 1
PIECE = 1 << 20        # bytes of a text that are cut into words at once
GROUP = 200_000        # tokens that are looked up at once
FLUSH = 400_000        # distinct words that a task holds before it passes them on
PAIRS = 4_000_000      # word pairs that a task holds before it counts them
WORDS = 64             # words whose moves are weighed at once
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def token_groups(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Tokens of many texts one after the other, each text's words and then ``END``: (number of
    the text, token) in groups.  Null counts as empty; a long text is cut piece by piece."""
    docs: list[int] = []
    sizes: list[int] = []
    tokens: list[bytes] = []
    for k, text in enumerate(texts):
        text = (text or b"").lower()                    # of bytes: A to Z only
        at = 0
        while at < len(text):
            blank = BLANK.search(text, at + PIECE) if len(text) - at > PIECE else None
            stop = blank.start() if blank else len(text)
            words = text[at:stop].split()               # of bytes: at these blanks only
            tokens += words
            docs.append(k)
            sizes.append(len(words))
            at = stop
            if len(tokens) > GROUP:
                yield np.repeat(docs, sizes), tokens
                docs, sizes, tokens = [], [], []
        tokens.append(END)
        docs.append(k)
        sizes.append(1)
    if tokens:
        yield np.repeat(docs, sizes), tokens


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def held_out(doc_id: F.Column) -> F.Column:
    """crc32(doc_id as text) mod 7 is 2; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over all of ``text``; the end's token is the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in total], pa.string()),
                                              pa.array(list(total.values()), pa.int64())], ["token", "n"])
            total.clear()
            return out

        for batch in batches:
            for _, tokens in token_groups(_texts(batch)):
                total.update(tokens)
                if len(total) > FLUSH:
                    yield batch_of()
        yield batch_of()

    return texts.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _x(a: np.ndarray) -> np.ndarray:
    return a * np.log(np.maximum(a, 1.0))


def likelihood(matrix: np.ndarray) -> float:
    """What of the training texts' log likelihood depends on the classes."""
    return float(_x(matrix).sum() - _x(matrix.sum(axis=0)).sum() - _x(matrix.sum(axis=1)).sum())


def best_moves(matrix: np.ndarray, own: np.ndarray, after: np.ndarray, before: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """The class of each word that makes the likelihood greatest if the word alone moves.

    ``matrix``: class bigrams; per word its class ``own``, its counts ``after`` and ``before`` it by
    class, and how often it follows ``itself``.  The first two classes take no words.
    """
    k, rows = len(matrix), np.arange(len(own))
    margins = []                                               # class sizes without the word, and its own size
    for axis, counts in ((1, after), (0, before)):
        sums, size = np.repeat(matrix.sum(axis=axis)[None], len(own), axis=0), counts.sum(axis=1)
        sums[rows, own] -= size
        margins.append((sums, size[:, None]))
    rest = np.repeat(matrix[None], len(own), axis=0)           # the matrix without the word
    rest[rows, own, :] -= after
    rest[rows, :, own] -= before
    rest[rows, own, own] += itself
    after, before = after.copy(), before.copy()
    after[rows, own] -= itself
    before[rows, own] -= itself
    diag = np.arange(k)
    f = _x(rest)
    right = _x(rest + after[:, None, :]) - f
    down = _x(rest + before[:, :, None]) - f
    corner = rest[:, diag, diag]
    gain = (right.sum(axis=2) - right[:, diag, diag] + down.sum(axis=1) - down[:, diag, diag]
            + _x(corner + after + before + itself[:, None]) - _x(corner))
    for sums, size in margins:
        gain -= _x(sums + size) - _x(sums)
    gain[:, :RARE_CLASS + 1] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[rows, best] > gain[rows, own] + 1e-9, best, own)


@dataclass
class Vocabulary:
    """Clustered words first (the end's token is 0), then the others whose counts are known."""

    index: dict[bytes, int]
    n: np.ndarray
    clustered: int
    tokens: int            # of the training texts
    kinds: int
    once: int              # words met once
    least: float           # words that occur less often are not in ``index``


def vocabulary(counts: DataFrame, clustered: int = CLUSTERED, known: int = KNOWN) -> Vocabulary:
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum((F.col("n") == 1).cast("long")).alias("once")).first()
    n = total["n"] or 0
    often = counts.filter(F.col("n") >= n / 2**known).orderBy(F.desc("n"), "token").toArrow()      # 2**known rows at most
    size = often["n"].to_numpy()
    words = [w.encode() for w in often["token"].to_pylist()]
    place = [k for k, w in enumerate(words) if w != END]
    count = int(((size[place] >= n / 2**clustered) & (size[place] > 1)).sum())
    ends = counts.filter(F.col("token") == "").agg(F.sum("n")).first()[0] or 0
    return Vocabulary({w: k for k, w in enumerate([END, *(words[p] for p in place)])},
                      np.r_[ends, size[place]].astype(np.int64), 1 + count, n, total["v"], (total["once"] or 0) - (ends == 1), n / 2**known)


def word_pairs(texts: DataFrame, words: Vocabulary) -> DataFrame:
    """(a, b, n): how often clustered word b follows a, over all of ``text``.  The id after the
    last clustered one stands for every other word; a text begins after an end."""
    shared = texts.sparkSession.sparkContext.broadcast(({w: k for w, k in words.index.items() if k < words.clustered}, words.clustered))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, rare = shared.value
        held: list[np.ndarray] = []

        def batch_of() -> Iterator[pa.RecordBatch]:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            for k in range(0, len(codes), 500_000):
                c = codes[k:k + 500_000]
                yield pa.RecordBatch.from_arrays([pa.array((c // (rare + 1)).astype(np.int32)), pa.array((c % (rare + 1)).astype(np.int32)),
                                                  pa.array(n[k:k + 500_000])], ["a", "b", "n"])

        for batch in batches:
            last = 0
            for _, tokens in token_groups(_texts(batch)):
                ids = np.fromiter(map(index.get, tokens, repeat(rare)), np.int64, len(tokens))
                held.append(np.r_[last, ids[:-1]] * (rare + 1) + ids)
                last = ids[-1]
                if sum(map(len, held)) > PAIRS:
                    yield from batch_of()
        if held:
            yield from batch_of()

    return texts.select("text").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def exchange(pairs: DataFrame, words: int, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the ids 0 (the end), 1 to ``words`` - 1, ``words`` (rare), and the class bigrams.

    The most frequent words start with a class each, the others in the last one.  In
    a round every second word moves at once; the classes of the best round stay.
    """
    spark = pairs.sparkSession
    pairs = settle(pairs, "pairs")
    sides = [pairs.filter((F.col(me) > 0) & (F.col(me) < words)).select(F.col(me).alias("word"), F.struct(
        F.lit(side).alias("side"), F.col(you).alias("id"), "n").alias("near")) for side, me, you in ((0, "a", "b"), (1, "b", "a"))]
    around = settle(sides[0].unionByName(sides[1]).groupBy("word").agg(F.collect_list("near").alias("near")), "around")
    size = classes * classes

    def bigrams(own: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(own)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, total = shared.value, np.zeros(size, np.int64)
            for batch in batches:
                code = mine[batch.column("a").to_numpy()].astype(np.int64) * classes + mine[batch.column("b").to_numpy()]
                total += np.bincount(code, batch.column("n").to_numpy(), size).astype(np.int64)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["code", "n"])

        got = pairs.mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
        shared.destroy()
        matrix = np.zeros(size)
        matrix[got["code"].to_numpy()] = got["n"].to_numpy()
        return matrix.reshape(classes, classes)

    def moved(own: np.ndarray, matrix: np.ndarray, turn: int) -> np.ndarray:
        shared = spark.sparkContext.broadcast((own, matrix))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, bigram = shared.value
            for batch in batches:
                ids, lists = batch.column("word").to_numpy(), batch.column("near")
                near = lists.flatten()
                side, other, n = (near.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                row = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
                counts = np.bincount((row * 2 + side) * classes + mine[other], n, 2 * len(ids) * classes).reshape(len(ids), 2, classes)
                itself = np.bincount(row, n * ((side == 0) & (other == ids[row])), len(ids))
                new = np.concatenate([best_moves(bigram, mine[ids[k:k + WORDS]], counts[k:k + WORDS, 0], counts[k:k + WORDS, 1], itself[k:k + WORDS])
                                      for k in range(0, len(ids), WORDS)])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(new.astype(np.int32))], ["word", "class"])

        got = around.filter(F.col("word") % 2 == turn).mapInArrow(run, "word int, class int").toArrow()      # fewer rows than ``words``
        shared.destroy()
        new = own.copy()
        new[got["word"].to_numpy()] = got["class"].to_numpy()
        return new

    own = np.minimum(np.arange(words + 1) + 1, classes - 1).astype(np.int32)
    own[0], own[words] = END_CLASS, RARE_CLASS
    matrix = bigrams(own)
    best, still = (likelihood(matrix), own, matrix), 0
    for turn in range(2 * rounds):
        new = moved(own, matrix, turn % 2)
        still = still + 1 if (new == own).all() else 0
        if still == 2:
            break
        own, matrix = new, bigrams(new)
        now = likelihood(matrix)
        if now > best[0]:
            best = (now, own, matrix)
        elif now < best[0] - 1e-3 * abs(best[0]):
            break
    return best[1], best[2]


@dataclass
class Model:
    """What scoring needs: per known id its class, log10 emission and count; log10 transitions."""

    words: Vocabulary
    own: np.ndarray
    emission: np.ndarray
    transition: np.ndarray
    rare: int              # training tokens of rare words
    counts: DataFrame      # (token, n) of all training words


def transitions(matrix: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Witten-Bell: a class's successors, and for as many of its tokens as they are kinds the class frequencies."""
    total = matrix.sum(axis=0)
    one = np.where(used, (total + 1) / (total[used].sum() + used.sum()), 0.0)
    from_, kinds = matrix.sum(axis=1, keepdims=True), (matrix > 0).sum(axis=1, keepdims=True)
    mixed = (matrix + kinds * one) / np.maximum(from_ + kinds, 1)
    with np.errstate(divide="ignore"):
        return np.log10(np.where(from_ > 0, mixed, one))


def fit(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, clustered: int = CLUSTERED, known: int = KNOWN) -> Model:
    """The model of ``docs`` (text): every token counts."""
    small_batches(docs.sparkSession)
    texts = docs.select(docs["text"].cast("string").alias("text"))
    counts = settle(token_counts(texts), "counts")
    words = vocabulary(counts, clustered, known)
    own, matrix = exchange(word_pairs(texts, words), words.clustered, classes, rounds)
    size = np.bincount(own[:words.clustered], words.n[:words.clustered], classes)
    rare = words.tokens - int(words.n[:words.clustered].sum())
    size[RARE_CLASS] = rare + words.once + 1
    own = np.r_[own[:words.clustered], np.full(len(words.n) - words.clustered, RARE_CLASS)].astype(np.int32)
    used = np.zeros(classes, bool)
    used[own], used[[END_CLASS, RARE_CLASS]] = True, True
    emission = np.log10(np.maximum(words.n, 1) / np.maximum(size[own], 1))
    return Model(words, own, emission, transitions(matrix, used), rare, counts)


def score_texts(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """One row per row of ``docs`` (text): kept (a struct of the ``keep`` columns), n_tokens, n_known,
    base_score, score, perplexity.

    ``score``: the model's log10 probability of the whole text with its end; ``base_score``: that
    of single tokens, one added to each count; ``perplexity``: 10 to the mean loss per token.
    A null or empty text has one token, the end.  Repeated rows get equal scores, an
    empty table gives no rows; a very long text is read piece by piece.
    """
    spark = docs.sparkSession
    small_batches(spark)
    w = model.words
    base = np.log10((w.n + 1) / (w.tokens + w.kinds + 1))
    shared = spark.sparkContext.broadcast((w.index, w.n > 0, model.own, model.emission, model.transition, base))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[docs[c] for c in keep]).alias("kept"),
                       docs["text"].cast("string").alias("text"))
    shape = rows.select("row", "kept", F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"),
                        F.lit(0.0).alias("score"), F.expr("cast(array() AS array<struct<token: string, k: long>>)").alias("rare")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, seen, own, emission, transition, single = shared.value
        for batch in batches:
            size = batch.num_rows
            n_tokens, n_known = np.zeros(size, np.int64), np.zeros(size, np.int64)
            alone, score = np.zeros(size), np.zeros(size)
            rare: list[Counter] = [Counter() for _ in range(size)]
            last = END_CLASS
            for doc, tokens in token_groups(_texts(batch)):
                ids = np.fromiter(map(index.get, tokens, repeat(-1)), np.int64, len(tokens))
                there = ids >= 0
                classes = np.where(there, own[ids], RARE_CLASS)
                score += np.bincount(doc, transition[np.r_[last, classes[:-1]], classes] + np.where(there, emission[ids], 0.0), size)
                alone += np.bincount(doc, np.where(there, single[ids], 0.0), size)
                n_tokens += np.bincount(doc, minlength=size)
                n_known += np.bincount(doc[there & seen[ids]], minlength=size)
                last = classes[-1]
                for j in np.flatnonzero(~there).tolist():
                    rare[doc[j]][tokens[j]] += 1
            stops = np.r_[0, np.cumsum([len(c) for c in rare])].astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array([t.decode("utf-8", "replace") for c in rare for t in c], pa.string()),
                                                pa.array([k for c in rare for k in c.values()], pa.int64())], ["token", "k"])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("kept"), pa.array(n_tokens), pa.array(n_known), pa.array(alone),
                                              pa.array(score), pa.ListArray.from_arrays(pa.array(stops), pairs)],
                                             ["row", "kept", "n_tokens", "n_known", "base", "score", "rare"])

    found = settle(rows.mapInArrow(run, shape), "scored")
    others = model.counts.filter(F.col("n") < w.least)
    rare = found.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.k").join(others, "token", "left")
    n = F.coalesce("n", F.lit(0))
    room = float(model.rare + w.once + 1)
    rest = rare.groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("more_known"),
        F.sum(F.col("k") * F.log10((n + 1) / F.lit(float(w.tokens + w.kinds + 1)))).alias("more_base"),
        F.sum(F.col("k") * F.log10(F.when(n > 0, n.cast("double")).otherwise(float(w.once + 1)) / F.lit(room))).alias("more_score"))
    out = found.drop("rare").join(rest, "row", "left")
    score = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return out.select("kept", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), score.alias("score"),
                      F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))
