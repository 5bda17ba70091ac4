"""Class-based language model: moves, probabilities and scores against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.llm import brown
from sheaf.llm.brown import best_moves, exchange, fit, held_out, likelihood, score_texts, token_groups

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain_tokens(text):
    return [*WORD.findall(small(text or "")), ""]


def test_tokens_of_pieces(monkeypatch):
    monkeypatch.setattr(brown, "PIECE", 5)
    monkeypatch.setattr(brown, "GROUP", 3)
    texts = ["A bc\tÄ\x0bd \x1c e f\x85g", None, "", " \n", "longword andmore x", "ÀÉ Z" * 9]
    got = {k: [] for k in range(len(texts))}
    for docs, tokens in token_groups([None if t is None else t.encode() for t in texts]):
        for d, t in zip(docs.tolist(), tokens, strict=True):
            got[d].append(t.decode())
    assert got == {k: plain_tokens(t) for k, t in enumerate(texts)}


def test_best_moves_equal_counting_again():
    rng = np.random.default_rng(4)
    words, classes = 12, 6
    pairs = Counter(zip(*rng.integers(0, words + 1, (2, 400)).tolist(), strict=True))
    own = np.r_[0, rng.integers(2, classes, words - 1), 1]

    def matrix(of):
        m = np.zeros((classes, classes))
        for (a, b), n in pairs.items():
            m[of[a], of[b]] += n
        return m

    ids = np.arange(1, words)
    after, before, itself = np.zeros((words - 1, classes)), np.zeros((words - 1, classes)), np.zeros(words - 1)
    for (a, b), n in pairs.items():
        if 0 < a < words:
            after[a - 1, own[b]] += n
            itself[a - 1] += n * (a == b)
        if 0 < b < words:
            before[b - 1, own[a]] += n
    got = best_moves(matrix(own), own[ids], after, before, itself)
    for w, best in zip(ids, got, strict=True):
        found = {}
        for c in range(2, classes):
            other = own.copy()
            other[w] = c
            found[c] = likelihood(matrix(other))
        assert found[int(best)] == pytest.approx(max(found.values()))


def test_exchange_finds_the_kinds_of_words(spark):
    rng = random.Random(2)
    kinds = [[f"{x}{k}" for k in range(12)] for x in "ab"]
    rows = []
    for k in range(200):                       # words of a and of b take turns
        rows.append((k, " ".join(rng.choice(kinds[j % 2]) for j in range(40))))
    docs = spark.createDataFrame(rows, DOCS)
    model = fit(docs, classes=5)
    places = {w.decode(): int(model.own[k]) for w, k in model.words.index.items() if k}
    assert len({places[w] for w in kinds[0]} & {places[w] for w in kinds[1]}) == 0
    found = score_texts(docs, model, ["doc_id"]).agg(F.avg("perplexity"), F.avg(F.pow(10.0, -F.col("base_score") / F.col("n_tokens")))).first()
    assert found[0] < 14 < 22 < found[1]


def test_scores_are_the_models_and_probabilities_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(brown, "FLUSH", 20)
    monkeypatch.setattr(brown, "GROUP", 7)
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "ß", "(x)"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    text = lambda n: " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(vocabulary, weights, k=n))
    rows = [(k, text(rng.randint(0, 30))) for k in range(120)] + [(None, "w1 new"), (500, None), (501, ""), (502, " \t"), (7, "w1 w1"), (7, "w1 w1"),
                                                                (503, "never seen these"), (504, text(3000))]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit("s"), "n": F.lit(1), "token": F.lit("t"), "kept": F.lit(0)})
    train = [t for i, t in rows if zlib.crc32(str(i if i is not None else "").encode()) % 7 != 2]
    count = Counter(x for t in train for x in plain_tokens(t))
    model = fit(docs.filter(~held_out(F.col("doc_id"))), classes=8, rounds=3, clustered=6, known=7)
    total, once = sum(count.values()), sum(n == 1 for n in count.values())
    assert (model.words.tokens, model.words.kinds, model.words.once) == (total, len(count), once)
    inside = {w.decode() for w, k in model.words.index.items() if k < model.words.clustered}
    assert inside == {"", *(w for w, n in count.items() if n >= total / 64 and n > 1)}
    rare = sum(n for w, n in count.items() if w not in inside)
    size = Counter()
    for w in inside:
        size[int(model.own[model.words.index[w.encode()]])] += count[w]

    def emission(w):
        if w in inside:
            c = int(model.own[model.words.index[w.encode()]])
            return c, count[w] / size[c]
        return 1, (count[w] if w in count else once + 1) / (rare + once + 1)

    for a in range(8):
        assert sum(10 ** model.transition[a, c] * e for c, e in map(emission, [*count, "unseen"])) == pytest.approx(1)
    want = []
    for i, t in rows:
        tokens, last, score = plain_tokens(t), 0, 0.0
        for w in tokens:
            c, e = emission(w)
            score += model.transition[last, c] + math.log10(e)
            last = c
        base = sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in tokens)
        want.append((str(i), len(tokens), sum(w in count for w in tokens), round(base, 6), round(score, 6), round(10 ** (-score / len(tokens)), 3)))
    got = score_texts(docs, model, ["doc_id", "score"])
    assert sorted(want) == sorted((str(r[0]["doc_id"]), r[1], r[2], round(r[3], 6), round(r[4], 6), round(r[5], 3)) for r in got.collect())


def test_held_out_texts_are_likelier_than_by_single_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = fit(docs.filter(~held_out(F.col("doc_id"))), classes=24, rounds=3)
    got = score_texts(docs.filter(held_out(F.col("doc_id"))), model, ["doc_id"]).agg(
        F.sum("score"), F.sum("base_score"), F.avg((F.col("score") > F.col("base_score")).cast("int")), F.sum("n_tokens")).first()
    assert got[2] > 0.97 and got[0] > got[1] + 0.2 * got[3]


def test_empty_tables_and_nothing_to_learn(spark):
    empty = spark.createDataFrame([], DOCS)
    model = fit(empty, classes=4)
    assert score_texts(empty, model, ["doc_id"]).count() == 0
    got = score_texts(spark.createDataFrame([(1, "a b"), (2, None)], DOCS), model, ["doc_id"]).orderBy("kept.doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"]) for r in got] == [(3, 0, 0.0), (1, 0, 0.0)]
    assert all(r["score"] <= 0 for r in got)
