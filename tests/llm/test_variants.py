"""Spelling variants against the plain reading of the rule."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from sheaf.llm import variants
from sheaf.llm.variants import runs, spelling_variants

DOCS = "doc_id long, text string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def small(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plainly(rows, slip=97):
    count = Counter()
    for doc_id, text in rows:
        for r in RUN.findall(text or ""):
            r = small(r)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{r}".encode())
            count[r[:h % len(r)] + r[h % len(r) + 1:] if h % slip == 0 else r] += 1
    n = {w: k for w, k in count.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r[0], r[1] or "", r[2], r[3], r[4], r[5] or 0) for r in df.collect())


def test_runs_of_letters():
    text = "Été ÀÉ×÷ÿ a-b ſ straße Ā x²y ｆｕｌｌ 🙂z ß" + " Q" * 5
    assert {w.decode(): n for w, n in runs(text.encode()).items()} == Counter(map(small, RUN.findall(text)))


def test_dense_words_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 50)
    monkeypatch.setattr(variants, "FLUSH", 100)
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(250)]
    vocabulary += ["aaaaa", "aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "babababa"]
    weights = [rng.choice([1, 1, 2, 4, 9, 30]) for _ in vocabulary]
    rows = [(k, " ".join(w.upper() if rng.random() < 0.1 and "é" not in w else w for w in rng.choices(vocabulary, weights, k=rng.randint(0, 200)))) for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"word": F.lit("w"), "n": F.lit(1), "s": F.lit(0)})
    assert got(spelling_variants(docs)) == plainly(rows)


def test_long_words_meet_by_hashes(spark, monkeypatch):
    monkeypatch.setattr(variants, "LONG", 6)
    rng = random.Random(5)
    base = ["".join(rng.choice("ab") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    rows = [(k, " ".join(rng.choices(base, k=60))) for k in range(20)]
    assert got(spelling_variants(spark.createDataFrame(rows, DOCS))) == plainly(rows)


def test_very_long_runs_chains_ties_and_nulls(spark):
    long = "ab" * 2500
    rows = [(1, "color " * 3 + "colour " * 6 + "colours " * 12 + "colouur " * 24), (2, None), (None, "  "), (3, "tiess tiest tieso " * 3 + "ties " * 3),
            (4, f"{long} {long}x {long} {long} {long}x {long}x {long}y {long}y {long}y {'q' * 70} " + f"{'q' * 71} " * 6 + f"{'q' * 70} " * 2),
            (None, "color color"), (1, ""), (5, "word " * 400_000 + "wordy " * 7)]
    assert got(spelling_variants(spark.createDataFrame(rows, DOCS), slip=10**9 + 7)) == plainly(rows, 10**9 + 7)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert got(spelling_variants(empty)) == []
    assert got(spelling_variants(spark.createDataFrame([(1, "to be or not")], DOCS))) == []
