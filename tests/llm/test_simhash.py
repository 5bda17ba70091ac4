"""Golay keys, fingerprints, components and near-dedup against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sheaf.llm.components import components
from sheaf.llm.golay import fingerprint_keys, key_sets, nearest
from sheaf.llm.simhash import fingerprint, near_dedup, print_roots


def test_code_is_perfect_and_near_words_share_a_key():
    words = np.random.default_rng(1).integers(0, 1 << 23, 4000)
    codes = {int(w) for w in words if nearest(np.array([w]))[0] << 11 == w & ~0x7FF} | {0}
    assert len(set(nearest(np.arange(1 << 23)).tolist())) == 4096 and codes
    sets = key_sets(words, 23)
    assert (sets >= 0).sum(axis=1).max() == 6
    rng = random.Random(2)
    for w, own in zip(words[:500].tolist(), sets[:500].tolist(), strict=True):
        near = w
        for b in rng.sample(range(23), 2):
            near ^= 1 << b
        assert {*own} - {-1} & {*key_sets(np.array([near]), 23)[0].tolist()} - {-1}


def test_keys_meet_up_to_four_bits_apart():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 1 << 64, 2000, dtype=np.uint64)
    for n in range(5):
        y = x.copy()
        for i in range(len(y)):
            for b in rng.choice(64, n, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        a, b = (set(zip(*(c.tolist() for c in fingerprint_keys(z)), strict=True)) for z in (x, y))
        assert len({at for at, _ in a & b}) == len(x)


def test_fingerprint_by_its_definition():
    def plain(text):
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))
    for text in ("", " \n", "One", "Ä b C", "a b c d", "A b c D e f\tg\nh  i Ä\u00a0j", "x y z w " * 9):
        assert fingerprint(text.encode()) == plain(text)
    assert fingerprint(None) == 0


def roots(values, bits=4):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_chains_and_large_groups_equal_brute_force(spark):
    rng = random.Random(7)
    values = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(150):                       # chains of steps up to 4 bits, and pairs 5 bits apart
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5])):
            v ^= 1 << b
        values.append(v)
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    got = {r["fp"]: r["root"] for r in print_roots(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    want = roots(values)
    groups = lambda names: sorted(sorted(k for k, n in enumerate(names) if n == name) for name in set(names))
    assert groups([got.get(v, v) for v in signed]) == groups([signed[k] for k in want])


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 200), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_dedup_nulls_repeats_clashes_and_empty(spark):
    rows = [(5, "a b c d e"), (3, "A B c d e"), (3, "a b c d e"), (9, None), (8, ""), (None, "a b c d e"), (None, "zz"), (7, "long text " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit("x"), "root": F.lit(1), "key": F.lit(2), "first": F.lit(3)})
    got = sorted(((str(r[0]), r[1], r[2]) for r in near_dedup(docs, docs.columns).select("kept.doc_id", "component_id", "kept.fp").collect()), key=str)
    assert got == sorted([("5", 3, "x"), ("3", 3, "x"), ("3", 3, "x"), ("None", 3, "x"), ("9", 8, "x"), ("8", 8, "x"), ("None", None, "x"), ("7", 7, "x")], key=str)
    assert near_dedup(docs.limit(0), ["doc_id"]).count() == 0
