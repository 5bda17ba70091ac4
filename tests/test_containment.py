"""Containment against a plain recursive version, alone and through the inverted table."""

import json
import random

from pyspark.sql import functions as F

from sheaf.functions.containment import holds, leaves, search_leaves

DOCS = [{"form": "10-K", "tags": ["a", "b", {"x": 1}], "nested": {"ticker": "TK1", "n": 3, "ok": True}}, {"form": "10-K"}, ["a", ["b"], 2, None], "a", 3, 2.5,
        None, True, {}, [], {"form": None, "it's \\ odd": "é"}, {"tags": [["a", "c"]], "nested": {"ticker": ["TK1"]}}, {"a": {"b": {"c": {"d": "deep"}}}}]
WANTED = [*DOCS, {"nested": {"ticker": "TK1"}}, {"tags": ["b", "a", "a"]}, {"tags": [{"x": 1}]}, {"tags": [["c"]]}, {"tags": []}, [], [2], [["b"]], "b",
          {"nested": {"n": 3.0}}, {"nested": {"ok": False}}, {"x": 1}, {"a": {"b": {"c": {"d": "deep"}}}}, {"form": 10}]


def plainly(doc, wanted, top=True):
    if isinstance(wanted, dict):
        return isinstance(doc, dict) and all(k in doc and plainly(doc[k], v, False) for k, v in wanted.items())
    if isinstance(wanted, list):
        return isinstance(doc, list) and all(any(plainly(x, v, False) for x in doc) for v in wanted)
    if isinstance(doc, list):
        return top and any(plainly(x, wanted, False) for x in doc)
    return not isinstance(doc, dict) and isinstance(doc, bool) == isinstance(wanted, bool) and doc == wanted and (doc is None) == (wanted is None)


def test_holds_as_the_rule_says(spark):
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(DOCS)] + [(100, None), (101, "{broken")], "k int, doc string")
    got = df.select("k", *[holds("doc", json.dumps(w)).alias(f"w{i}") for i, w in enumerate(WANTED)]).collect()
    for r in got:
        for i, w in enumerate(WANTED):
            want = r["k"] < 100 and plainly(DOCS[r["k"]], w)
            assert r[f"w{i}"] == want, (DOCS[r["k"]] if r["k"] < 100 else None, w)


def test_the_inverted_table_finds_the_same(spark):
    rng = random.Random(4)
    docs = [{"form": rng.choice(["10-K", "10-Q"]), "tags": rng.sample(["a", "b", "c"], rng.randint(0, 3)), "nested": {"ticker": f"TK{rng.randint(0, 3)}"}}
            for _ in range(60)]
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, doc string")
    table = leaves(df, "doc", ["k"])
    assert {r.path for r in table.select("path").distinct().collect()} == {".form", ".tags[]", ".nested.ticker"}
    for wanted in ({"form": "10-K", "tags": ["a", "c"]}, {"nested": {"ticker": "TK2"}}, {"tags": []}, {"tags": ["z"]}):
        got = {r.k for r in search_leaves(table, df, "doc", ["k"], wanted).collect()}
        assert got == {k for k, d in enumerate(docs) if plainly(d, wanted)}
    assert search_leaves(table, df.filter(F.lit(False)), "doc", ["k"], {}).count() == 0
