"""URL rules and source mixing against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from sheaf.llm.mixing import mix, source_targets
from sheaf.llm.urlrules import judge_urls

URLS = "page_id long, url string"
RULES = "host string, path string, verdict string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    rest = rest.split("?", 1)[0].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def judged(url, rules):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_many_nested_rules_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr("sheaf.llm.urlrules.CHUNK_RULES", 7)
    monkeypatch.setattr("sheaf.llm.urlrules.BLOCK_ROWS", 50)
    rng = random.Random(5)
    labels, parts = ["a", "b", "cc", "com", "net"], ["", "x", "xy", "x/y", "z/"]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(n))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in
                  ((host(rng.randint(1, 3)), "/" + rng.choice(parts)) for _ in range(120))}.values())
    urls = [f"http://{host(rng.randint(1, 4))}{rng.choice(['', '/', '/x', '/xy/q', '/x/y?k=/z', '/z/#a', '?q', '/zz'])}" for _ in range(300)]
    urls += ["HTTP://B.A.Com/X", None, "", "no-scheme/x", "://", "a://b://c/x", "http://a..com/x", "http://com:80/"] + ["http://a.com/x"] * 200
    pages = spark.createDataFrame(list(enumerate(urls)), URLS).withColumns({"key": F.lit(1), "rule": F.lit("mine")})
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, spark.createDataFrame(rules, RULES)).collect()}
    assert got == {i: judged(u, rules) for i, u in enumerate(urls)}


def test_urls_nulls_repeats_and_empty_tables(spark):
    rules = spark.createDataFrame([("com", "/", "allow"), ("com", "/", "block"), (None, "/", "block"), ("x", None, "block"), ("", "/", "block")], RULES)
    pages = spark.createDataFrame([(None, "http://a.com/"), (1, None), (1, "http://a.com/"), (1, "http://a.com/")], URLS)
    got = sorted(map(str, ((r["page_id"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules).collect())))
    assert got == sorted(map(str, [(None, "com/", "block"), (1, None, "allow"), (1, "com/", "block"), (1, "com/", "block")]))
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert [r["verdict"] for r in judge_urls(pages, rules.limit(0)).collect()] == ["allow"] * 4


DOCS = "doc_id long, text string, source string"


def test_targets_stop_at_twice_the_size(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 500), ("d", 3), ("é", 700), (None, 40)]
    got = {r["source"]: r["target"] for r in source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weights = dict(zip(["a", "b", "c", "d", "é", None], [5, 2, 1, 5, 2, 1], strict=True))
    total, full, want = 1.5 * sum(n for _, n in sizes), {}, {}
    while True:
        rest = [s for s, _ in sizes if s not in full]
        left = total - sum(full.values())
        want = full | {s: left * weights[s] / sum(weights[x] for x in rest) for s in rest}
        above = {s: 2 * n for s, n in sizes if s in rest and want[s] > 2 * n}
        if not above:
            break
        full |= above
    assert got == pytest.approx(want)


def test_mix_is_near_its_targets_and_agrees_with_itself(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = mix(docs, ["doc_id"]).select("kept.doc_id", "source", "size", "source_size", "target", "copies", "taken").toPandas()
    again = mix(docs.repartition(7), ["doc_id"]).select("kept.doc_id", "copies").toPandas()
    assert dict(zip(first.doc_id, first.copies, strict=True)) == dict(zip(again.doc_id, again.copies, strict=True))
    assert (first.taken <= 2 * first["size"]).all() and len(first) == 1000
    for _, f in first.groupby("source"):
        assert abs(f.taken.sum() - f.target.iloc[0]) <= f["size"].max()


def test_mix_nulls_repeats_clashing_names_and_empty(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (None, " \t\n", None), (3, "ä\u00a0b c", None), (4, "", "y")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"size": F.lit(9), "target": F.lit("t"), "before": F.lit(0), "kept": F.lit(1)})
    got = mix(docs, docs.columns).select("kept.doc_id", "kept.target", "size", "source_size", "taken").collect()
    assert sorted((r["size"], r["source_size"]) for r in got) == [(0, 0), (0, 2), (0, 6), (2, 2), (3, 6), (3, 6)]
    assert {r[1] for r in got} == {"t"}
    assert mix(docs.limit(0), ["doc_id"]).count() == 0
