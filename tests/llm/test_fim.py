"""Fill-in-middle against the plain reading of its rule."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.llm.fim import cuts, fill_in_middle, restore

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def plainly(doc_id, text):
    text, digest = text or "", hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made(df):
    return sorted((tuple(r) for r in df.select("kept.doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="a \t\n\x0b é𝄞<P>", max_size=30), max_size=6), st.integers(1, 9), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cuts_equal_the_pattern(texts, piece, h1, h2):
    n, one, two = cuts(texts, np.full(len(texts), h1), np.full(len(texts), h2), piece)
    for k, t in enumerate(texts):
        units = UNIT.findall(t)
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        assert (n[k], one[k], two[k]) == (len(units), len("".join(units[:a])), len("".join(units[:b])))


def test_forms_cuts_and_round_trip(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "bc", " ", "\n", "\t ", "é", "𝄞", "<", "P>", " "]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += [None, "", " ", "  \n", "x", "has <P> in it", "<S>", "x<M>", "word " * 300_000]
    rows = list(enumerate(texts)) + [(None, "a b c"), (7, "again and again"), (7, "again and again")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"n": F.lit("n"), "form": F.lit(1), "kept": F.lit(2), "output": F.lit("o")})
    got = fill_in_middle(docs, ["doc_id", "form", "n"])
    assert made(got) == sorted(((i, *plainly(i, t)) for i, t in rows), key=repr)
    back = sorted((r[0] or "") for r in got.select(restore(F.col("output"), F.col("form"))).collect())
    assert back == sorted(t or "" for _, t in rows)
    assert {r["form"] for r in got.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_empty_table_and_parameters(spark):
    docs = spark.createDataFrame([(k, "a b c d") for k in range(50)], DOCS)
    assert fill_in_middle(docs.limit(0), ["doc_id"]).count() == 0
    assert {r["form"] for r in fill_in_middle(docs, ["doc_id"], moved=100, suffix_first=0).collect()} == {"psm"}
    assert {r["form"] for r in fill_in_middle(docs, ["doc_id"], moved=0).collect()} == {"plain"}
