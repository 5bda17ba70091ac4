"""FM-index and benchmark decontamination against brute force."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.llm.decontam import decontaminate, words_of
from sheaf.llm.fmindex import FMIndex, suffix_array


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=5), min_size=1, max_size=8))
def test_index_finds_every_occurrence(text, phrases):
    assert suffix_array(np.array([*text, 0])).tolist() == sorted(range(len(text) + 1), key=lambda i: [*text, 0][i:])
    index = FMIndex(np.array(text), sample=3)
    rows = np.zeros((len(phrases), 5), np.int64)
    for k, p in enumerate(phrases):
        rows[k, :len(p)] = p
    lo, hi = index.search(rows, np.array([len(p) for p in phrases]))
    for k, p in enumerate(phrases):
        assert sorted(index.locate(np.arange(lo[k], hi[k])).tolist()) == [i for i in range(len(text)) if text[i:i + len(p)] == p]


def brute(docs, items, window):
    grams = {}
    for item, text in items:
        w = words_of((text or "").encode())
        for k in range(max(1, len(w) - window + 1) if w and item is not None else 0):
            grams.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words_of((text or "").encode()), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(w[k:k + n])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def test_equals_brute_force_in_shards_and_blocks(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "B", "cé", "d1", "e"])
    text = lambda n: rng.choice([" ", "-", "\n"]).join(word() for _ in range(n))
    items = [(k, text(rng.randint(1, 9))) for k in range(30)] + [(None, "a a"), (7, None), (3, "a a a a a"), (50, "...")]
    docs = [(k, text(rng.randint(0, 60))) for k in range(80)] + [(5, None), (None, "A b"), (6, ""), (6, ""), (9, "x " * 5000 + items[4][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"spans": F.lit("s"), "items": F.lit(1), "kept": F.lit(2)})
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(str, brute(docs, items, 4)))
    for chars in (8_000_000, 40):
        got = decontaminate(d, b, d.columns, window=4, shard_words=300, block_chars=chars)
        rows = got.select("kept.doc_id", "n_words", "spans", "items", "kept.spans").collect()
        assert sorted(str((r[0], r[1], sum(y - x for x, y in r[2]), list(r[3]))) for r in rows) == want
        assert {r[4] for r in rows} == {"s"}
    assert decontaminate(d.limit(0), b, ["doc_id"]).count() == 0
    assert decontaminate(d, b.limit(0), ["doc_id"]).filter("size(spans) > 0").count() == 0
