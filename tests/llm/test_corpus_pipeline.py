"""The pipeline, stage by stage, against brute force."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from sheaf.llm.common import settle
from sheaf.llm.decontam import words_of
from sheaf.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"kept": F.lit(1), "spans": F.lit("s"), "root": F.lit(2), "copies": F.lit(3)})
    extra = spark.createDataFrame([(900_001, None, "en", None, 0), (900_002, "12 3", None, None, 4), (None, "the the of", None, None, 10)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    now = settle(docs.unionByName(extra, allowMissingColumns=True).repartition(3))
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "sharding"]

    before, now = now, settle(stages["language_id"](spark, now, SF))
    ids = lambda df: sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=str)
    assert now.columns == before.columns
    assert ids(now) == sorted([k for k in ids(before) if k not in (900_001, 900_002)], key=str)

    before, now = now.toPandas(), settle(stages["simhash_near_dedup"](spark, now, SF))
    prints = np.array([fingerprint(t.encode()) for t in before.text], np.uint64)
    gone, order = set(), np.argsort(before.doc_id.fillna(np.inf).to_numpy(), kind="stable")
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4):
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    seen = set()
    for i in order:
        gone |= {i} if group[i] in seen else set()
        seen.add(group[i])
    keeps = sorted((None if np.isnan(before.doc_id[i]) else int(before.doc_id[i]) for i in range(len(prints)) if i not in gone), key=str)
    assert ids(now) == keeps and len(gone) > 0

    before, now = now.toPandas(), settle(stages["benchmark_decontamination"](spark, now, SF))
    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words_of(r["text"].encode())
        grams |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))}
    lengths = {len(g) for g in grams}
    clean = [i for i, t in zip(before.doc_id, before.text, strict=True)
             if not any(tuple(w[k:k + n]) in grams for w in [words_of(t.encode())] for n in lengths for k in range(len(w) - n + 1))]
    assert ids(now) == sorted((None if np.isnan(i) else int(i) for i in clean), key=str) and len(clean) < len(before)

    before, now = now.toPandas(), settle(stages["source_mixing"](spark, now, SF))
    mixed = now.toPandas()
    size = lambda f: f.text.str.split().str.len().sum()
    assert list(mixed.columns) == list(before.columns) and abs(size(mixed) / size(before) - 1.5) < 0.2
    assert mixed.groupby("doc_id", dropna=False).size().max() <= 2

    last = stages["sharding"](spark, now, SF).toPandas()
    assert list(last.columns) == [*mixed.columns, "shard", "slot"] and len(last) == len(mixed)
    for _, f in last.groupby("shard"):
        assert sorted(f.slot) == list(range(len(f)))
    assert (last.groupby("text").shard.nunique() > 1).sum() <= 15


def test_empty_documents(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        now = settle(stage(spark, now, SF))
        assert now.count() == 0


def test_repeated_rows_keep_one(spark):
    rows = [(1, "the of and to in", "en", "a", 5)] * 3 + [(None, "other words of the text", "en", "a", 5)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert settle(pipeline.simhash_near_dedup(spark, settle(docs), SF)).count() == 2
