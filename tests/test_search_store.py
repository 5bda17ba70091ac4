"""K1-K7, Q1, Q2, Q3, Q4, P12, P15, P17, T4, A2, A6, A9, J5, E1-E4."""

import collections
import datetime as dt
import math
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from sheaf.functions.meta import metadata_json
from sheaf.operators import blockmax, keyword, semantic
from sheaf.operators.embed import BatchEncoder, HashingEncoder, embed, get_encoder
from sheaf.plans import quality, search
from sheaf.plans.store import FilingStore

CHUNK = "Orders for river pumps grew by a fifth while freight costs fell."


def _batch(spark, acc, content, batch_id, ts):
    f = spark.createDataFrame(
        [(acc, "RVP", "River Pumps Ltd", "10-Q", dt.date(2021, 3, 9), "https://filings.invalid/rvp", "/data/rvp.htm",
          dt.datetime(2021, 3, 10), ts, 1, False, batch_id)],
        "accession_number string, ticker string, company_name string, form string, filing_date date, "
        "document_url string, local_path string, downloaded_at timestamp, processed_at timestamp, chunk_count int, "
        "deleted boolean, batch_id long")
    c = (f.select("accession_number", F.lit(0).alias("chunk_index"), F.lit("Item 2").alias("section"),
                  F.lit(content).alias("content"), "ticker", "company_name", "form", "filing_date",
                  "local_path", "document_url", "batch_id")
         .withColumn("metadata", metadata_json("section")))
    c = embed(c, "content", HashingEncoder(64))
    return f, c


def _store(spark, **kw):
    return FilingStore(spark, tempfile.mkdtemp(prefix="sheaf-store-"), **kw)


def _accessions(df):
    return sorted(r["accession_number"] for r in df.select("accession_number").collect())


def test_store_upsert_search_delete(spark):
    store = _store(spark)
    store.create()
    store.write_batch(*_batch(spark, "rvp-1", "An earlier wording.", 1, dt.datetime(2021, 4, 2)), "run")
    for _ in range(2):                          # the replay of batch 2 replaces itself
        store.write_batch(*_batch(spark, "rvp-1", CHUNK, 2, dt.datetime(2021, 4, 3)), "run")
    assert store.filing_versions().count() == 2
    chunks = store.chunks()
    assert [r.content for r in chunks.collect()] == [CHUNK]
    assert quality.duplicate_keys(chunks, ["accession_number", "chunk_index"]).count() == 0
    assert quality.orphan_chunks(chunks, store.filings()).count() == 0
    assert quality.chunk_count_mismatch(store.filings(), chunks).count() == 0
    index = store.keyword_index()               # kept by the writes, nothing is rebuilt
    find = lambda q, **kw: keyword.keyword_search(index, chunks, store.filings(), q, 5, **kw)
    assert _accessions(find("pumps wording")) == ["rvp-1"]
    assert find("pumps wording", match_all=True).count() == 0
    assert find("freight", ticker="rvp", form="10-q").count() == 1 and find("freight", form="10-K").count() == 0
    st = search.stats(store.filings(), chunks, store.index_ready()).first()
    assert (st.filing_count, st.chunk_count, st.bm25_ready) == (1, 1, True)
    text = search.render(find("freight")).first().text
    assert text.startswith("[1] RVP 10-Q (rvp-1, chunk 0) rank=") and text.endswith(CHUNK) and "| Item 2" in text
    store.delete(["rvp-1"])
    assert store.filings().count() == 0 and store.chunks().count() == 0
    with pytest.raises(ValueError):
        store.truncate("other")


def test_another_run_with_the_same_batch_number_erases_nothing(spark):
    store = _store(spark)
    ts = dt.datetime(2021, 4, 2)
    store.write_batch(*_batch(spark, "a", "one", 0, ts), "first run")
    store.write_batch(*_batch(spark, "b", "two", 0, ts), "second run")
    store.write_batch(*_batch(spark, "c", "three", 0, ts))
    assert _accessions(store.filings()) == ["a", "b", "c"]
    store.delete(["b"])
    assert _accessions(store.filings()) == ["a", "c"] == _accessions(store.chunks())
    assert _accessions(store.keyword_index().postings) == ["a", "c"] and store.index_ready()


def test_a_crash_between_chunks_and_filings_shows_nothing(spark, monkeypatch):
    store = _store(spark)
    store.write_batch(*_batch(spark, "a", "one", 0, dt.datetime(2021, 4, 2)), "run")
    real = FilingStore._write

    def broken(self, df, table, run_id):
        if table == "filings":
            raise RuntimeError("lost")
        real(self, df, table, run_id)
    monkeypatch.setattr(FilingStore, "_write", broken)
    with pytest.raises(RuntimeError):
        store.write_batch(*_batch(spark, "a", "newer", 1, dt.datetime(2021, 4, 3)), "run")
    monkeypatch.undo()
    assert [r.content for r in store.chunks().collect()] == ["one"] and store.index_ready()


def test_compaction_and_truncation_switch_generations(spark, monkeypatch):
    store = _store(spark)
    for k, acc in enumerate(["a", "b", "a"]):
        store.write_batch(*_batch(spark, acc, f"text {k}", k, dt.datetime(2021, 4, 2 + k)), "run")
    store.delete(["b"])
    real = FilingStore._path
    monkeypatch.setattr(FilingStore, "_path", lambda self, t, g=None: "nofs://x" if g and t == "lengths" else real(self, t, g))
    with pytest.raises(Exception):
        store.compact()
    monkeypatch.undo()
    assert [r.content for r in store.chunks().collect()] == ["text 2"]          # the old generation stays in force
    store.compact()
    store.vacuum()
    assert store.filing_versions().count() == 1 == store.chunk_versions().count() and store.index_ready()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store.truncate_search_index()
        assert store.chunk_versions().count() == 0 == store.keyword_index().postings.count() and _accessions(store.filings()) == ["a"]
        store.truncate("filings")
        assert store.filing_versions().count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_vectors_of_another_length_are_refused_until_the_dimension_changes(spark):
    store = _store(spark, dim=64)
    store.write_batch(*_batch(spark, "a", "one", 0, dt.datetime(2021, 4, 2)))
    store.change_dimension(32)
    assert [(r.content, r.embedding) for r in store.chunks().collect()] == [("one", None)]
    with pytest.raises(Exception, match="vector length must be 32, got 64"):
        store.write_batch(*_batch(spark, "b", "two", 0, dt.datetime(2021, 4, 3)))


def test_index_is_ready_only_for_exactly_the_current_chunks(spark):
    chunks = spark.createDataFrame([("a", 0, "words here"), ("a", 1, "* * *")], "accession_number string, chunk_index int, content string")
    lengths = keyword.lengths_of(chunks)
    assert quality.index_ready(lengths, chunks) and not quality.index_ready(None, chunks)
    assert not quality.index_ready(lengths.filter("chunk_index = 0"), chunks)
    assert not quality.index_ready(lengths, chunks.withColumn("accession_number", F.lit("b")))


def test_a_stored_index_knows_its_buckets_and_skips_deleted_chunks(spark):
    rows = [(f"f{k}", 0, "pump " * (k + 1) + "valve", "{}") for k in range(6)]
    chunks = spark.createDataFrame(rows, "accession_number string, chunk_index int, content string, metadata string")
    filings = chunks.select("accession_number")
    path = tempfile.mkdtemp(prefix="sheaf-idx-")
    keyword.write_index(keyword.build_index(chunks, buckets=7), path)
    index = keyword.read_index(spark, path)
    assert index.buckets == 7 and keyword.keyword_search(index, chunks, filings, "pump", 5).count() == 5
    left = chunks.filter("accession_number NOT IN ('f5', 'f4')")
    assert keyword.keyword_search(index, left, filings, "pump", 3).count() == 3


def test_request_rules_and_similarity(spark):
    assert search.check_request("  q ", 10, " Keyword ") == ("q", 10, "keyword")
    for bad in [("  ", 10, "semantic"), ("q", 0, "semantic"), ("q", 101, "semantic"), ("q", 5, "fuzzy")]:
        with pytest.raises(ValueError):
            search.check_request(*bad)
    df = spark.createDataFrame([(0.31,)], "distance double")
    assert df.select(F.round(1 - F.col("distance"), 4).alias("s")).first().s == 0.69


def test_semantic_zero_vector_last(spark):
    ch = spark.createDataFrame([("a", 0, [0.0, 0.0]), ("b", 0, [1.0, 0.0]), ("c", 0, [0.0, 1.0])],
                               "accession_number string, chunk_index int, embedding array<float>")
    rows = semantic.semantic_search(ch, [1.0, 0.0], 3).collect()
    assert [r.accession_number for r in rows] == ["b", "c", "a"]
    assert math.isnan(rows[-1].distance)
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id long, vec array<float>")
    top = semantic.semantic_search_batch(ch, q, 1).orderBy("query_id").collect()
    assert [(r.query_id, r.accession_number) for r in top] == [(1, "b"), (2, "c")]


def test_batch_encoder_contract(spark):
    def factory():
        def enc(texts):
            return [[float(len(t)), 1.0] for t in texts]
        return enc
    df = spark.createDataFrame([("a",), ("bb",), ("ccc",)], "content string").coalesce(1)
    out = embed(df, "content", BatchEncoder(factory, dim=2, batch_size=2)).collect()
    assert [round(r.embedding[0] / r.embedding[1], 4) for r in out] == [1.0, 2.0, 3.0]          # order kept
    assert all(abs(sum(x * x for x in r.embedding) - 1.0) < 1e-5 for r in out)                   # unit vectors
    with pytest.raises(ValueError):
        BatchEncoder(factory, dim=2, batch_size=0)
    with pytest.raises(ValueError):
        get_encoder("nope")

    def bad_factory():
        return lambda texts: [[1.0, 1.0]]
    with pytest.raises(Exception):
        embed(df, "content", BatchEncoder(bad_factory, dim=2, batch_size=2)).collect()
    v = embed(spark.createDataFrame([("the cat the",)], "content string"), "content", HashingEncoder(16)).first()
    assert abs(sum(x * x for x in v.embedding) - 1.0) < 1e-5


def test_quality_helpers(spark):
    f = spark.createDataFrame([("a", dt.date(2024, 1, 2)), ("b", dt.date(2024, 1, 3))],
                              "accession_number string, filing_date date")
    assert [r.accession_number for r in quality.latest_filings(f, 1).collect()] == ["b"]
    m = spark.createDataFrame([("BAAI/bge-m3",), ("bge-small-en",), ("other",)], "m string")
    assert [r.d for r in m.select(quality.model_dimension("m").alias("d")).collect()] == [1024, 384, 0]
    rep = quality.schema_report({"filings": f})
    assert rep.count() == 2


def test_batch_search_gives_k_rows_when_the_index_is_older_than_the_chunks(spark):
    chunks = spark.createDataFrame([(f"a{k}", 0, "river " * (20 - k) + "pumps " * k) for k in range(10)],
                                   "accession_number string, chunk_index int, content string")
    index = keyword.build_index(chunks)
    left = chunks.filter("accession_number not in ('a0', 'a1', 'a2')")           # the best for "river" are deleted
    queries = spark.createDataFrame([(1, "river"), (2, "pumps")], "query_id long, text string")
    got = keyword.keyword_search_batch(index, left, queries, top_k=3).orderBy("query_id", "rank_no").collect()
    assert [(r.query_id, r.accession_number) for r in got] == [(1, "a3"), (1, "a4"), (1, "a5"), (2, "a9"), (2, "a8"), (2, "a7")]


def _many_chunks(spark, n=700):
    rows = [(f"f{k % 40:02d}" if k % 97 else None, k // 40, None if k % 31 == 5 else " ".join(f"W{k % m}-w{k % (m + 1)}" for m in range(2, 2 + k % 9)))
            for k in range(n)]
    return spark.createDataFrame(rows, "accession_number string, chunk_index int, content string"), rows


def _counted(rows):
    out = []
    for a, i, text in rows:
        words = [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]
        out += [(t, a, i, n, len(words)) for t, n in collections.Counter(words).items()]
    return collections.Counter(out)


def _small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, "37")
    return lambda: spark.conf.set(name, was)


def test_postings_are_counted_where_the_chunks_are(spark):
    chunks, rows = _many_chunks(spark)
    back = _small_batches(spark)
    try:
        found = keyword.postings_of(chunks.withColumn("sign", F.lit(-1)), ["sign"])
        got = collections.Counter((r.term, r.accession_number, r.chunk_index, r.tf, r.dl) for r in found.collect())
    finally:
        back()
    assert got == _counted(rows) and {r.sign for r in found.limit(5).collect()} == {-1}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    assert keyword.postings_of(chunks.limit(0)).count() == 0


def test_blocks_shuffle_texts_once_and_no_postings(spark):
    chunks, rows = _many_chunks(spark)
    back = _small_batches(spark)
    try:
        blocks = blockmax.blocks_of(chunks, len(rows))
        got = blocks.collect()
    finally:
        back()
    assert collections.Counter((b.term, p.accession_number, p.chunk_index, p.tf, p.dl) for b in got for p in b.list) == _counted(rows)
    assert len({(b.term, b.cell) for b in got}) == len(got) and len({b.cell for b in got}) > 1     # a block is whole
    assert all((b.n, b.max_tf, b.min_dl) == (len(b.list), max(p.tf for p in b.list), min(p.dl for p in b.list)) for b in got)
    plan = blocks._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan
    assert blockmax.blocks_of(chunks.limit(0), 0).count() == 0


def test_postings_meet_only_marks_that_are_in_force(spark):
    store = _store(spark, merge_factor=None)
    for k in (1, 2):
        store.write_batch(*_batch(spark, f"rvp-{k}", CHUNK, k, dt.datetime(2021, 4, k)), f"run-{k}")
    store.delete(["rvp-1"])
    assert _accessions(store.keyword_index().postings.select("accession_number").distinct()) == ["rvp-2"]
    store.compact()
    postings = store.keyword_index().postings
    assert _accessions(postings.select("accession_number").distinct()) == ["rvp-2"]
    assert "LeftAnti" not in postings._jdf.queryExecution().executedPlan().toString()


def test_an_index_of_these_chunks_is_not_joined_with_them(spark):
    chunks, _ = _many_chunks(spark)
    chunks = chunks.withColumn("metadata", F.lit("{}"))
    index, queries = keyword.build_index(chunks), spark.createDataFrame([(1, "w2 w5"), (2, "w1")], "query_id long, text string")
    found = keyword.keyword_search_batch(index, chunks, queries, 3)
    again = keyword.keyword_search_batch(index, chunks.select("*"), queries, 3)      # another table, as far as anyone knows
    key = lambda df: sorted((r.query_id, r.rank_no, r.accession_number, r.chunk_index, round(r.rank, 6)) for r in df.collect())
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (found, again)]
    assert "LeftSemi" not in plans[0] and "LeftSemi" in plans[1]
    assert key(found) == key(again) and len(key(found)) == 6
    assert all(r.accession_number for r in found.collect())
