"""Snapshots, segments, pruned search and fetching by path: K2, K4, K5, K9, J3, J4, S6, Q1, R3."""

import datetime as dt
import os
import random
import tempfile
import threading

from pyspark.sql import functions as F

from sheaf.operators import keyword
from sheaf.plans.ingest import ingest
from sheaf.plans.snapshots import Snapshot
from sheaf.plans.store import CHUNKS, FILINGS, FilingStore
from sheaf.sources.documents import DocumentFiles
from sheaf.sources.events import typed_rows

FILING = "accession_number string, ticker string, form string, processed_at timestamp, chunk_count int, deleted boolean, batch_id long"
CHUNK = "accession_number string, chunk_index int, content string, metadata string, batch_id long"


def _write(store, batch_id, texts, run="run", form="10-K"):
    """texts: accession number -> chunks"""
    spark, ts = store.spark, dt.datetime(2024, 1, 1) + dt.timedelta(days=batch_id)
    f = spark.createDataFrame([(a, "TK", form, ts, len(c), False, batch_id) for a, c in texts.items()], FILING)
    c = spark.createDataFrame([(a, k, t, "{}", batch_id) for a, cs in texts.items() for k, t in enumerate(cs)], CHUNK)
    return store.write_batch(f, c, run, batch_id)


def _store(spark, **kw):
    return FilingStore(spark, tempfile.mkdtemp(prefix="sheaf-snap-"), key_buckets=4, term_buckets=4, **kw)


def _texts(store):
    return {(r.accession_number, r.chunk_index): r.content for r in store.chunks().collect()}


def _check_index(store):
    """The stored index against one built from the current chunks."""
    index, built = store.keyword_index(), keyword.build_index(store.chunks())
    rows = lambda df, *cols: sorted(map(tuple, df.select(*cols).collect()))
    assert rows(index.terms, "term", "df") == rows(built.terms, "term", "df")
    assert rows(index.postings, "term", *keyword.KEY, "tf", "dl") == rows(built.postings, "term", *keyword.KEY, "tf", "dl")
    a, b = index.corpus.first(), built.corpus.first()
    assert a.n_chunks == b.n_chunks and (a.avgdl is None and b.avgdl is None or abs(a.avgdl - b.avgdl) < 1e-9)
    assert store.index_ready()


def test_a_replay_that_loads_nothing_leaves_nothing(spark):
    store = _store(spark)
    _write(store, 0, {"a": ["an old text"]})
    _write(store, 1, {"a": ["a new text"], "b": ["another"]})
    _write(store, 1, {})
    assert _texts(store) == {("a", 0): "an old text"}                       # what the batch had replaced is back
    _check_index(store)


def test_a_late_replay_keeps_what_came_after_replaced(spark):
    store = _store(spark)
    _write(store, 0, {"a": ["first"], "c": ["stays"]})
    _write(store, 1, {"a": ["second pump"], "b": ["b one"]})
    _write(store, 0, {"a": ["third"]}, run="other")
    _write(store, 1, {"b": ["b two valve"]})                                # batch 1 again, now without a
    assert _texts(store) == {("a", 0): "third", ("b", 0): "b two valve", ("c", 0): "stays"}
    _check_index(store)


def test_index_follows_batches_deletes_merges_and_truncation(spark):
    rng = random.Random(3)
    store, words = _store(spark), ["pump", "valve", "river", "stone", "über", "freight"]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(1, 9)))
    now = {}
    for batch in range(5):
        texts = {f"f{rng.randint(0, 7)}": [text() for _ in range(rng.randint(0, 3))] for _ in range(4)}
        _write(store, batch, texts, run=f"run {batch % 2}")
        for a, cs in texts.items():
            now = {k: v for k, v in now.items() if k[0] != a} | {(a, k): t for k, t in enumerate(cs)}
    store.delete(["f1", "f2", "nobody"])
    now = {k: v for k, v in now.items() if k[0] not in ("f1", "f2")}
    assert _texts(store) == now
    _check_index(store)
    assert store.merge(2) and _texts(store) == now
    _check_index(store)
    _write(store, 9, {"f3": ["after the merge"]}, run="late")
    now = {k: v for k, v in now.items() if k[0] != "f3"} | {("f3", 0): "after the merge"}
    while store.merge(2):
        pass
    assert _texts(store) == now
    store.compact()
    assert _texts(store) == now and store.chunk_versions().count() == len(now) and len(store.snapshot().entries) == 1
    _check_index(store)
    store.vacuum(older_than_s=-1)
    assert _texts(store) == now and os.listdir(f"{store.root}/{FILINGS}") == [f"entry={store.snapshot().entries[0].id}"]
    store.truncate(CHUNKS)
    _check_index(store)
    assert store.filings().count() > 0 == store.chunks().count()


def test_pruned_search_equals_scoring_everything_and_skips_cells(spark, monkeypatch):
    monkeypatch.setattr("sheaf.operators.blockmax.CELL", 4)
    monkeypatch.setattr("sheaf.operators.blockmax.TOGETHER", 2)
    rng = random.Random(5)
    words = ["common"] * 30 + ["pump"] * 8 + ["valve"] * 3 + ["rare"]
    store = _store(spark)
    for batch in range(2):
        _write(store, batch, {f"f{batch}-{k}": [" ".join(rng.choices(words, k=rng.randint(5, 40))) for _ in range(rng.randint(1, 5))]
                              for k in range(60)}, form="10-K" if batch else "10-Q")
    _write(store, 2, {"f0-1": ["rare rare rare"], "f1-2": ["common"]})
    store.delete(["f0-3", "f1-4"])
    index, chunks, filings = store.keyword_index(), store.chunks(), store.filings()
    rows = lambda df: [(r.accession_number, r.chunk_index, round(r.rank, 6), r.content) for r in df.collect()]
    skipped = 0
    for query, kw in [("rare", {}), ("rare valve", {}), ("valve pump common", {}), ("common", {}), ("pump valve", {"match_all": True}),
                      ("rare common", {"form": "10-k", "ticker": "tk"}), ("rare nowhere", {"match_all": True}), ("nowhere", {}), ("...", {})]:
        got, found = store.pruned_search(query, 5, first=3, **kw)
        assert rows(got) == rows(keyword.keyword_search(index, chunks, filings, query, 5, **kw)), query
        if found:
            assert found.scored <= found.cells
            skipped += found.cells - found.scored
    assert skipped > 100
    blocks, _ = store.search_blocks(["rare"])
    buckets = {f.split("bucket=")[1].split("/")[0] for f in blocks.inputFiles()}
    assert len(buckets) == 1                                                # of four


def test_a_batch_reads_its_keys_buckets_only(spark):
    store = _store(spark)
    _write(store, 0, {f"f{k}": ["text"] for k in range(40)})
    keys = spark.createDataFrame([("f1",), ("new",), (None,)], "accession_number string")
    found = store.processed(keys)
    assert [r.accession_number for r in found.collect()] == ["f1"]
    read = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if f"/{FILINGS}/" in f}
    assert len(read) <= 2 and read == {str(b) for b in store._key_buckets(keys)} & {str(b) for b in store.snapshot().entries[0].buckets[FILINGS]}
    assert store.processed(keys, but=("run", 0)).count() == 0


def test_writers_and_merges_side_by_side_lose_nothing(spark):
    store = _store(spark)
    store.create()
    assert not store.log.put(Snapshot(1))                                   # the number is taken
    _write(store, 0, {"shared": ["start"], "gone": ["soon"]}, run="start")
    errors = []

    def writer(run):
        try:
            mine = FilingStore(spark, store.root, key_buckets=4, term_buckets=4)
            for b in range(2):
                _write(mine, b, {f"{run}-{b}": [f"text of {run} {b}"], "shared": [f"{run} {b}"]}, run=run)
        except Exception as e:  # noqa: BLE001  the main thread reports it
            errors.append(e)

    def keeper():
        try:
            mine = FilingStore(spark, store.root, key_buckets=4, term_buckets=4)
            mine.compact()
            mine.delete(["gone"])
            mine.merge(2)
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    threads = [threading.Thread(target=writer, args=(f"run{k}",)) for k in range(2)] + [threading.Thread(target=keeper)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    got = _texts(store)
    assert {k for k, _ in got} == {"run0-0", "run0-1", "run1-0", "run1-1", "shared"} and len(got) == 5
    _check_index(store)


PAGE = "<html><body><p>We cut stone é. {}</p></body></html>"


def test_only_wanted_files_are_opened(spark):
    folder = tempfile.mkdtemp(prefix="sheaf-docs-")
    for k in range(30):
        with open(f"{folder}/{k}.htm", "wb") as fh:
            fh.write(PAGE.format(k).encode() + (b"\xff\xfe" if k == 3 else b""))
    files = DocumentFiles(spark, "/data", folder)
    wanted = spark.createDataFrame([("/data/3.htm",), ("/data/7.htm",), ("/data/7.htm",), ("/data/none.htm",), (None,)], "path string")
    got = {r.path: r.html for r in files.fetch(wanted).collect()}
    assert set(got) == {"/data/3.htm", "/data/7.htm"} and got["/data/3.htm"].endswith("��") and "é" in got["/data/7.htm"]
    assert files.files_read.value % 2 == 0 and files.bytes_read.value == files.files_read.value // 2 * sum(
        os.path.getsize(f"{folder}/{k}.htm") for k in (3, 7))
    assert files.fetch(wanted.limit(0)).count() == 0
    # J4 through a batch: documents of skipped events are not opened
    rows = [(k, f"a-{k}", "TK", "C", "10-K" if k < 3 else "8-K", dt.date(2024, 1, 1), f"/data/{k}.htm" if k else "/data/none.htm", "u",
             dt.datetime(2024, 1, 1)) for k in range(6)]
    ev = typed_rows(spark.createDataFrame(rows, "event_no long, accession_number string, ticker string, company_name string, form string, "
                                                "filing_date date, local_path string, document_url string, downloaded_at timestamp"), ["event_no"])
    files = DocumentFiles(spark, "/data", folder)
    res = ingest(ev, files, base_dir="/data")
    assert sorted((r.event_no, r.status, r.reason) for r in res.outcomes.collect()) == [
        (0, "failed", "file not found"), (1, "loaded", None), (2, "loaded", None), *((k, "skipped", "form not allowed") for k in (3, 4, 5))]
    assert files.files_read.value == 2 and files.not_found.value == 1


def test_a_table_of_documents_still_joins(spark):
    docs = spark.createDataFrame([("/data/x/../1.htm", PAGE.format(1))], "path string, html string")
    ev = typed_rows(spark.createDataFrame([(1, "a", "T", "C", "10-K", dt.date(2024, 1, 1), "/data/1.htm", "u", dt.datetime(2024, 1, 1))],
                                          "event_no long, accession_number string, ticker string, company_name string, form string, "
                                          "filing_date date, local_path string, document_url string, downloaded_at timestamp"), ["event_no"])
    assert ingest(ev, docs, base_dir="/data").outcomes.filter(F.col("status") == "loaded").count() == 1
