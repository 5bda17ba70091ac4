"""S2-S5, S8, J2, Q6, W4, A3, R1-R6."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from sheaf.operators.embed import BatchEncoder
from sheaf.plans.ingest import bulk_load, ingest, load_report
from sheaf.plans.store import FilingStore
from sheaf.sources.events import enrich, from_manifest, metadata_for_ticker, parse_events, typed_rows
from sheaf.streaming import ingest_stream

EVENT = {"event_type": "filing.downloaded", "schema_version": 1, "ticker": "QRY", "company_name": "QUARRY STONE PLC",
         "filing_date": "2019-02-07", "form": "10-K", "accession_number": "0000900017-19-000042",
         "local_path": "/data/a.htm", "document_url": "https://filings.invalid/q/a.htm",
         "downloaded_at": "2019-02-08T06:05:04.030201Z"}
PAGE = "<html><body><p>ITEM 1. Quarries</p><p>We cut stone. " + "Slabs and blocks. " * 10 + "</p></body></html>"


def _events(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_no long, value string")


def test_decode_and_validate(spark):
    bad_type = dict(EVENT, event_type="filing.updated")
    missing = {k: v for k, v in EVENT.items() if k != "ticker"}
    rows = parse_events(_events(spark, [json.dumps(EVENT), "{nope", json.dumps(bad_type), json.dumps(missing),
                                        json.dumps(dict(EVENT, extra=1))]), "value", ["event_no"])
    got = {r.event_no: (r.valid, r.reject_reason) for r in rows.collect()}
    assert got[0] == (True, None)
    assert got[1] == (False, "malformed json")
    assert got[2] == (False, "unsupported event_type: filing.updated")
    assert got[3] == (False, "missing field: ticker")
    assert got[4] == (True, None)


def test_manifest_defaults(spark):
    m = spark.createDataFrame([("QRY", "Q", "10-K", "z-1", "2019-02-07", "/data/a.htm")],
                              "ticker string, company_name string, form string, accession_number string, "
                              "filing_date string, local_path string")
    r = from_manifest(m).first()
    assert r.valid and r.document_url == "" and str(r.downloaded_at).startswith("2026-01-01")


def test_enrich_replaces_whole_row_and_list_by_ticker(spark):
    ev = parse_events(_events(spark, [json.dumps(EVENT), json.dumps(dict(EVENT, accession_number="other"))]),
                      "value", ["event_no"])
    meta = spark.createDataFrame([("0000900017-19-000042", "QRY", "Quarry", "10-Q", "2019-02-09", "/data/m.htm",
                                   None, "2019-02-10T00:00:00Z", "x")],
                                 "accession_number string, ticker string, company_name string, form string, "
                                 "filing_date string, local_path string, document_url string, downloaded_at string, "
                                 "_id string")
    out = {r.accession_number: r for r in enrich(ev, meta).collect()}
    hit = out["0000900017-19-000042"]
    assert hit.enriched and hit.form == "10-Q" and not hit.valid and hit.reject_reason == "missing field: document_url"
    assert out["other"].valid and not out["other"].enriched
    assert metadata_for_ticker(meta, "qry", ["10-q"]).count() == 1
    assert metadata_for_ticker(meta, "qry", ["10-k"]).count() == 0
    assert metadata_for_ticker(meta, "qry", []).count() == 1


def test_ingest_duplicates_and_report(spark):
    docs = spark.createDataFrame([("/data/a.htm", PAGE), ("/data/b.htm", "<html><body></body></html>")],
                                 "path string, html string")
    vals = [json.dumps(EVENT), json.dumps(dict(EVENT, company_name="the later one")),
            json.dumps(dict(EVENT, accession_number="z-8k", form="8-K")),
            json.dumps(dict(EVENT, accession_number="z-empty", local_path="/data/b.htm")),
            json.dumps(dict(EVENT, accession_number="z-out", local_path="/data/../etc/passwd")),
            json.dumps(dict(EVENT, accession_number="z-miss", local_path="/data/none.htm"))]
    ev = parse_events(_events(spark, vals), "value", ["event_no"])
    res = ingest(ev, docs, base_dir="/data")
    got = {r.event_no: (r.status, r.reason) for r in res.outcomes.collect()}
    assert got[0][0] == "loaded" and got[1] == ("skipped", "duplicate in batch")
    assert got[2] == ("skipped", "form not allowed")
    assert got[3] == ("failed", "no extractable text")
    assert got[4] == ("failed", "outside data folder")
    assert got[5] == ("failed", "file not found")
    assert res.filings.first().company_name == "QUARRY STONE PLC"
    forced = ingest(ev, docs, base_dir="/data", skip_if_processed=False)
    assert forced.filings.first().company_name == "the later one"
    rep = load_report(forced.outcomes).first()
    assert (rep.found, rep.processed, rep.skipped, rep.failed) == (6, 2, 1, 3)
    assert len(rep.errors) == 3 and rep.total_chunks > 0
    capped = load_report(forced.outcomes, max_errors=2).first()
    assert len(capped.errors) == 2


def _value(spark, *events):
    return spark.createDataFrame([(k, json.dumps(e)) for k, e in enumerate(events)], "event_no long, value string")


def test_numbers_and_booleans_are_no_text(spark):
    rows = parse_events(_value(spark, dict(EVENT, ticker=123), dict(EVENT, form=True), dict(EVENT, company_name=None), EVENT), "value", ["event_no"])
    got = {r.event_no: (r.valid, r.reject_reason) for r in rows.collect()}
    assert got == {0: (False, "not a text field: ticker"), 1: (False, "not a text field: form"),
                   2: (False, "missing field: company_name"), 3: (True, None)}


def test_a_replayed_micro_batch_gives_the_same_outcomes(spark):
    root = tempfile.mkdtemp(prefix="sheaf-replay-")
    store = FilingStore(spark, os.path.join(root, "tables"))
    docs = spark.createDataFrame([("/data/a.htm", PAGE)], "path string, html string")
    batch = _value(spark, EVENT, dict(EVENT, accession_number="z-2"))
    outcomes = lambda: sorted((r.run_id, r.event_no, r.status) for r in spark.read.parquet(f"{root}/tables/outcomes").collect())
    for _ in range(2):
        ingest_stream.process_batch(batch, 0, store, docs, "run a")
        assert outcomes() == [("run a", 0, "loaded"), ("run a", 1, "loaded")]
    # a new checkpoint starts again at batch 0: another run, nothing is erased
    ingest_stream.process_batch(_value(spark, EVENT, dict(EVENT, accession_number="z-3")), 0, store, docs, "run b")
    assert store.filings().count() == 3 and store.index_ready()
    assert outcomes()[2:] == [("run b", 0, "skipped"), ("run b", 1, "loaded")]


def test_stream_replay_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="sheaf-stream-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    with open(os.path.join(src, "e1.json"), "w") as fh:
        fh.write(json.dumps(EVENT) + "\n" + "not json\n")
    docs = spark.createDataFrame([("/data/a.htm", PAGE)], "path string, html string")
    store = FilingStore(spark, os.path.join(root, "tables"))
    ckpt = os.path.join(root, "ckpt")
    for _ in range(2):   # second run reuses the checkpoint: nothing new, nothing doubled
        q = ingest_stream.start(ingest_stream.file_events(spark, src), store, docs, ckpt,
                                trigger={"availableNow": True}, name=None)
        q.awaitTermination(120)
        assert ingest_stream.status(q)["last_error"] is None
    assert store.filings().count() == 1
    outcomes = spark.read.parquet(os.path.join(root, "tables", "outcomes"))
    assert sorted(r.status for r in outcomes.collect()) == ["failed", "loaded"]
    with open(os.path.join(src, "e2.json"), "w") as fh:
        fh.write(json.dumps(EVENT) + "\n")
    q = ingest_stream.start(ingest_stream.file_events(spark, src), store, docs, ckpt, trigger={"availableNow": True})
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(root, "tables", "outcomes"))
    assert out.filter(F.col("reason") == "already processed").count() == 1
    assert store.chunks().count() >= 1


def test_a_filing_that_cannot_be_encoded_fails_alone(spark):
    def picky():
        def encode(texts):
            if any("flood" in t for t in texts):
                raise RuntimeError("no floods")
            return [[3.0, 4.0] for _ in texts]
        return encode
    docs = spark.createDataFrame([("/data/a.htm", PAGE), ("/data/b.htm", PAGE.replace("Quarries", "flood"))], "path string, html string")
    ev = parse_events(_value(spark, EVENT, dict(EVENT, accession_number="z-b", local_path="/data/b.htm")), "value", ["event_no"])
    res = ingest(ev, docs, base_dir="/data", encoder=BatchEncoder(picky, dim=2, batch_size=4))
    got = {r.event_no: (r.status, r.reason, r.chunk_count > 0) for r in res.outcomes.collect()}
    assert got == {0: ("loaded", None, True), 1: ("failed", "encoding failed: no floods", False)}
    assert [r.accession_number for r in res.filings.collect()] == [EVENT["accession_number"]]
    vectors = [r.embedding for r in res.chunks.collect()]
    assert vectors and all(abs(v[0] - 0.6) < 1e-6 and abs(v[1] - 0.8) < 1e-6 for v in vectors)       # unit vectors


def test_bulk_load_of_a_ticker(spark):
    store = FilingStore(spark, tempfile.mkdtemp(prefix="sheaf-bulk-"))
    docs = spark.createDataFrame([("/data/a.htm", PAGE)], "path string, html string")
    cols = ["accession_number", "ticker", "company_name", "form", "filing_date", "local_path", "document_url", "downloaded_at"]
    rows = [(f"b-{k}", "QRY" if k < 4 else "OTH", "Q", "10-Q" if k == 3 else "10-K", "2019-02-07",
             "/data/none.htm" if k == 2 else "/data/a.htm", "u", "2019-02-08T00:00:00Z") for k in range(6)]
    meta = spark.createDataFrame(rows + rows[:1], cols)                                              # one document twice
    for _ in range(2):                                                                               # loading again is allowed
        r = bulk_load(store, meta, docs, "qry", ["10k"], base_dir="/data").first()
        assert (r.ticker, r.found, r.processed, r.skipped, r.failed, r.errors) == ("QRY", 3, 2, 0, 1, ["b-2: file not found"])
    assert store.filings().count() == 2 and store.index_ready()
    assert bulk_load(store, meta, docs, "qry", ["10-K"], base_dir="/data", reprocess=False).first().skipped == 2
