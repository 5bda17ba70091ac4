"""The three start positions of the event log source; R6: run control."""

import json
import os
import tempfile

import pytest

from sheaf.plans.store import FilingStore
from sheaf.sources import event_log
from sheaf.sources.event_log import append, log_events, read_log
from sheaf.streaming import ingest_stream
from sheaf.streaming.control import IngestRun
from tests_support import EVENT, PAGE


def _run(spark, folder, ckpt, start, got):
    q = (log_events(spark, folder, start).writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
         .foreachBatch(lambda df, b: got.extend(sorted((r.event_no, r.value) for r in df.collect()))).start())
    assert q.awaitTermination(120)


def test_batch_reader_and_shares(spark, monkeypatch):
    folder = tempfile.mkdtemp(prefix="sheaf-log-")
    assert read_log(spark, folder).count() == 0
    assert append(folder, ["a", "é"], 0) == 0 and append(folder, ["c"], 0) == 2 and append(folder, ["x"], 3) == 0 and append(folder, [], 3) == 1
    assert sorted(tuple(r) for r in read_log(spark, folder).collect()) == [(0, 0, "a"), (0, 1, "é"), (0, 2, "c"), (3, 0, "x")]
    with pytest.raises(ValueError):
        append(folder, ["two\nlines"])
    monkeypatch.setattr(event_log, "SHARE", 2)
    append(folder, [f"v{k}" for k in range(5)], 1)
    cut = event_log.stretches(folder, {1: 1}, event_log.ends(folder))
    assert [(s.partition, s.start, s.stop) for s in cut] == [(0, 0, 2), (0, 2, 3), (1, 1, 3), (1, 3, 5), (3, 0, 1)]
    values = [v for s in cut if s.partition == 1 for b in event_log.read_stretch(folder, s) for v in b.column("value").to_pylist()]
    assert values == ["v1", "v2", "v3", "v4"]


def test_start_positions(spark):
    folder, ckpts = tempfile.mkdtemp(prefix="sheaf-log-"), tempfile.mkdtemp(prefix="sheaf-ckpt-")
    append(folder, ["a", "b"], 0)
    append(folder, ["x"], 1)
    early, late, again = [], [], []
    _run(spark, folder, f"{ckpts}/earliest", "earliest", early)
    assert [v for _, v in early] == ["a", "b", "x"] and early[2][0] == 1 << 40
    _run(spark, folder, f"{ckpts}/latest", "latest", late)
    assert late == []
    append(folder, ["c"], 0)
    append(folder, ["new partition"], 2)
    _run(spark, folder, f"{ckpts}/latest", "latest", late)
    assert sorted(v for _, v in late) == ["c", "new partition"]
    _run(spark, folder, f"{ckpts}/earliest", "committed", early)             # goes on where it stopped
    assert sorted(v for _, v in early) == ["a", "b", "c", "new partition", "x"]
    _run(spark, folder, f"{ckpts}/committed", "committed", again)            # nothing committed yet: from the beginning
    assert len(again) == 5
    with pytest.raises(ValueError):
        log_events(spark, folder, "middle")


def test_run_control(spark):
    root = tempfile.mkdtemp(prefix="sheaf-run-")
    folder, ckpt = os.path.join(root, "log"), os.path.join(root, "ckpt")
    append(folder, [json.dumps(EVENT), "not json", " "])
    store = FilingStore(spark, os.path.join(root, "tables"))
    docs = spark.createDataFrame([("/data/a.htm", PAGE)], "path string, html string")
    begin = lambda ev: ingest_stream.start(ev, store, docs, ckpt, trigger={"processingTime": "1 second"}, name="run")
    run = IngestRun(spark, lambda: log_events(spark, folder), begin)
    assert run.status()["state"] == "stopped" and run.stop()
    run.start()
    with pytest.raises(RuntimeError, match="already running"):
        run.start()
    assert run.wait("progress", 120) and run.status()["state"] == "running"
    assert run.stop(60) and run.wait("stopped")
    first = next(r for r in run.history().collect() if r.event == "progress")
    assert (first.batch_id, first.rows, first.values_seen, first.empty_values) == (0, 3, 3, 1)
    assert run.status()["state"] == "stopped" and run.status()["last_error"] is None and store.filings().count() == 1

    def broken(df, batch_id):
        raise RuntimeError("no luck")
    failing = IngestRun(spark, lambda: log_events(spark, folder), lambda ev: ev.writeStream.foreachBatch(broken).start())
    failing.start()
    assert failing.wait("failed", 60)
    assert failing.status()["state"] == "failed" and "no luck" in failing.status()["last_error"]
    assert "no luck" in failing.history().filter("event = 'failed'").first().error
    run.start()                                                              # after an end it may start again
    assert run.stop(60)


def test_a_micro_batch_leaves_no_tables_of_its_own(spark):
    from sheaf.session import ensure_checkpoint_dir
    root = tempfile.mkdtemp(prefix="sheaf-scope-")
    store = FilingStore(spark, os.path.join(root, "tables"), key_buckets=2, term_buckets=2)
    docs = spark.createDataFrame([("/data/a.htm", PAGE)], "path string, html string")
    before = set(os.listdir(ensure_checkpoint_dir(spark)))
    ingest_stream.process_batch(spark.createDataFrame([(0, json.dumps(EVENT))], "event_no long, value string"), 0, store, docs, "run")
    assert store.filings().count() == 1 and set(os.listdir(ensure_checkpoint_dir(spark))) == before
