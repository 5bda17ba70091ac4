"""Versioned filing tables on Parquet (K1-K9, K4 protocol, R3 replay).

Layout under ``root`` (shared storage on a cluster)::

    _log/<n>.json                            manifests, see ``snapshots``; the greatest n is in force
    <table>/entry=<id>/bucket=<k>/           files of one write, never changed

Tables of an entry: ``filings``, ``filing_chunks``, ``lengths`` and ``dead`` are bucketed by accession
number; ``postings`` (blocks, see ``blockmax``) and ``terms`` by term.  ``dead`` names the versions
(accession number, entry) that the write replaced or deleted, and ``terms`` and the
manifest hold changes: what a write added less what it replaced.  So

* the current view is every version that is not dead, and a batch that asks for its keys reads
  their buckets only;
* document frequencies, chunk count and average length are sums of changes; nothing is rebuilt;
* a query lists and reads its terms' buckets only.

A write puts its files first and then its manifest.  If another writer was faster, what it replaces is
found again against the newer manifest, so writers, merges and truncation run side by side
and readers keep the snapshot they began with.  A batch is known by (run_id, batch_id): its replay takes
the place of its own entry, also if it loads nothing now.  ``merge`` rewrites
entries of similar size as one, without dead versions.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.config import SEARCH_TOP_K
from sheaf.functions.vector import check_dim
from sheaf.operators import blockmax, keyword
from sheaf.operators.embed import embed
from sheaf.operators.vector_cache import VectorCache, embed_cached
from sheaf.plans.layout import stored
from sheaf.plans.snapshots import Entry, Snapshot, SnapshotLog

FILINGS = "filings"
CHUNKS = "filing_chunks"
LENGTHS = "lengths"
DEAD = "dead"
POSTINGS = "postings"
TERMS = "terms"
TRUNCATABLE = (FILINGS, CHUNKS)

DDL = {
    FILINGS: ("accession_number string, ticker string, company_name string, form string, filing_date date, "
              "document_url string, local_path string, downloaded_at timestamp, processed_at timestamp, "
              "chunk_count int, deleted boolean, run_id string, batch_id long"),
    CHUNKS: ("accession_number string, chunk_index int, section string, content string, metadata string, "
             "embedding array<float>, run_id string, batch_id long"),
    LENGTHS: "accession_number string, chunk_index int, dl int",
    DEAD: "accession_number string, target string",
    POSTINGS: blockmax.BLOCK_DDL,
    TERMS: "term string, df long",
}
BY_TERM = (POSTINGS, TERMS)


def current_filings(versions: DataFrame) -> DataFrame:
    """Latest version per accession number, tombstones removed, of a plain table of versions.

    ``max_by`` is a partial+final aggregate: many versions of one filing are
    folded map-side before the shuffle.  (The store itself marks what a write replaces.)
    """
    cols = [c for c in versions.columns if c != "accession_number"]
    order = [c for c in ("processed_at", "batch_id", "run_id") if c in cols]
    latest = versions.groupBy("accession_number").agg(
        F.max_by(F.struct(*cols), F.struct(*order)).alias("_v"))
    return latest.select("accession_number", "_v.*").filter(~F.coalesce(F.col("deleted"), F.lit(False)))


@dataclass
class FilingStore:
    spark: SparkSession
    root: str
    dim: int | None = None           # vectors of another length are refused (P18)
    key_buckets: int = 8             # fixed when a store is made, as
    term_buckets: int = 16           # is this
    merge_factor: int | None = 8     # merge after a write when so many entries are of similar size; None: never

    def __post_init__(self):
        self.log = SnapshotLog(self.spark, f"{self.root.rstrip('/')}/_log")

    # --- files ---------------------------------------------------------------
    def _path(self, table: str, entry: str | None = None) -> str:
        return f"{self.root.rstrip('/')}/{table}" + (f"/entry={entry}" if entry else "")

    def _bucket(self, table: str) -> F.Column:
        key, n = (("term", self.term_buckets) if table in BY_TERM else ("accession_number", self.key_buckets))
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def _shaped(self, df: DataFrame, table: str) -> DataFrame:
        cols = [c.strip().split(" ", 1) for c in _columns(DDL[table])]
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in cols])

    def _write(self, df: DataFrame, table: str, entry: str) -> None:
        """One table of an entry: by bucket, sorted inside a file.  Rebalanced: a bucket is one task's, and a
        large one is split at run time.  Blocks are most of a store and stay where their cells were made:
        each task writes its part of every bucket."""
        df = self._shaped(df, table).withColumn("bucket", self._bucket(table))
        sort = ["term", "cell"] if table == POSTINGS else df.columns[:2]
        ((df if table == POSTINGS else df.hint("rebalance", F.col("bucket"))).sortWithinPartitions("bucket", *sort)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self._path(table, entry)))

    def _buckets_of(self, table: str, entry: str) -> tuple[int, ...]:
        """The buckets that an entry has files of."""
        where = self.log._path(self._path(table, entry))
        names = [s.getPath().getName() for s in self.log.fs.listStatus(where)] if self.log.fs.exists(where) else []
        return tuple(sorted(int(n.split("=")[1]) for n in names if n.startswith("bucket=")))

    def _files(self, entry: Entry, *tables: str) -> Entry:
        return replace(entry, buckets={**entry.buckets, **{t: self._buckets_of(t, entry.id) for t in tables}})

    def _read(self, table: str, entries: Iterable[Entry], buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of ``entries`` (and ``entry``, ``bucket``); only the folders of ``buckets`` are listed."""
        entries = [e for e in entries if e.buckets.get(table)]
        if buckets is None:
            paths = [self._path(table, e.id) for e in entries]
        else:
            wanted = set(buckets)
            paths = [f"{self._path(table, e.id)}/bucket={b}" for e in entries for b in e.buckets[table] if b in wanted]
        schema = f"{DDL[table]}, entry string, bucket int"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self._path(table)).parquet(*paths)

    # --- snapshots -----------------------------------------------------------
    def create(self) -> None:
        """K1: idempotent."""
        if self.log.newest() is None:
            self.log.put(Snapshot(1, (), self.dim))

    def snapshot(self) -> Snapshot:
        self.create()
        return self.log.newest()

    def _live(self, table: str, now: Snapshot, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of a table by accession number whose version is current."""
        dead = self._read(DEAD, now.entries, buckets).select("accession_number", F.col("target").alias("entry"))
        return self._read(table, now.entries, buckets).join(dead, ["accession_number", "entry"], "left_anti")

    def _dead_in_force(self, now: Snapshot) -> DataFrame:
        """(accession_number, entry) of the dead versions whose entry is still there, as a table of known size:
        a merge leaves marks of the entries that it replaced."""
        dead = self._read(DEAD, now.entries).filter(F.col("target").isin(sorted(now.ids)))
        return stored(dead.select("accession_number", F.col("target").alias("entry")), "dead")

    def _key_buckets(self, keys: DataFrame) -> list[int]:
        """The buckets of a batch's keys: at most ``key_buckets`` numbers."""
        rows = keys.select("accession_number").filter("accession_number IS NOT NULL").select(self._bucket(FILINGS).alias("b")).distinct()
        return sorted(r.b for r in rows.collect())

    # --- writing -------------------------------------------------------------
    def write_batch(self, filings: DataFrame, chunks: DataFrame, run_id: str | None = None, batch_id: int | None = None) -> str:
        """K2 + K3 + K4 + K9: chunks, their postings, then the filings rows, then the manifest (the commit).

        ``run_id``: the writer's own; a replay passes the same again.  Without one the
        batch gets a fresh run.  ``batch_id`` names the batch where its rows cannot (it may have none).
        Returns the run id.
        """
        self.create()
        run_id, entry = run_id or uuid.uuid4().hex, f"e{uuid.uuid4().hex}"
        if self.dim is not None and "embedding" in chunks.columns:
            chunks = chunks.withColumn("embedding", F.when(F.col("embedding").isNotNull(), check_dim("embedding", self.dim)))
        self._write(chunks.withColumn("run_id", F.lit(run_id)), CHUNKS, entry)
        new = self._files(Entry(entry, run_id), CHUNKS)
        mine = self._read(CHUNKS, [new])
        self._write(keyword.lengths_of(mine), LENGTHS, entry)
        new = self._files(new, LENGTHS)
        size = self._read(LENGTHS, [new]).agg(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("t")).first()
        self._write(blockmax.blocks_of(mine, size.n), POSTINGS, entry)
        self._write(filings.withColumn("run_id", F.lit(run_id)), FILINGS, entry)
        new = self._files(new, POSTINGS, FILINGS)
        batches = {r.batch_id for r in self._read(FILINGS, [new]).select("batch_id").distinct().collect()}     # one, as a rule
        new = replace(new, batches=tuple(sorted({*batches, *([] if batch_id is None else [batch_id])} - {None})), rows=size.n, chunks=size.n, tokens=size.t)
        keys = self._read(FILINGS, [new]).select("accession_number")
        self.log.commit(lambda base: self._added(base, new, keys))
        if self.merge_factor:
            self.merge(self.merge_factor)
        return run_id

    def delete(self, accession_numbers: list[str] | DataFrame) -> str:
        """K7: the filings' current versions are dead from now on.  Many filings come as a
        DataFrame with ``accession_number``."""
        keys = accession_numbers if isinstance(accession_numbers, DataFrame) else self.spark.createDataFrame(
            [(a,) for a in accession_numbers], "accession_number string")
        self.create()
        new = Entry(f"e{uuid.uuid4().hex}", uuid.uuid4().hex)
        keys = stored(keys.select("accession_number").distinct(), "keys")
        self.log.commit(lambda base: self._added(base, new, keys))
        return new.run_id

    def _added(self, base: Snapshot, new: Entry, keys: DataFrame) -> Snapshot:
        """``base`` with ``new``: the current versions of ``keys`` die, an entry of the same batch goes.

        Of an entry that goes, versions that it had replaced come back, unless its own
        version was replaced later; the statistics follow.  Each attempt has its own ``dead`` and
        ``terms``, in an entry folder beside the other files.
        """
        old = base.of_batch(new.run_id, new.batches) if new.batches else ()
        others = replace(base, entries=base.without({e.id for e in old}))
        buckets = self._key_buckets(keys)
        replaced = (self._live(FILINGS, others, buckets).join(keys, "accession_number", "left_semi")
                    .select("accession_number", F.col("entry").alias("target"), F.lit(-1).alias("sign")))
        marks = replaced
        if old:
            gone = self._read(FILINGS, old).select("accession_number", "entry")
            killed = self._read(DEAD, others.entries).select("accession_number", F.col("target").alias("entry"))
            later = gone.join(killed, ["accession_number", "entry"], "left_semi")
            still = (self._read(DEAD, old).join(later.select("accession_number"), "accession_number", "left_semi")
                     .select("accession_number", "target", F.lit(-1).alias("sign")))
            back = later.select("accession_number", F.col("entry").alias("target"), F.lit(1).alias("sign"))
            marks = replaced.unionByName(still).unionByName(back).distinct()
        marks = stored(marks, "marks")
        rows = marks.groupBy("sign").count().collect()
        dead = marks.filter("sign < 0").select("accession_number", "target")
        tag = f"{new.id}x{uuid.uuid4().hex[:8]}"                         # this attempt's
        touched = self._key_buckets(marks) if rows else []
        signed = marks.select("accession_number", F.col("target").alias("entry"), "sign")
        on = ["accession_number", "entry"]
        added = self._read(POSTINGS, [new]).groupBy("term").agg(F.sum("n").cast("long").alias("df"))
        chunks, tokens = new.chunks, new.tokens
        if rows:
            self._write(dead, DEAD, tag)
            olds = self._read(CHUNKS, base.entries, touched).join(signed, on)
            changed = keyword.postings_of(olds, ["sign"]).groupBy("term").agg(F.sum("sign").cast("long").alias("df"))
            added = added.unionByName(changed).groupBy("term").agg(F.sum("df").alias("df")).filter("df <> 0")
            less = (self._read(LENGTHS, base.entries, touched).join(signed, on)
                    .agg(F.coalesce(F.sum("sign"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("sign") * F.col("dl")), F.lit(0)).alias("t"))).first()
            chunks, tokens = chunks + less.n, tokens + less.t
        self._write(added, TERMS, tag)
        return replace(others, entries=(*others.entries, self._with(replace(new, chunks=chunks, tokens=tokens), tag, rows)), dim=self.dim)

    def _with(self, entry: Entry, tag: str, rows) -> Entry:
        """The entry with the attempt's tables: they become the entry's by name."""
        for table in (TERMS, DEAD) if rows else (TERMS,):
            here, there = self.log._path(self._path(table, tag)), self.log._path(self._path(table, entry.id))
            self.log.fs.delete(there, True)                              # an earlier attempt's; no manifest names it
            self.log.fs.rename(here, there)
        if not rows:
            self.log.fs.delete(self.log._path(self._path(DEAD, entry.id)), True)
        return self._files(entry, TERMS, DEAD)

    # --- reading -------------------------------------------------------------
    def filing_versions(self) -> DataFrame:
        return self._read(FILINGS, self.snapshot().entries).drop("bucket")

    def chunk_versions(self) -> DataFrame:
        return self._read(CHUNKS, self.snapshot().entries).drop("bucket")

    def _seen(self, but: tuple[str, int] | None) -> Snapshot:
        now = self.snapshot()
        return now if but is None else replace(now, entries=now.without({e.id for e in now.of_batch(but[0], [but[1]])}))

    def filings(self, but: tuple[str, int] | None = None) -> DataFrame:
        """The current ``filings`` view; ``but``: as if that (run_id, batch_id) had not been written."""
        return self._live(FILINGS, self._seen(but)).drop("entry", "bucket")

    def processed(self, keys: DataFrame, but: tuple[str, int] | None = None) -> DataFrame:
        """Which of ``keys`` (accession_number) are stored; their buckets are read, and no other column."""
        found = self._live(FILINGS, self._seen(but), self._key_buckets(keys)).select("accession_number")
        return found.join(keys.select("accession_number"), "accession_number", "left_semi")

    def chunks(self) -> DataFrame:
        """The current ``filing_chunks`` view."""
        return self._live(CHUNKS, self.snapshot()).drop("entry", "bucket")

    def _corpus(self, now: Snapshot) -> tuple[int, float | None]:
        n = sum(e.chunks for e in now.entries)
        return n, sum(e.tokens for e in now.entries) / n if n else None

    def keyword_index(self) -> keyword.KeywordIndex:
        """K9: the index of the current chunks as plain tables; statistics are sums of changes."""
        now = self.snapshot()
        dead = self._dead_in_force(now)
        hit = {r.entry for r in dead.select("entry").distinct().collect()}             # of the snapshot's entries
        of = lambda some: blockmax.postings_in(self._read(POSTINGS, some), "entry")
        whole = of([e for e in now.entries if e.id not in hit])
        postings = whole.unionByName(of([e for e in now.entries if e.id in hit]).join(dead, ["accession_number", "entry"], "left_anti")) if hit else whole
        terms = self._read(TERMS, now.entries).groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
        corpus = self.spark.createDataFrame([self._corpus(now)], "n_chunks long, avgdl double")
        return keyword.KeywordIndex(postings.select("term", *keyword.KEY, "tf", "dl"), terms, corpus, None)

    def search_blocks(self, terms: list[str], now: Snapshot | None = None) -> tuple[DataFrame, dict[str, int]]:
        """The blocks of some terms and the terms' document frequencies: their buckets are listed, no others."""
        now = now or self.snapshot()
        some = self.spark.createDataFrame([(t,) for t in terms], "term string")
        buckets = sorted({r.b for r in some.select(self._bucket(TERMS).alias("b")).collect()})
        df = self._read(TERMS, now.entries, buckets).filter(F.col("term").isin(terms)).groupBy("term").agg(F.sum("df").alias("df")).collect()
        return (self._read(POSTINGS, now.entries, buckets).filter(F.col("term").isin(terms)).drop("bucket"), {r.term: r.df for r in df if r.df > 0})

    def pruned_search(self, query: str, top_k: int = SEARCH_TOP_K, ticker: str | None = None, form: str | None = None,
                      match_all: bool = False, first: int | None = None) -> tuple[DataFrame, blockmax.Pruned | None]:
        """Q1 on the stored index: ``content, rank, accession_number, chunk_index, metadata`` by rank, and what was pruned."""
        now = self.snapshot()
        terms = keyword.query_terms(self.spark, query)
        blocks, df = self.search_blocks(terms, now) if terms else (None, {})
        if not df or (match_all and len(df) < len(terms)):
            return self.spark.createDataFrame([], "content string, rank double, accession_number string, chunk_index int, metadata string"), None
        n, avgdl = self._corpus(now)
        dead = self._read(DEAD, now.entries).select("accession_number", F.col("target").alias("entry"))

        def keep(scored: DataFrame) -> DataFrame:
            scored = scored.join(dead, ["accession_number", "entry"], "left_anti")
            return keyword.apply_filing_filters(scored, self._live(FILINGS, now), ticker, form) if ticker or form else scored

        found = blockmax.pruned_top_k(blocks, df, float(n), float(avgdl), top_k, keep, match_all, first)
        top = stored(found.top, "top")                                   # k rows
        rows = self._read(CHUNKS, now.entries, self._key_buckets(top)).select("entry", *keyword.KEY, "content", "metadata")
        out = rows.join(F.broadcast(top), ["entry", *keyword.KEY]).select("content", "rank", *keyword.KEY, "metadata")
        return out.orderBy(F.round("rank", 6).desc(), *keyword.KEY), found

    def keyword_search(self, query: str, top_k: int = SEARCH_TOP_K, ticker: str | None = None, form: str | None = None,
                       match_all: bool = False) -> DataFrame:
        """Q1 on the stored index, exact, without scoring cells that cannot reach the top k."""
        return self.pruned_search(query, top_k, ticker, form, match_all)[0]

    def index_ready(self) -> bool:
        """A5: exactly the current chunks are indexed (keys compared, not counts)."""
        now, key = self.snapshot(), ["accession_number", "chunk_index"]
        chunks, indexed = self._live(CHUNKS, now).select(*key), self._live(LENGTHS, now).select(*key)
        return chunks.join(indexed, key, "left_anti").isEmpty() and indexed.join(chunks, key, "left_anti").isEmpty()

    # --- maintenance ---------------------------------------------------------
    def truncate(self, table: str) -> None:
        """K5: ``filings`` cascades to the chunks; other names are refused.  Writes that come in between are kept
        or emptied by the order of the manifests."""
        if table not in TRUNCATABLE:
            raise ValueError(f"unsupported table: {table}")
        self.create()
        if table == FILINGS:
            self.log.commit(lambda base: replace(base, entries=()))
            return
        kept = (FILINGS, DEAD)
        self.log.commit(lambda base: replace(base, entries=tuple(
            replace(e, chunks=0, tokens=0, rows=0, buckets={t: b for t, b in e.buckets.items() if t in kept}) for e in base.entries)))

    def truncate_search_index(self) -> None:
        """K6: empties the chunks, their vectors and the keyword index, keeps filings."""
        self.truncate(CHUNKS)

    def _rewrite(self, chosen, chunks=lambda df: df) -> bool:
        """The entries that ``chosen`` picks of a snapshot as one: current versions only, changes summed.

        Versions that others replaced meanwhile are marked dead in the new entry.  False if
        there was nothing to do, or one of the entries went meanwhile.
        """
        base = self.snapshot()
        old = chosen(base)
        if not old:
            return False
        ids = {e.id for e in old}
        new = Entry(f"e{uuid.uuid4().hex}", "merged")
        seen = base.entries
        mine = replace(base, entries=tuple(old))
        dead = self._read(DEAD, seen).select("accession_number", F.col("target").alias("entry"))
        live = lambda t: self._read(t, mine.entries).join(dead, ["accession_number", "entry"], "left_anti")
        self._write(live(FILINGS), FILINGS, new.id)
        self._write(chunks(live(CHUNKS)), CHUNKS, new.id)
        kept = self._read(CHUNKS, [self._files(new, CHUNKS)])
        self._write(live(LENGTHS), LENGTHS, new.id)
        n = live(LENGTHS).count()
        self._write(blockmax.blocks_of(kept, n), POSTINGS, new.id)              # cells are dealt anew, so by chunk
        self._write(self._read(TERMS, old).groupBy("term").agg(F.sum("df").alias("df")).filter("df <> 0"), TERMS, new.id)
        new = self._files(replace(new, rows=n, chunks=sum(e.chunks for e in old), tokens=sum(e.tokens for e in old)),
                          FILINGS, CHUNKS, LENGTHS, POSTINGS, TERMS)
        outside = self._read(DEAD, old).filter(~F.col("target").isin(sorted(ids))).select("accession_number", "target")

        def change(now: Snapshot) -> Snapshot | None:
            if not ids <= now.ids:
                return None
            since = [e for e in now.entries if e.id not in base.ids]
            late = self._read(DEAD, since).filter(F.col("target").isin(sorted(ids))).select("accession_number", F.lit(new.id).alias("target"))
            there = outside.filter(F.col("target").isin(sorted(now.ids - ids)))
            marks = stored(there.unionByName(late), "marks")
            tag = f"{new.id}x{uuid.uuid4().hex[:8]}"
            self._write(marks, DEAD, tag)
            here = self.log._path(self._path(DEAD, new.id))
            self.log.fs.delete(here, True)
            self.log.fs.rename(self.log._path(self._path(DEAD, tag)), here)
            return replace(now, entries=(self._files(new, DEAD), *now.without(ids)), dim=self.dim)
        return self.log.commit(change) is not None

    def merge(self, factor: int = 4) -> bool:
        """One round: ``factor`` entries or more of similar size (powers of ``factor`` chunk rows) become
        one.  The last batch of a run stays as it is, its replay must find it."""

        def chosen(now: Snapshot) -> list[Entry]:
            last: dict[str, str] = {}
            for e in now.entries:
                if e.batches:
                    last[e.run_id] = e.id
            tiers: dict[int, list[Entry]] = {}
            for e in now.entries:
                if e.id not in last.values():
                    tiers.setdefault(int(math.log(max(e.rows, 1), factor)), []).append(e)
            return next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= factor), [])
        return self._rewrite(chosen)

    def compact(self) -> None:
        """Rewrite the current view as one entry, without old versions."""
        self._rewrite(lambda now: list(now.entries))

    def change_dimension(self, dim: int) -> None:
        """K8: stored vectors go (they cannot be converted), chunks stay to be embedded again."""
        self.create()
        self.dim = dim
        empty = lambda df: df.withColumn("embedding", F.lit(None).cast("array<float>"))
        while any(e.rows for e in self.snapshot().entries) and not self._rewrite(lambda now: list(now.entries), empty):
            pass

    def fill_vectors(self, encoder, vectors: VectorCache | None = None) -> int:
        """K8: give every stored chunk its vector by ``encoder``; with a cache only texts are encoded that it
        lacks.  Returns how many chunks have a vector now."""
        self.dim = encoder.dim

        def filled(df: DataFrame) -> DataFrame:
            bare = df.drop("embedding")
            return embed_cached(bare, vectors, "content", encoder)[0] if vectors else embed(bare, "content", encoder)
        while any(e.rows for e in self.snapshot().entries) and not self._rewrite(lambda now: list(now.entries), filled):
            pass
        return self.chunks().filter("embedding IS NOT NULL").count()

    def vacuum(self, older_than_s: float = 86_400.0) -> None:
        """Remove files that the newest manifest does not name and nobody has touched for ``older_than_s``
        seconds (a writer that has not committed yet, a reader of an older snapshot), and older manifests."""
        import time

        now, limit = self.snapshot(), (time.time() - older_than_s) * 1000
        for table in DDL:
            where = self.log._path(self._path(table))
            for s in self.log.fs.listStatus(where) if self.log.fs.exists(where) else []:
                name = s.getPath().getName()
                if name.startswith("entry=") and name[6:] not in now.ids and s.getModificationTime() < limit:
                    self.log.fs.delete(s.getPath(), True)
        self.log.forget(now.version)


def _columns(ddl: str) -> list[str]:
    """The columns of a DDL text, split at commas outside of brackets."""
    out, depth = [""], 0
    for ch in ddl:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return out


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The run id that belongs to a stream's checkpoint: made once, kept in a file beside its
    logs, so a new checkpoint is a new run."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/sheaf-run")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.listStatus(path):
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(path, uuid.uuid4().hex))
    return sorted(s.getPath().getName() for s in fs.listStatus(path))[0]
