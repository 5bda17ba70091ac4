"""Token ids of a corpus in flat binary files, read back by memory map.

Format, one folder: ``part-NNNNN.ids`` holds unsigned little-endian token ids (16
bits if the vocabulary fits, else 32), documents in ascending doc_id order, each
ended by ``END``; ``part-NNNNN.offsets`` holds the documents' starts in the whole
corpus as unsigned 64-bit integers and one more, the end; ``part-NNNNN.docs`` the
doc_ids as signed 64-bit integers with one byte each that is 1 for a null id.
Part numbers follow doc_id order.

Writing: one range shuffle by doc_id; each task tokenizes, writes its ids and
documents' lengths, and returns one row of counts.  The parts' bases are prefix
sums of those counts; a second, small pass writes the offsets.  Files are written
under an attempt's own name and renamed, so a repeated task replaces its file by
the same bytes.
"""

from __future__ import annotations

import os
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.llm.common import scratch, settle, small_batches

END = 2
#: Distinct pieces whose ids a process remembers.
MEMORY = 1_300_000
PLAIN = re.compile(r" ?\S+")
#: Before a space between two characters that are not white space.
CUT = re.compile(r"(?<=\S)(?= \S)")


class Encoder:
    """``encode(texts)`` -> their ids as bytes of ``dtype``, without an end id.

    The byte-level BPE's pattern never joins what stands on the two sides of a
    single space or line feed between two characters that are not white space (a
    space belongs to what follows, a line feed is a token), nor a letter and the
    full stops and commas after it.  Texts are cut there, and each distinct piece
    is encoded by the library once and remembered, across the tasks of a process.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.known: dict[str, bytes] = {}

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        kind = self.dtype.char
        return [array(kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def learn(self, pieces: set[str]) -> set[str]:
        """Remember the ids of plain pieces: a line feed, or at most one space and then
        characters that are not white space.  Returns the others."""
        if len(self.known) + len(pieces) > MEMORY:
            for late in list(islice(self.known, len(self.known) * 4 // 5, None)):      # the frequent ones came early
                del self.known[late]
        new = pieces.difference(self.known)
        odd = {p for p in new if p != "\n" and not PLAIN.fullmatch(p)}
        new -= odd
        ends = {p: p.rstrip(".,") for p in new if p[-1] in ".,"}
        ends = {p: head for p, head in ends.items() if head and head[-1].isalpha()}
        own = list((new - ends.keys() | set(ends.values()) | {p[len(h):] for p, h in ends.items()}).difference(self.known))
        self.known.update(zip(own, self.ids_of(own), strict=True))
        for p, head in ends.items():
            self.known[p] = self.known[head] + self.known[p[len(head):]]
        return odd

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") for t in texts]
        odd = self.learn(set().union(*cut))
        nul = any("\0" in t for t in texts)
        if not odd and not nul:
            return [b"".join(map(self.known.__getitem__, p)) for p in cut]
        # texts with other white space are cut at plain spaces only
        return [b"".join(self.ids_of([p for p in CUT.split(t) if p])) if "\0" in t or not odd.isdisjoint(p)
                else b"".join(map(self.known.__getitem__, p)) for t, p in zip(texts, cut, strict=True)]


@cache
def encoder_of(path: str) -> Encoder:
    """One encoder per process."""
    return Encoder(path)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


class Flat:
    """A file of one number type: a memory map if local, ranged reads elsewhere."""

    def __init__(self, uri: str, dtype):
        fs, path = filesystem(uri)
        self.dtype = np.dtype(dtype)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.file = pa.memory_map(path) if local else fs.open_input_file(path)

    def __getitem__(self, part: slice) -> np.ndarray:
        size = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((part.stop - part.start) * size, part.start * size), self.dtype)


def publish(uri: str, chunks) -> None:
    """Write a file under an own name, then rename it."""
    fs, path = filesystem(uri)
    own = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as f:
        for chunk in chunks:
            f.write(chunk)
    fs.move(own, path)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end: int = END) -> DataFrame:
    """Write ``docs`` (doc_id, text) to ``folder``; one row per part: part, docs,
    tokens, base (ids in the parts before it), item (bytes of an id).

    Null and empty texts are their end id alone.  Null doc_ids come first; rows of one
    doc_id stand in the order of their text's hash, equal rows in any.  An empty table
    writes no part.  Extra columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder, lengths, ids = TaskContext.get().partitionId(), encoder_of(tokenizer_path), [], []
        last = np.array([end], encoder.dtype).tobytes()
        item = encoder.dtype.itemsize

        def encoded():
            for batch in batches:
                ids.append(batch.column(0))
                for k in range(0, batch.num_rows, 200):
                    found = encoder.encode(batch.column(1)[k:k + 200].to_pylist())
                    lengths.extend(len(data) // item + 1 for data in found)
                    yield last.join([*found, b""])

        name = f"{folder}/part-{part:05d}"
        publish(f"{name}.ids", encoded())
        doc_id = pa.chunked_array(ids, pa.int64())
        publish(f"{name}.docs", [doc_id.fill_null(0).to_numpy().astype("<i8").tobytes(), doc_id.is_null().to_numpy().astype(np.uint8).tobytes()])
        publish(f"{name}.lengths", [np.array(lengths, "<u8").tobytes()])
        yield pa.RecordBatch.from_pydict({"part": [part], "docs": [len(lengths)], "tokens": [sum(lengths)], "item": [item]},
                                         schema=pa.schema([("part", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("item", pa.int32())]))

    parts = settle(rows.mapInArrow(write, "part int, docs long, tokens long, item int"), "parts").filter("docs > 0")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)           # one row per part
    parts = parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def rebase(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                name = f"{folder}/part-{r.part:05d}"
                lengths = Flat(f"{name}.lengths", "<u8")[0:r.docs]
                publish(f"{name}.offsets", [np.cumsum(np.r_[np.uint64(r.base), lengths], dtype="<u8").tobytes()])
            yield f

    return settle(parts.repartition(n, "part").mapInPandas(rebase, parts.schema), "manifest")


def read_token_files(parts: DataFrame, folder: str, docs_at_once: int = 5000) -> DataFrame:
    """The manifest of ``write_token_files`` -> doc_id, start, n_tokens, ids (binary,
    unsigned little-endian 32-bit), read from the files."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                name = f"{folder}/part-{r.part:05d}"
                ids, offsets = Flat(f"{name}.ids", f"<u{r.item}"), Flat(f"{name}.offsets", "<u8")
                doc_ids, nulls = Flat(f"{name}.docs", "<i8"), Flat(f"{name}.docs", np.uint8)
                for a in range(0, r.docs, docs_at_once):
                    b = min(r.docs, a + docs_at_once)
                    at = offsets[a:b + 1].astype(np.int64)
                    words = ids[at[0] - r.base:at[-1] - r.base].astype("<u4")
                    cut = at - at[0]
                    gone = nulls[8 * r.docs + a:8 * r.docs + b].astype(bool)
                    yield pd.DataFrame({"doc_id": pd.Series(doc_ids[a:b]).astype("Int64").mask(gone), "start": at[:-1], "n_tokens": np.diff(at),
                                        "ids": [words[cut[k]:cut[k + 1]].tobytes() for k in range(b - a)]})

    return parts.repartition(n, "part").mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary")


def token_folder(spark: SparkSession) -> str:
    return scratch(spark, "tokens")
