"""Filing documents by path (S6, J4): only the wanted files are opened.

``DocumentFiles`` takes the distinct paths that a batch wants, deals them over tasks, and each
task opens just those files.  No folder is listed and no other file is read, however
many documents the store holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PATHS_PER_TASK = 256       # wanted paths of a task, about
BATCH_BYTES = 32 << 20     # of texts that a task holds before it passes them on


def open_file(uri: str) -> bytes | None:
    """The bytes of one file (a plain path, or a URI of a file system that Arrow knows); None if there is none."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    if system.get_file_info(path).type != fs.FileType.File:
        return None
    with system.open_input_stream(path) as stream:
        return stream.read()


@dataclass
class DocumentFiles:
    """Documents in a file system.

    ``prefix`` of a wanted path is replaced by ``folder`` to get its place (events name
    paths as the writer saw them).  ``opener`` reads one place: bytes, or None where
    nothing is; another one reaches stores that Arrow does not know.
    """

    spark: SparkSession
    prefix: str = ""
    folder: str = ""
    opener: Callable[[str], bytes | None] = open_file

    def __post_init__(self):
        sc = self.spark.sparkContext
        self.files_read, self.bytes_read, self.not_found = sc.accumulator(0), sc.accumulator(0), sc.accumulator(0)

    def fetch(self, wanted: DataFrame, path: str = "path") -> DataFrame:
        """(path, html) of the wanted paths that exist; invalid UTF-8 becomes U+FFFD.
        A path that is wanted often is read once; null paths are nobody's."""
        opener, prefix, folder = self.opener, self.prefix, self.folder
        files, size, missing = self.files_read, self.bytes_read, self.not_found

        def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows: list[tuple[str, bytes]] = []
            held = 0
            for f in frames:
                for p in f["path"]:
                    got = opener(folder + p[len(prefix):] if prefix and p.startswith(prefix) else p)
                    if got is None:
                        missing.add(1)
                        continue
                    files.add(1)
                    size.add(len(got))
                    rows.append((p, got))
                    held += len(got)
                    if held >= BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=["path", "content"])
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=["path", "content"])

        paths = wanted.select(F.col(path).cast("string").alias("path")).filter("path IS NOT NULL").distinct()
        dealt = paths.repartition(max(1, -(-paths.count() // PATHS_PER_TASK)), "path")
        found = dealt.mapInPandas(read, "path string, content binary")
        return found.select("path", F.expr("make_valid_utf8(CAST(content AS STRING))").alias("html"))


def wanted_documents(documents, wanted: DataFrame) -> DataFrame:
    """J4's right side: (_path, html) of the ``_path`` values in ``wanted``, one row each.

    ``documents`` is a ``DocumentFiles``, whose files are opened by path, or a table (path, html)
    that is joined; its paths are normalised."""
    from sheaf.functions.paths import normalize_path

    if isinstance(documents, DocumentFiles):
        return documents.fetch(wanted, "_path").withColumnRenamed("path", "_path")
    return (documents.select(normalize_path("path").alias("_path"), "html").join(wanted, "_path", "left_semi")
            .groupBy("_path").agg(F.min("html").alias("html")))


def write_documents(documents: DataFrame, prefix: str, folder: str) -> int:
    """Put (path, html) rows into files below ``folder``, ``prefix`` of a path replaced by it; each
    task writes its own files.  Returns how many."""

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        n = 0
        for f in frames:
            for p, html in zip(f["path"], f["html"], strict=True):
                uri = folder + p[len(prefix):]
                system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(path) as stream:
                    stream.write((html or "").encode("utf-8", "surrogatepass"))
                n += 1
        yield pd.DataFrame({"n": [n]})

    rows = documents.filter(F.startswith("path", F.lit(prefix))).select("path", "html").mapInPandas(put, "n long")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
