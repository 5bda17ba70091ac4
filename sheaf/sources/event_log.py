"""An append-only event log as a Spark source (S1, R2): partitions, offsets, segments.

Layout of a log::

    <folder>/<partition>/<first offset>-<number of events>.jsonl

A segment holds one event per line and never changes, so a listing alone tells every
partition's end.  ``spark.readStream.format("event_log")`` reads it like a topic: rows (partition,
offset, value), offsets committed in the query's checkpoint.  ``startingOffsets`` holds for a new checkpoint:
``earliest`` begins at 0, ``latest`` after what is there; a checkpoint goes on where it stopped
(``committed``).  ``spark.read`` gives all that is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

START_POSITIONS = ("earliest", "latest", "committed")
SHARE = 50_000             # events that a task reads, at most
BATCH = 5_000              # events of an Arrow batch
SCHEMA = "partition int, offset long, value string"


def _system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def segments(folder: str) -> dict[int, list[tuple[int, int, str]]]:
    """Per partition its segments (first offset, events, path) in order; drafts are not seen."""
    from pyarrow import fs

    system, path = _system(folder)
    found: dict[int, list[tuple[int, int, str]]] = {}
    for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=True)):
        name = info.base_name
        if info.type == fs.FileType.File and name.endswith(".jsonl") and not name.startswith("."):
            first, count = name.removesuffix(".jsonl").split("-")
            found.setdefault(int(info.path.rsplit("/", 2)[1]), []).append((int(first), int(count), info.path))
    return {p: sorted(s) for p, s in sorted(found.items())}


def append(folder: str, values: list[str], partition: int = 0) -> int:
    """Add events to a partition; a log partition has one writer.  Returns the first one's offset."""
    if any("\n" in v for v in values):
        raise ValueError("an event is one line")
    system, path = _system(folder)
    mine = segments(folder).get(partition, [])
    first = mine[-1][0] + mine[-1][1] if mine else 0
    if values:
        where = f"{path}/{partition}"
        system.create_dir(where, recursive=True)
        draft = f"{where}/.{uuid.uuid4().hex}.jsonl"
        with system.open_output_stream(draft) as out:
            out.write("".join(v + "\n" for v in values).encode())
        system.move(draft, f"{where}/{first:020d}-{len(values)}.jsonl")
    return first


@dataclass
class Stretch(InputPartition):
    """Events of one segment from ``start`` to before ``stop``."""

    partition: int
    first: int
    path: str
    start: int
    stop: int


def stretches(folder: str, start: dict[int, int], stop: dict[int, int]) -> list[Stretch]:
    out = []
    for p, mine in segments(folder).items():
        lo, hi = start.get(p, 0), stop.get(p, 0)
        for first, count, path in mine:
            for a in range(max(lo, first), min(hi, first + count), SHARE):
                out.append(Stretch(p, first, path, a, min(a + SHARE, hi, first + count)))
    return out


def read_stretch(folder: str, s: Stretch | None) -> Iterator[pa.RecordBatch]:
    if s is None:                                       # Spark asks once where there is nothing to read
        return
    system, _ = _system(folder)
    with system.open_input_stream(s.path) as stream:
        offset, rest, held = s.first, b"", []
        while offset < s.stop:
            data = stream.read(1 << 20)
            if not data:
                break
            *lines, rest = (rest + data).split(b"\n")
            for line in lines:
                if s.start <= offset < s.stop:
                    held.append((offset, line.decode("utf-8", "replace")))
                    if len(held) == BATCH:
                        yield _batch(s.partition, held)
                        held = []
                offset += 1
        if held:
            yield _batch(s.partition, held)


def _batch(partition: int, rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([partition] * len(rows), pa.int32()), pa.array([o for o, _ in rows], pa.int64()),
                                       pa.array([v for _, v in rows], pa.string())], ["partition", "offset", "value"])


def ends(folder: str) -> dict[int, int]:
    return {p: s[-1][0] + s[-1][1] for p, s in segments(folder).items()}


class _StreamReader(DataSourceStreamReader):
    """Offsets are {partition: next offset}; JSON makes the keys texts."""

    def __init__(self, folder: str, start: str):
        self.folder, self.start = folder, start

    def initialOffset(self) -> dict:
        return {str(p): end if self.start == "latest" else 0 for p, end in ends(self.folder).items()}

    def latestOffset(self) -> dict:
        return {str(p): end for p, end in ends(self.folder).items()}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return stretches(self.folder, {int(p): o for p, o in start.items()}, {int(p): o for p, o in end.items()})

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return read_stretch(self.folder, partition)

    def commit(self, end: dict) -> None:
        """The checkpoint holds what is committed; the log keeps everything."""


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Stretch]:
        return stretches(self.folder, {}, ends(self.folder))

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return read_stretch(self.folder, partition)


class EventLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "event_log"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> tuple[str, str]:
        start = self.options.get("startingOffsets", "earliest")
        if start not in START_POSITIONS:
            raise ValueError(f"unsupported offset mode: {start}")
        return self.options["path"], start

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self._options()[0])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(*self._options())


def _numbered(raw: DataFrame) -> DataFrame:
    order = F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")
    return raw.select("value", order.alias("event_no"))


def log_events(spark: SparkSession, folder: str, start: str = "committed") -> DataFrame:
    """S1 + R2: a log as a stream of (value, event_no).  ``committed`` goes on from the query's checkpoint, a new one begins at 0."""
    if start not in START_POSITIONS:
        raise ValueError(f"unsupported offset mode: {start}")
    spark.dataSource.register(EventLogSource)
    return _numbered(spark.readStream.format("event_log").option("path", folder).option("startingOffsets", start).load())


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """All events of a log: (partition, offset, value)."""
    spark.dataSource.register(EventLogSource)
    return spark.read.format("event_log").option("path", folder).load()
