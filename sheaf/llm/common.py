"""Helpers that the operators of this subpackage share.

``settle`` writes a table into the shared folder that ``spark.checkpoint.dir``
names and reads it back: lineage is cut, a lost executor costs only a re-read,
and nothing lands on a machine-local disk.  (``DataFrame.checkpoint`` computes
its input twice, once to run it and once to write it.)
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sheaf.session import ensure_checkpoint_dir

#: Rows and bytes of one Arrow batch, so that whole texts stay small in Python.
ARROW_ROWS = 2000
ARROW_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` reduced to the needed columns, cast to their types: ``pick(df,
    doc_id="long", text="string")``.  Other columns, whatever their names, go."""
    return df.select(*[df[c].cast(kind).alias(c) for c, kind in columns.items()])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheaf-{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that carry whole texts (session settings)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def width(spark: SparkSession, rows: int, rows_per_task: int = 500_000) -> int:
    """Partitions for ``rows`` rows: at least the session's shuffle width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def running_totals(df: DataFrame, group: str, order: Sequence[str], value: str, out: str = "before",
                   name: str = "totals") -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of the same
    ``group`` (a non-null integer column) that come before the row in ``order``.

    One range shuffle on (group, order) splits any hot group over many tasks; each
    task sums its sorted rows, and the tasks' bases are prefix sums over one row
    per (group, task).  ``value`` is a non-null integer column.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType()),
                           T.StructField("_local", T.LongType()), T.StructField("_row", T.LongType())])

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid, last, total, row = TaskContext.get().partitionId(), None, 0, 0
        for f in frames:
            if not len(f):
                continue
            g, v = f[group].to_numpy(), f[value].to_numpy().astype(np.int64)
            first = np.r_[True, g[1:] != g[:-1]]
            before = np.cumsum(v) - v
            starts = np.flatnonzero(first)
            base = -before[starts]
            if g[0] == last:
                base[0] += total
            before = before + np.repeat(base, np.diff(np.r_[starts, len(f)]))
            last, total = g[-1], int(before[-1] + v[-1])
            yield f.assign(_pid=np.int32(pid), _local=before, _row=np.arange(row, row + len(f)))
            row += len(f)

    keys = [F.col(group), *[F.col(c) for c in order]]
    local = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).mapInPandas(sums, schema)
    local = settle(local, name)
    bases = local.groupBy(group, "_pid").agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = bases.select(group, "_pid", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_base"))
    return (local.join(bases, [group, "_pid"])
            .withColumn(out, F.col("_base") + F.col("_local"))
            .select(*df.columns, out))
