"""Partitioning helpers, and tables that several results start from."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sheaf.session import ensure_checkpoint_dir

_scope = threading.local()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back, so several
    results can start from it (``checkpoint()`` would compute it twice).  It stays until the
    ``scratch_scope`` around it ends, or until the folder is cleared."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheaf-{name}-{uuid.uuid4().hex}"
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``stored`` inside (by this thread) are deleted at the end: a micro-batch leaves none."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition only when the scan yields fewer partitions than task slots
    (one-row-group files); a large input keeps its file splits, no shuffle."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, *keys)
