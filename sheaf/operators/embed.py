"""Chunk embedding.

* ``HashingEncoder`` - the built-in encoder: feature hashing of the keyword
  tokens (``HashingTF``, JVM side) then L2 normalisation.  No model files or
  network are needed, and it runs inside whole-stage code paths.
* ``BatchEncoder`` - wraps a user ``encode(list[str]) -> list[list[float]]``
  (a local model, a remote service); texts go through ``mapInPandas`` in
  batches of ``batch_size``, the encoder is built once per task, a batch that fails is
  tried again after a pause if asked to, and one whose vector count differs from its text count fails.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.config import EMBED_BATCH_SIZE, EMBED_MAX_SEQ_LENGTH, VECTOR_DIM
from sheaf.functions.text import tokens
from sheaf.functions.vector import l2_normalize


@dataclass(frozen=True)
class HashingEncoder:
    dim: int = VECTOR_DIM
    name: str = "hashing"


@dataclass
class BatchEncoder:
    factory: Callable[[], Callable[[list[str]], list[list[float]]]]
    dim: int
    batch_size: int = EMBED_BATCH_SIZE
    query_prefix: str | None = None      # E3: e.g. the model's "query" prompt
    name: str = "batch"
    max_seq_length: int = EMBED_MAX_SEQ_LENGTH
    retries: int = 0                     # further tries of a batch that failed
    backoff_s: float = 0.5               # before the first of them, doubled before each next one

    def __post_init__(self):
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        if self.retries < 0:
            raise ValueError("retries must not be negative")


ENCODERS: dict[str, Callable[..., object]] = {
    "hashing": HashingEncoder,
    "batch": BatchEncoder,
}


def get_encoder(name: str, **kwargs):
    """Encoder by name; unknown names are an error."""
    try:
        return ENCODERS[name](**kwargs)
    except KeyError:
        raise ValueError(f"unsupported embedding backend: {name}") from None


def _hashing(df: DataFrame, text_col: str, enc: HashingEncoder, out_col: str) -> DataFrame:
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    tmp = df.withColumn("_toks", tokens(text_col))
    tf = HashingTF(inputCol="_toks", outputCol="_tf", numFeatures=enc.dim).transform(tmp)
    arr = F.transform(vector_to_array("_tf", "float32"), lambda x: x.cast("float"))
    return tf.withColumn(out_col, l2_normalize(arr)).drop("_toks", "_tf")


def _make(enc: BatchEncoder):
    """The task's encoder; a factory that takes ``max_seq_length`` gets the limit."""
    import inspect

    takes = "max_seq_length" in inspect.signature(enc.factory).parameters
    return enc.factory(max_seq_length=enc.max_seq_length) if takes else enc.factory()


def _unit(v, dim: int) -> list[float]:
    if len(v) != dim:
        raise RuntimeError(f"vector length {len(v)}, expected {dim}")
    x = np.asarray(v, dtype=float)
    size = float(np.linalg.norm(x))
    return (x / size if size else x).tolist()


def _batched(df: DataFrame, text_col: str, enc: BatchEncoder, out_col: str, prefix: str | None, error_col: str | None) -> DataFrame:
    from pyspark.sql import types as T

    more = [T.StructField(out_col, T.ArrayType(T.FloatType()))] + ([T.StructField(error_col, T.StringType())] if error_col else [])
    schema = T.StructType(df.schema.fields + more)

    def vectors(encode, part: list[str]) -> list[list[float]]:
        for left in range(enc.retries, -1, -1):
            try:
                got = encode(part)
                if len(got) != len(part):
                    raise RuntimeError(f"encoder returned {len(got)} vectors for {len(part)} texts")
                return [_unit(v, enc.dim) for v in got]
            except Exception:
                if not left:
                    raise
                time.sleep(enc.backoff_s * 2 ** (enc.retries - left))
        raise AssertionError

    def one(encode, text: str) -> tuple[list[float] | None, str | None]:
        try:
            return vectors(encode, [text])[0], None
        except Exception as e:  # noqa: BLE001  whatever the user's encoder raises is the filing's outcome
            return None, str(e)

    def run(batches):
        encode = _make(enc)                      # once per task
        for pdf in batches:
            texts = [(prefix or "") + t for t in pdf[text_col].fillna("")]
            found: list[tuple[list[float] | None, str | None]] = []
            for i in range(0, len(texts), enc.batch_size):
                part = texts[i:i + enc.batch_size]
                try:
                    found += [(v, None) for v in vectors(encode, part)]
                except Exception:
                    if not error_col:
                        raise
                    found += [one(encode, t) for t in part]      # which of the batch it was
            out = pdf.assign(**{out_col: pd.Series([v for v, _ in found], dtype=object, index=pdf.index)})
            yield out.assign(**{error_col: pd.Series([e for _, e in found], dtype=object, index=pdf.index)}) if error_col else out

    return df.mapInPandas(run, schema)


def embed(df: DataFrame, text_col: str = "content", encoder=None, out_col: str = "embedding",
          kind: str = "document", error_col: str | None = None) -> DataFrame:
    """Add ``out_col`` (unit vectors, order kept).  With ``error_col`` a text that
    cannot be encoded gets a null vector and the message there; without, the job fails."""
    enc = encoder or HashingEncoder()
    if isinstance(enc, HashingEncoder):
        out = _hashing(df, text_col, enc, out_col)
        return out.withColumn(error_col, F.lit(None).cast("string")) if error_col else out
    if isinstance(enc, BatchEncoder):
        return _batched(df, text_col, enc, out_col, enc.query_prefix if kind == "query" else None, error_col)
    raise ValueError(f"unsupported encoder: {enc!r}")


def encode_query(spark: SparkSession, text: str, encoder=None) -> list[float]:
    """One query through the same encoder (query prompt where it has one)."""
    one = spark.createDataFrame([(text,)], "q string")
    return list(embed(one, "q", encoder, "v", kind="query").first().v)
