"""Filing paths."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_path(col: Column | str) -> Column:
    """Absolute path with "." and ".." segments folded (symlinks are not
    resolved: the executors may not see the files; relative paths are taken
    from the root)."""
    c = F.col(col) if isinstance(col, str) else col
    segs = F.split(F.regexp_replace(c, "^file:", ""), "/")
    folded = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when(s.isin("", "."), acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))))
    return F.concat(F.lit("/"), F.array_join(folded, "/"))


def normalize_base(base: str) -> str:
    return posixpath.normpath("/" + base.lstrip("/")) if not base.startswith("/") else posixpath.normpath(base)


def inside(path: Column, base: str) -> Column:
    """The normalised path lies under ``base``."""
    b = normalize_base(base)
    prefix = b if b.endswith("/") else b + "/"
    return (path == F.lit(b)) | path.startswith(prefix)
