"""Metadata containment (P14): does a JSON document hold another one?

As in a containment index: an object holds another if each of its keys is there and the
value holds the wanted one; an array holds another if each wanted element is held by one of its
elements, in any order and number; scalars are equal.  An array that stands alone also holds a wanted scalar.
The wanted document is a request argument, so it becomes one column expression over ``variant``.
``leaves`` is the inverted table (path, value) for a search over many documents.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTAINERS = "^(OBJECT|ARRAY)"
DEPTH = 6                  # levels of nested containers that ``leaves`` follows


def _member(v: Column, key: str) -> Column:
    if key and "'" not in key:
        return F.try_variant_get(v, f"$['{key}']", "variant")
    return F.try_variant_get(v, "$", "map<string,variant>").getItem(key)      # a path cannot name it


def _holder(wanted):
    return lambda v: _holds(v, wanted)


def _holds(v: Column, wanted) -> Column:
    kind = F.schema_of_variant(v)
    if isinstance(wanted, dict):
        parts = [F.startswith(kind, F.lit("OBJECT"))]
        for key, value in wanted.items():
            parts.append(_holds(_member(v, key), value))
    elif isinstance(wanted, list):
        items = F.try_variant_get(v, "$", "array<variant>")
        parts = [F.startswith(kind, F.lit("ARRAY"))]
        parts += [F.exists(items, _holder(value)) for value in wanted]
    elif wanted is None:
        parts = [kind == "VOID"]
    elif isinstance(wanted, bool):
        parts = [kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean") == F.lit(wanted)]
    elif isinstance(wanted, (int, float)):
        parts = [F.rlike(kind, F.lit("^(BIGINT|DOUBLE|DECIMAL)")), F.try_variant_get(v, "$", "double") == F.lit(float(wanted))]
    else:
        parts = [kind == "STRING", F.try_variant_get(v, "$", "string") == F.lit(wanted)]
    return reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in parts])


def holds(col: Column | str, wanted: str | dict | list) -> Column:
    """True where the JSON text in ``col`` holds ``wanted`` (JSON text, or the parsed document); a
    null or malformed text holds nothing."""
    doc = json.loads(wanted) if isinstance(wanted, str) else wanted
    v = F.try_parse_json(F.col(col) if isinstance(col, str) else col)
    out = _holds(v, doc)
    if not isinstance(doc, (dict, list)):
        out = out | _holds(v, [doc])
    return F.coalesce(out, F.lit(False))


def _leaves_of(doc, path: str = "") -> list[tuple[str, str]]:
    if isinstance(doc, dict):
        return [x for k, v in doc.items() for x in _leaves_of(v, f"{path}.{k}")]
    if isinstance(doc, list):
        return [x for v in doc for x in _leaves_of(v, f"{path}[]")]
    return [(path, json.dumps(doc, ensure_ascii=False))] if isinstance(doc, str) else []


def leaves(df: DataFrame, col: str, keys: list[str], depth: int = DEPTH) -> DataFrame:
    """(keys, path, value), distinct: the text leaves of each document, array places left out of the path.
    Containers nested deeper than ``depth`` have none; a search verifies anyway."""
    spark = df.sparkSession
    level = df.select(*keys, F.lit("").alias("path"), F.try_parse_json(col).alias("v")).filter("v IS NOT NULL")
    out = None
    for _ in range(depth + 1):
        here = level.filter(F.schema_of_variant("v") == "STRING").select(*keys, "path", F.to_json("v").alias("value"))
        out = here if out is None else out.unionByName(here)
        inner = level.filter(F.rlike(F.schema_of_variant("v"), F.lit(CONTAINERS))).withColumnsRenamed({"v": "doc", "path": "above"})
        exploded = inner.lateralJoin(spark.tvf.variant_explode(F.col("doc").outer()))
        step = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(F.concat(F.lit("."), "key"))
        level = exploded.select(*keys, F.concat("above", step).alias("path"), F.col("value").alias("v"))
    return out.distinct()


def search_leaves(table: DataFrame, documents: DataFrame, col: str, keys: list[str], wanted: str | dict | list) -> DataFrame:
    """The rows of ``documents`` that hold ``wanted``: the inverted table gives the documents with all its
    text leaves, and only those are parsed.  Without a text leaf every document is."""
    doc = json.loads(wanted) if isinstance(wanted, str) else wanted
    asked = sorted(set(_leaves_of(doc)))
    if isinstance(doc, (dict, list)) and asked:
        match = reduce(lambda a, b: a | b, [(F.col("path") == p) & (F.col("value") == v) for p, v in asked])
        found = table.filter(match).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(asked))
        documents = documents.join(found.select(*keys), keys, "left_semi")
    return documents.filter(holds(col, doc))
