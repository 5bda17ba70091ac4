"""Text from filing HTML (X1-X9, W5), one map-only step.

Each page is walked by ``functions.htmltext`` in the task that reads it: Arrow batches in, text
runs out, each with its table, row, cell and block.  Array expressions put the runs together.
No shuffle, no window and no join; a page is bounded by its file.

Rules (the original's parser behaviour, restated):

* script/style elements are removed with their content;
* a ``div``/``span`` whose style says ``display: none`` is removed with its subtree;
  unclosed, it ends with the element around it; ``ix:*`` tags are dropped, their text kept;
* tables come first: per row the non-empty cells joined by " | ", rows joined
  by newlines; table text never appears again in blocks;
* blocks are ``p``, ``h1``-``h4``, ``li``: their text runs, each stripped,
  joined by one space; nested blocks and tables give their text once, at the
  innermost element, and the outer one goes on after them;
* when neither gives text, all body text runs joined by newlines;
* every piece goes through X8 (references decoded a second time, NBSP to space,
  runs of blanks squeezed, stripped); pieces are joined by a blank line;
* a page that starts with ``<?xml`` is read as XML: ``/>`` closes any element,
  CDATA is text, nothing is closed by rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.htmltext import page_runs
from sheaf.functions.text import py_strip_sql, sql_literal

#: A text run: its table, row and cell, its block, whether it is inside a table, its text.
RUN = T.StructType([*(T.StructField(c, T.IntegerType()) for c in ("tab", "row", "cell", "block")), T.StructField("inside", T.BooleanType()),
                    T.StructField("text", T.StringType())])
#: Characters that are no text in any document stand between cells, rows and groups; in a run they are replaced.
CELL_END, ROW_END, GROUP_END = "\ufdd0", "\ufdd1", "\ufdd2"
BYTES_AT_ONCE = 1 << 20    # of pages whose runs are Python objects together
PAGES_AT_ONCE = 500        # of an Arrow batch, which is whole in Python


@F.arrow_udf(T.ArrayType(RUN))
def html_runs(pages: pa.Array) -> pa.Array:
    """The visible text runs of each page."""
    return runs_of(pages)


def runs_of(pages: pa.Array, at_once: int = BYTES_AT_ONCE) -> pa.Array:
    """A batch of pages -> their runs.  As Python objects there are only those of pages of ``at_once``
    bytes (or of one larger page); they become Arrow columns before the next are walked."""
    kinds, parts, k = [pa.int32()] * 4 + [pa.bool_(), pa.string()], [], 0
    ends = np.cumsum(pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    while k < len(pages) or not parts:
        done = ends[k - 1] if k else 0
        n = max(1, int(np.searchsorted(ends, done + at_once, side="right")) - k)
        found = [page_runs(h.as_py()) for h in pages.slice(k, n)]
        stops = np.cumsum([0, *map(len, found)], dtype=np.int32)
        columns = list(zip(*(r for runs in found for r in runs), strict=True)) or [()] * 6
        fields = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        parts.append(pa.ListArray.from_arrays(pa.array(stops), pa.StructArray.from_arrays(fields, RUN.names)))
        k += n
    return pa.concat_arrays(parts)


def _tidy(x: str) -> str:
    """X8 of a text whose references are decoded: NBSP to space, blanks squeezed, stripped."""
    return py_strip_sql(f"regexp_replace(translate({x}, {sql_literal(chr(160))}, ' '), {sql_literal('[ ' + chr(9) + ']+')}, ' ')")


def _groups(order: str, between: str) -> str:
    """The runs of ``rs`` sorted by the fields ``order`` as one text: ``between`` says what stands between a run and the
    one before (``x`` and ``y``).  A sort, a pass and a join, so time grows with the page."""
    fields = ", ".join(f"'{f}', x.{f}" for f in order.split())
    clean = f"translate(x.text, {sql_literal(CELL_END + ROW_END + GROUP_END)}, {sql_literal(chr(0xFFFD) * 3)})"
    return (f"transform(array(array_sort(transform(rs, (x, i) -> named_struct({fields}, 'i', i, 'text', {clean})))), s -> "
            f"array_join(transform(s, (x, i) -> transform(array(get(s, i - 1)), y -> concat(IF(i = 0, '', {between}), x.text))[0]), ''))[0]")


def _named(kept: str, of: str, no: str, text: str) -> str:
    """array<struct<no, text>> of the groups that have text."""
    cut, none = f"split({of}, {sql_literal(GROUP_END)}, -1)", "CAST(array() AS array<struct<no: int, text: string>>)"
    made = f"transform({cut}, g -> {text})"
    return (f"transform(array({kept}), rs -> IF(size(rs) = 0, {none}, filter(zip_with(array_sort(array_distinct("
            f"transform(rs, x -> x.{no}))), {made}, (n, t) -> named_struct('no', n, 'text', t)), z -> z.text <> '')))[0]")


def tables_sql(runs: str) -> str:
    """(table, text) of the tables with text: non-empty cells joined by " | ", non-empty rows by newlines."""
    between = (f"CASE WHEN x.tab <> y.tab THEN {sql_literal(GROUP_END)} WHEN x.row <> y.row THEN {sql_literal(ROW_END)} "
               f"WHEN x.cell <> y.cell THEN {sql_literal(CELL_END)} ELSE ' ' END")
    cells = f"filter(transform(split(w, {sql_literal(CELL_END)}, -1), c -> {_tidy('c')}), c -> c <> '')"
    rows = f"filter(transform(split(g, {sql_literal(ROW_END)}, -1), w -> array_join({cells}, ' | ')), w -> w <> '')"
    return _named(f"filter({runs}, x -> x.cell IS NOT NULL)", _groups("tab row cell", between), "tab", f"array_join({rows}, {sql_literal(chr(10))})")


def blocks_sql(runs: str) -> str:
    """(block, text) of the blocks with text: their runs joined by one space."""
    between = f"IF(x.block <> y.block, {sql_literal(GROUP_END)}, ' ')"
    return _named(f"filter({runs}, x -> x.block IS NOT NULL AND NOT x.inside)", _groups("block", between), "block", _tidy("g"))


def text_sql(runs: str) -> str:
    """Tables, then blocks, a blank line between; without either the body's runs outside tables, by newlines."""
    body = _tidy(f"array_join(transform(filter({runs}, x -> NOT x.inside), x -> x.text), {sql_literal(chr(10))})")
    parts = f"transform(concat({tables_sql(runs)}, {blocks_sql(runs)}), p -> p.text)"
    return f"transform(array({parts}), ps -> IF(size(ps) > 0, array_join(ps, {sql_literal(chr(10) * 2)}), {body}))[0]"


def _with_runs(docs: DataFrame, html_col: str, keep: list[str]) -> DataFrame:
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= PAGES_AT_ONCE:
        conf.set(name, str(PAGES_AT_ONCE))                       # Spark bounds a batch's bytes beside
    return docs.select(*keep, html_runs(F.coalesce(html_col, F.lit(""))).alias("_runs"))


def extract_text(docs: DataFrame, key: str = "accession_number", html_col: str = "html") -> DataFrame:
    """``key, other columns..., text`` for every input row ('' when
    nothing is found, or the page is null); the html column is dropped."""
    keep = [c for c in docs.columns if c not in (key, html_col, "text")]
    return _with_runs(docs, html_col, [key, *keep]).select(key, *keep, F.expr(text_sql("_runs")).alias("text"))


def _parts(docs: DataFrame, key: str, html_col: str, part: str, no: str) -> DataFrame:
    found = _with_runs(docs, html_col, [key]).select(key, F.explode_outer(F.expr(part)).alias("_u")).filter("_u IS NOT NULL")
    return found.select(key, F.col("_u.no").alias(no), F.col("_u.text").alias("text"))


def extract_blocks(docs: DataFrame, key: str = "accession_number", html_col: str = "html") -> DataFrame:
    """X6 alone: ``key, block_no, text`` of every non-empty block."""
    return _parts(docs, key, html_col, blocks_sql("_runs"), "block_no")


def extract_tables(docs: DataFrame, key: str = "accession_number", html_col: str = "html") -> DataFrame:
    """X5 alone: ``key, table_no, text`` of every non-empty table."""
    return _parts(docs, key, html_col, tables_sql("_runs"), "table_no")
