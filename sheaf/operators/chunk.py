"""Sections and overlapping chunks.

The whole split runs inside one row per document with Spark's higher-order
functions, so chunking is a narrow (map-only) stage: no shuffle, no window,
and the chunk number comes out of ``posexplode_outer`` (the plain one makes the optimizer
filter by the array's size first, and cut every text twice).  A document is the unit of
work here because its split is sequential by definition (each window's end
decides where the next one starts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.config import CHUNK_OVERLAP, CHUNK_SIZE
from sheaf.functions.text import PY_WHITESPACE, py_strip_sql, sql_literal


def _ws_class() -> str:
    """Python's whitespace set as a Java regex character class."""
    return "[" + "".join("\\x{%x}" % ord(c) for c in PY_WHITESPACE) + "]"


# --- fixed value: a section header line ------------------------------------
# "ITEM", blanks, digits and dots, blanks, then anything; any letter case.  For
# Java: Python's whitespace set spelled out, `d` so that only "\n" ends a line,
# `U` for Unicode digits and case folding.
ITEM_HEADER_JAVA = "(?iUd)^{ws}*ITEM{ws}+[\\d.]+{ws}+.+$".format(ws=_ws_class())
_BLOCK = 4096              # characters of a pre-cut block, at least
BLOCK_BREAK = "\n\n"
SENTENCE_BREAK = ". "


def _rfind_sql(w: str, pattern: str) -> str:
    """Last index of ``pattern`` in ``w`` (0-based), -1 when absent."""
    return (
        f"IF(instr({w}, {sql_literal(pattern)}) = 0, -1, "
        f"length({w}) - instr(reverse({w}), {sql_literal(pattern[::-1])}) + 1 - {len(pattern)})"
    )


def spans_sql(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> str:
    """Spark SQL giving ``array<struct<s:int,e:int,p:string>>``: the windows of X11 and their text.

    A window starts at ``s`` and is ``size`` long.  Unless it reaches the end of
    the text it is cut after the last blank line, or failing that after the last
    ". ", when that point lies in its second half.  The next window starts
    ``overlap`` characters before the cut (at least one character later).

    The text is measured once and cut once into blocks, so a window costs two
    blocks wherever it lies.
    """
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    if overlap < 0:
        raise ValueError("chunk overlap must not be negative")
    half = size // 2
    step = max(1, half + 1 - overlap)      # least advance of one window
    block = max(_BLOCK, size)
    cut = (
        f"transform(array({_rfind_sql('w', BLOCK_BREAK)}), b1 -> IF(b1 >= {half}, b1 + 1, "
        f"transform(array({_rfind_sql('w', SENTENCE_BREAK)}), b2 -> IF(b2 >= {half}, b2 + 1, {size}))[0]))[0]"
    )
    at = f"CAST(s DIV {block} AS INT)"
    window = (f"substring(concat(coalesce(get(bl, {at}), ''), coalesce(get(bl, {at} + 1), '')), "
              f"CAST(s % {block} AS INT) + 1, {size})")
    end = f"IF(s + {size} >= n, s + {size}, s + {cut})"
    after = f"IF(acc.e IS NULL, 0, greatest(acc.e - {overlap}, acc.s + 1))"
    # ``transform(array(x), v -> ...)[0]`` binds x to a name once
    one = f"transform(array({after}), s -> transform(array({window}), w -> {end})[0])[0]"
    # each step copies the accumulator deeply: the spans are kept as one string "s:e,s:e"
    had = "concat(acc.sp, IF(acc.e IS NULL, '', concat(acc.s, ':', acc.e, ',')))"
    found = f"named_struct('s', s, 'e', e, 'p', substring({window}, 1, e - s))"
    part = "CAST(substring_index(x, ':', {}) AS INT)"
    return (
        f"transform(array(named_struct('n', length({text}), 'bl', regexp_extract_all({text}, '(?s).{{1,{block}}}', 0))), tx -> "
        f"transform(array(tx.n), n -> transform(array(tx.bl), bl -> "
        f"transform(filter(split(aggregate(sequence(1, CAST(ceil(n / {step}) AS INT) + 1), "
        f"named_struct('s', CAST(NULL AS INT), 'e', CAST(NULL AS INT), 'sp', ''), "
        f"(acc, i) -> IF(acc.e >= n, acc, named_struct('s', {after}, 'e', {one}, 'sp', {had})), "
        f"acc -> {had}), ','), x -> x <> ''), x -> transform(array({part.format(1)}), s -> "
        f"transform(array({part.format(-1)}), e -> {found})[0])[0]))[0])[0])[0]"
    )


def sections_sql(text: str) -> str:
    """Spark SQL giving ``array<struct<sec:string, txt:string>>``.

    Lines are split on "\\n".  A line whose stripped form is an ITEM header
    opens a section, named by that stripped line, which is also its first line.
    Lines before the first header form an unnamed section.  Section text is the
    joined lines, stripped.
    """
    nl = sql_literal("\n")
    header = sql_literal(ITEM_HEADER_JAVA)
    head_line = py_strip_sql("get(ln, h)")
    preamble = py_strip_sql(f"array_join(slice(ln, 1, hd[0]), {nl})")
    body = f"slice(ln, h + 2, coalesce(get(hd, k + 1), size(ln)) - h - 1)"
    section = py_strip_sql(f"array_join(concat(array({head_line}), {body}), {nl})")
    no_null = "CAST(NULL AS STRING)"
    empty = "CAST(array() AS ARRAY<STRUCT<sec: STRING, txt: STRING>>)"
    # ``transform(array(x), v -> ...)[0]`` binds x to a name once
    return (
        f"transform(array(split({text}, {nl}, -1)), ln -> "
        f"transform(array(filter(sequence(0, size(ln) - 1), i -> {py_strip_sql('get(ln, i)')} rlike {header})), hd -> "
        f"IF(size(hd) = 0, array(named_struct('sec', {no_null}, 'txt', {py_strip_sql(text)})), concat("
        f"IF(hd[0] > 0, array(named_struct('sec', {no_null}, 'txt', {preamble})), {empty}), "
        f"transform(hd, (h, k) -> named_struct('sec', {head_line}, 'txt', {section})))))[0])[0]"
    )


def chunks_sql(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> str:
    """Spark SQL giving ``array<struct<section, content>>`` in chunk order."""
    spans = spans_sql("sc.txt", size, overlap)
    piece = py_strip_sql("sp.p")
    return (
        f"flatten(transform({sections_sql(text)}, sc -> transform(filter(transform({spans}, "
        f"sp -> {piece}), c -> c <> ''), c -> named_struct('section', sc.sec, 'content', c))))"
    )


def chunk_text(df: DataFrame, text_col: str = "text", keys: list[str] | None = None,
               size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk: ``keys..., chunk_index, section, content``.

    ``chunk_index`` is contiguous from 0 per document over non-blank chunks;
    overlap never crosses a section.
    """
    keys = list(keys or [c for c in df.columns if c != text_col])
    arr = F.expr(chunks_sql(f"coalesce(`{text_col}`, '')", size, overlap))
    return (
        df.select(*keys, arr.alias("_chunks"))
        .select(*keys, F.posexplode_outer("_chunks").alias("chunk_index", "_c")).filter("chunk_index IS NOT NULL")
        .select(*keys, F.col("chunk_index").cast("int").alias("chunk_index"),
                F.col("_c.section").alias("section"), F.col("_c.content").alias("content"))
    )


def split_text(df: DataFrame, text_col: str = "text", keys: list[str] | None = None,
               size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """X11 alone, no sections: ``keys..., piece_no, start, end, piece``."""
    keys = list(keys or [c for c in df.columns if c != text_col])
    t = f"coalesce(`{text_col}`, '')"
    return (
        df.select(*keys, F.posexplode_outer(F.expr(spans_sql(t, size, overlap))).alias("piece_no", "_s")).filter("piece_no IS NOT NULL")
        .select(*keys, F.col("piece_no").cast("int").alias("piece_no"), F.col("_s.s").alias("start"),
                F.col("_s.e").alias("end"), F.col("_s.p").alias("piece"))
    )


def sections(df: DataFrame, text_col: str = "text", keys: list[str] | None = None) -> DataFrame:
    """X10 alone: ``keys..., section_no, section, section_text``."""
    keys = list(keys or [c for c in df.columns if c != text_col])
    return (
        df.select(*keys, F.expr(sections_sql(f"coalesce(`{text_col}`, '')")).alias("_secs"))
        .select(*keys, F.posexplode_outer("_secs").alias("section_no", "_s")).filter("section_no IS NOT NULL")
        .select(*keys, F.col("section_no").cast("int").alias("section_no"),
                F.col("_s.sec").alias("section"), F.col("_s.txt").alias("section_text"))
    )
