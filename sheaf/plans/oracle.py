"""DuckDB SQL for the correctness check of the registered queries.

Each builder restates one operator in plain SQL over the pre-registered
tables, independently of the Spark code path (a recursive CTE for the
overlapping split, windows for sections, group-bys for BM25).
"""

from __future__ import annotations

from sheaf.config import BM25_B, BM25_K1, CHUNK_OVERLAP, CHUNK_SIZE
from sheaf.functions.text import PY_WHITESPACE

WS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"
WS_CLASS = "[" + "".join("\\x{%x}" % ord(c) for c in PY_WHITESPACE) + "]"
ITEM_HEADER_RE2 = "(?i)^" + WS_CLASS + "*ITEM" + WS_CLASS + "+[\\p{Nd}.]+" + WS_CLASS + "+.+$"
TOKEN_SPLIT_RE2 = "[^\\p{L}\\p{N}]+"


def q(text: str) -> str:
    """DuckDB string literal (no backslash escapes in DuckDB literals)."""
    return "'" + text.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"trim({expr}, {WS})"


def accession(id_expr: str) -> str:
    return (f"concat(lpad(CAST(({id_expr}) // 1000000 AS VARCHAR), 10, '0'), '-24-', "
            f"lpad(CAST(({id_expr}) % 1000000 AS VARCHAR), 6, '0'))")


def tokens(expr: str) -> str:
    return f"list_filter(string_split_regex(lower({expr}), {q(TOKEN_SPLIT_RE2)}), lambda t: t <> '')"


def _rfind(w: str, pat: str) -> str:
    lit = " || ".join(f"chr({ord(c)})" for c in pat)
    esc = "".join("\\n" if c == "\n" else ("\\." if c == "." else c) for c in pat)
    return (f"(CASE WHEN contains({w}, {lit}) THEN length(regexp_extract({w}, {q('(?s)^(.*)' + esc)}, 1)) "
            f"ELSE -1 END)")


def _end(s: str, t: str, size: int) -> str:
    half = size // 2
    w = f"substring({t}, {s} + 1, {size})"
    nn, ds = _rfind(w, "\n\n"), _rfind(w, ". ")
    cut = f"(CASE WHEN {nn} >= {half} THEN {nn} + 1 WHEN {ds} >= {half} THEN {ds} + 1 ELSE {size} END)"
    return f"(CASE WHEN {s} + {size} >= length({t}) THEN {s} + {size} ELSE {s} + {cut} END)"


def split_ctes(src: str, key: str = "accession_number", size: int = CHUNK_SIZE,
               overlap: int = CHUNK_OVERLAP, sections: bool = True) -> str:
    """CTEs ending in ``chunks(key, chunk_index, section, content)`` and
    ``pieces(key, sec_no, s, e, section, piece)``; ``src`` has ``key, text``."""
    if sections:
        hdr = f"regexp_matches({strip('line')}, {q(ITEM_HEADER_RE2)})"
        sec = f"""
ln AS (
  SELECT {key}, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
  FROM {src}
),
ln2 AS (
  SELECT *, {hdr} AS is_hdr,
         sum(CASE WHEN {hdr} THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY line_no) AS sec_no
  FROM ln
),
secs AS (
  SELECT {key}, sec_no, max(CASE WHEN is_hdr THEN {strip('line')} END) AS section,
         {strip(f"string_agg(CASE WHEN is_hdr THEN {strip('line')} ELSE line END, chr(10) ORDER BY line_no)")} AS txt
  FROM ln2 GROUP BY {key}, sec_no
),"""
    else:
        sec = f"""
secs AS (SELECT {key}, 0 AS sec_no, CAST(NULL AS VARCHAR) AS section, coalesce(text, '') AS txt FROM {src}),"""
    return sec + f"""
spans({key}, sec_no, s) AS (
  SELECT {key}, sec_no, 0 FROM secs
  UNION ALL
  SELECT {key}, sec_no, greatest(e - {overlap}, s + 1) FROM (
    SELECT sp.{key}, sp.sec_no, sp.s, length(x.txt) AS n, {_end('sp.s', 'x.txt', size)} AS e
    FROM spans sp JOIN secs x ON x.{key} = sp.{key} AND x.sec_no = sp.sec_no
  ) WHERE e < n
),
pieces AS (
  SELECT sp.{key}, sp.sec_no, sp.s, {_end('sp.s', 'x.txt', size)} AS e, x.section,
         substring(x.txt, sp.s + 1, {_end('sp.s', 'x.txt', size)} - sp.s) AS piece
  FROM spans sp JOIN secs x ON x.{key} = sp.{key} AND x.sec_no = sp.sec_no
),
chunks AS (
  SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY sec_no, s) - 1 AS INTEGER) AS chunk_index,
         section, {strip('piece')} AS content
  FROM pieces WHERE {strip('piece')} <> ''
)"""


def doc_src() -> str:
    return f"doc_src AS (SELECT {accession('doc_id')} AS accession_number, text FROM documents)"


def doc_filings_cte() -> str:
    return f"""doc_filings AS (
  SELECT {accession('doc_id')} AS accession_number, upper(lang) AS ticker,
         concat('Company ', upper(lang)) AS company_name, upper(source) AS form,
         CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS DATE) AS filing_date,
         concat('/data/docs/', CAST(doc_id AS VARCHAR), '.txt') AS local_path, '' AS document_url
  FROM documents
)"""


def metadata_json(alias_c: str = "c", alias_f: str = "f") -> str:
    """The chunk metadata JSON exactly as Spark's ``to_json`` writes it (null
    fields left out)."""
    def kv(name, expr, first=False):
        return f"'{'' if first else ','}\"{name}\":' || to_json({expr})"
    c, f = alias_c, alias_f
    return ("('{' || (CASE WHEN " + f"{c}.section IS NOT NULL THEN '\"section\":' || to_json({c}.section) || ',' ELSE '' END) || "
            + kv("ticker", f"{f}.ticker", True) + " || " + kv("company_name", f"{f}.company_name") + " || "
            + kv("form", f"{f}.form") + " || " + kv("filing_date", f"strftime({f}.filing_date, '%Y-%m-%d')") + " || "
            + kv("accession_number", f"{f}.accession_number") + " || " + kv("local_path", f"{f}.local_path") + " || "
            + kv("document_url", f"{f}.document_url") + " || '}')")


def bm25_ctes(chunks: str = "chunks", k1: float = BM25_K1, b: float = BM25_B) -> str:
    """CTEs ``tok, cstats, post, tdf`` over ``chunks``."""
    return f"""
tok AS (SELECT accession_number, chunk_index, {tokens('content')} AS toks FROM {chunks}),
cstats AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(toks)) AS avgdl FROM tok),
post AS (
  SELECT accession_number, chunk_index, dl, term, count(*) AS tf
  FROM (SELECT accession_number, chunk_index, len(toks) AS dl, unnest(toks) AS term FROM tok)
  GROUP BY accession_number, chunk_index, dl, term
),
tdf AS (SELECT term, count(*) AS df FROM post GROUP BY term)"""


def bm25_score(k1: float = BM25_K1, b: float = BM25_B) -> str:
    return (f"ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {k1 + 1.0} / "
            f"(tf + {k1} * ({1.0 - b} + {b} * dl / avgdl))")


# --- HTML extraction (X1-X9) ---------------------------------------------------
def _ents_cte() -> str:
    from sheaf.functions.entities import CHARREF_REMAP, NAMED
    named = ", ".join(f"({q(k)}, {q(v)})" for k, v in NAMED.items())
    remap = ", ".join(f"({k}, {q(v)})" for k, v in CHARREF_REMAP.items())
    return f"ents(k, v) AS (VALUES {named}),\nremap(n, v) AS (VALUES {remap})"


def _num_value(n: str) -> str:
    return (f"coalesce((SELECT v FROM remap WHERE remap.n = {n}), CASE "
            f"WHEN {n} BETWEEN 55296 AND 57343 OR {n} > 1114111 THEN chr(65533) "
            f"WHEN {n} BETWEEN 1 AND 8 OR {n} BETWEEN 14 AND 31 OR {n} BETWEEN 127 AND 159 "
            f"OR {n} BETWEEN 64976 AND 65007 OR {n} = 11 OR ({n} & 65534) = 65534 THEN '' "
            f"ELSE chr(CAST({n} AS INTEGER)) END)")


def unescape_ctes(src: str, keys: list[str], col: str, out: str) -> str:
    """CTEs: ``out(keys..., col)`` = ``src`` with references in ``col`` decoded."""
    from sheaf.functions.entities import LEGACY_PATTERN, PIECE_PATTERN
    k = ", ".join(keys)
    on = " AND ".join(f"s.{x} IS NOT DISTINCT FROM d.{x}" for x in keys)
    dec = "regexp_extract(p, '^&#([0-9]+);?$', 1)"
    hx = "regexp_extract(p, '^&#[xX]([0-9a-fA-F]+);?$', 1)"
    ndec = f"(CASE WHEN length(ltrim({dec}, '0')) > 7 THEN 1114112 ELSE CAST(('0' || ltrim({dec}, '0')) AS BIGINT) END)"
    nhex = f"(CASE WHEN length(ltrim({hx}, '0')) > 6 THEN 1114112 ELSE CAST(('0x0' || ltrim({hx}, '0')) AS BIGINT) END)"
    name = "substring(p, 2)"
    pre = f"regexp_extract({name}, {q(LEGACY_PATTERN)}, 1)"
    return f"""
{out}_p AS (
  SELECT {k}, unnest(regexp_extract_all({col}, {q(PIECE_PATTERN)})) AS p,
         generate_subscripts(regexp_extract_all({col}, {q(PIECE_PATTERN)}), 1) AS pi
  FROM {src} WHERE contains({col}, '&')
),
{out}_d AS (
  SELECT {k}, pi, CASE
    WHEN NOT starts_with(p, '&') OR p = '&' THEN p
    WHEN {dec} <> '' THEN {_num_value(ndec)}
    WHEN {hx} <> '' THEN {_num_value(nhex)}
    WHEN e1.v IS NOT NULL THEN e1.v
    WHEN {pre} <> '' THEN (SELECT v FROM ents WHERE ents.k = {pre}) || substring({name}, length({pre}) + 1)
    ELSE p END AS d
  FROM {out}_p LEFT JOIN ents e1 ON e1.k = {name}
),
{out}_j AS (SELECT {k}, string_agg(d, '' ORDER BY pi) AS dd FROM {out}_d GROUP BY {k}),
{out} AS (
  SELECT s.* REPLACE (CASE WHEN contains(s.{col}, '&') THEN coalesce(d.dd, '') ELSE s.{col} END AS {col})
  FROM {src} s LEFT JOIN {out}_j d ON {on}
)"""


def collapse(expr: str) -> str:
    return strip(f"regexp_replace(replace({expr}, chr(160), ' '), '[ \\t]+', ' ', 'g')")


# --- fixed values: what the SQL reading of a page needs -------------------------
TOKEN_PATTERN = r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>|<[!?][^>]*>|[^<]+|<"
SCRIPT_PATTERN = r"(?is)<script\b[^>]*>.*?(?:</script\s*>|$)"
STYLE_PATTERN = r"(?is)<style\b[^>]*>.*?(?:</style\s*>|$)"
STYLE_ATTR_PATTERN = r"""(?is)\sstyle\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""
HIDDEN_STYLE_PATTERN = r"(?i)display\s*:\s*none"
BLOCK_TAGS = ("p", "h1", "h2", "h3", "h4", "li")
CELL_TAGS = ("td", "th")
HIDING_TAGS = ("div", "span")
# -------------------------------------------------------------------------------


def html_ctes(src: str, key: str = "accession_number") -> str:
    """CTEs ending in ``cells, tbls, blocks, doc_text(key, text)``; ``src(key, html)``."""
    inl = lambda xs: "(" + ", ".join(q(x) for x in xs) + ")"
    style = (f"concat(regexp_extract(tok, {q(STYLE_ATTR_PATTERN)}, 1), regexp_extract(tok, {q(STYLE_ATTR_PATTERN)}, 2), "
             f"regexp_extract(tok, {q(STYLE_ATTR_PATTERN)}, 3))")
    run = f"PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    hiding = f"(is_tag AND name IN {inl(HIDING_TAGS)})"
    opening = "(is_tag AND NOT is_close)"
    return f"""
{_ents_cte()},
h_pre AS (
  SELECT {key}, regexp_replace(regexp_replace(coalesce(html, ''), {q(SCRIPT_PATTERN)}, '<script></script>', 'g'),
                               {q(STYLE_PATTERN)}, '<style></style>', 'g') AS h FROM {src}
),
h_tk0 AS (
  SELECT {key}, unnest(regexp_extract_all(h, {q(TOKEN_PATTERN)})) AS tok,
         generate_subscripts(regexp_extract_all(h, {q(TOKEN_PATTERN)}), 1) - 1 AS pos FROM h_pre
),
h_tk AS (
  SELECT {key}, pos, tok, regexp_matches(tok, '^</?[A-Za-z]') AS is_tag,
         regexp_matches(tok, '^</?[A-Za-z]') AND starts_with(tok, '</') AS is_close,
         CASE WHEN regexp_matches(tok, '^</?[A-Za-z]') THEN lower(regexp_extract(tok, '^</?([^\\s/>]+)', 1)) END AS name,
         NOT regexp_matches(tok, '^</?[A-Za-z]') AS is_text
  FROM h_tk0 WHERE NOT (starts_with(tok, '<!') OR starts_with(tok, '<?'))
),
h_d1 AS (
  SELECT *, CASE WHEN {hiding} THEN sum(CASE WHEN {hiding} THEN (CASE WHEN is_close THEN -1 ELSE 1 END) END)
              OVER (PARTITION BY {key}, name ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS depth,
         {hiding} AND NOT is_close AND regexp_matches({style}, {q(HIDDEN_STYLE_PATTERN)}) AS hidden_open
  FROM h_tk
),
h_d2 AS (SELECT *, CASE WHEN is_close THEN depth + 1 ELSE depth END AS lvl FROM h_d1),
h_d3 AS (
  SELECT *, CASE WHEN hidden_open THEN coalesce(first_value(CASE WHEN is_close THEN pos END IGNORE NULLS)
              OVER (PARTITION BY {key}, name, lvl ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), {_END_SQL}) END AS hend
  FROM h_d2
),
h_d4 AS (SELECT *, max(hend) OVER ({run}) AS reach FROM h_d3),
h_kept AS (
  SELECT {key}, pos, tok, is_tag, is_close, name, is_text FROM h_d4
  WHERE (reach IS NULL OR reach < pos)
    AND NOT (is_tag AND (starts_with(name, 'ix:') OR name IN ('script', 'style')))
),
h_st AS (
  SELECT *,
    sum(CASE WHEN is_tag AND name = 'table' THEN (CASE WHEN is_close THEN -1 ELSE 1 END) ELSE 0 END) OVER ({run}) AS tdepth,
    sum(CASE WHEN {opening} AND name = 'table' THEN 1 ELSE 0 END) OVER ({run}) AS table_no,
    sum(CASE WHEN {opening} AND name = 'tr' THEN 1 ELSE 0 END) OVER ({run}) AS row_no,
    sum(CASE WHEN {opening} AND name IN {inl(CELL_TAGS)} THEN 1 ELSE 0 END) OVER ({run}) AS cell_no,
    last_value(CASE WHEN is_tag AND name IN {inl(CELL_TAGS + ('tr', 'table'))} THEN (CASE WHEN {opening} AND name IN {inl(CELL_TAGS)} THEN 1 ELSE 0 END) END IGNORE NULLS) OVER ({run}) AS cell_ev,
    last_value(CASE WHEN is_tag AND name IN {inl(BLOCK_TAGS)} THEN (CASE WHEN is_close THEN 0 ELSE 1 END) END IGNORE NULLS) OVER ({run}) AS blk_ev,
    sum(CASE WHEN {opening} AND name IN {inl(BLOCK_TAGS)} THEN 1 ELSE 0 END) OVER ({run}) AS block_no,
    sum(CASE WHEN {opening} AND name = 'body' THEN 1 ELSE 0 END) OVER ({run}) AS body_seen,
    max(CASE WHEN {opening} AND name = 'body' THEN 1 ELSE 0 END) OVER (PARTITION BY {key}) AS has_body
  FROM h_kept
),
h_txt0 AS (
  SELECT {key}, pos, tok, table_no, row_no, cell_no, block_no,
         (body_seen > 0 OR has_body = 0) AND tdepth > 0 AND coalesce(cell_ev = 1, false) AS in_cell,
         (body_seen > 0 OR has_body = 0) AND tdepth <= 0 AND coalesce(blk_ev = 1, false) AS in_block,
         (body_seen > 0 OR has_body = 0) AND tdepth <= 0 AS in_body_text
  FROM h_st WHERE is_text
),
{unescape_ctes('h_txt0', [key, 'pos'], 'tok', 'h_txt1')},
h_runs AS (SELECT *, {strip('tok')} AS s FROM h_txt1 WHERE {strip('tok')} <> ''),
h_cells0 AS (
  SELECT {key}, table_no, row_no, cell_no, string_agg(s, ' ' ORDER BY pos) AS txt FROM h_runs WHERE in_cell
  GROUP BY {key}, table_no, row_no, cell_no
),
{unescape_ctes('h_cells0', [key, 'table_no', 'row_no', 'cell_no'], 'txt', 'h_cells1')},
cells AS (SELECT {key}, table_no, row_no, cell_no, {collapse('txt')} AS txt FROM h_cells1 WHERE {collapse('txt')} <> ''),
h_rows AS (SELECT {key}, table_no, row_no, string_agg(txt, ' | ' ORDER BY cell_no) AS txt FROM cells GROUP BY {key}, table_no, row_no),
tbls AS (
  SELECT {key}, table_no, string_agg(txt, chr(10) ORDER BY row_no) AS txt FROM h_rows GROUP BY {key}, table_no
),
h_blocks0 AS (
  SELECT {key}, block_no, string_agg(s, ' ' ORDER BY pos) AS txt FROM h_runs WHERE in_block GROUP BY {key}, block_no
),
{unescape_ctes('h_blocks0', [key, 'block_no'], 'txt', 'h_blocks1')},
blocks AS (SELECT {key}, block_no, {collapse('txt')} AS txt FROM h_blocks1 WHERE {collapse('txt')} <> ''),
h_fb0 AS (SELECT {key}, string_agg(s, chr(10) ORDER BY pos) AS txt FROM h_runs WHERE in_body_text GROUP BY {key}),
{unescape_ctes('h_fb0', [key], 'txt', 'h_fb1')},
h_pieces AS (
  SELECT {key}, 0 AS kind, table_no AS seq, txt FROM tbls WHERE txt <> ''
  UNION ALL SELECT {key}, 1, block_no, txt FROM blocks
),
h_main AS (SELECT {key}, string_agg(txt, chr(10) || chr(10) ORDER BY kind, seq) AS main FROM h_pieces GROUP BY {key}),
doc_text AS (
  SELECT s.{key}, coalesce(m.main, {collapse('f.txt')}, '') AS text
  FROM {src} s LEFT JOIN h_main m ON m.{key} = s.{key} LEFT JOIN h_fb1 f ON f.{key} = s.{key}
)"""


_END_SQL = str(1 << 62)


def pages_src() -> str:
    return f"pg_src AS (SELECT {accession('page_id')} AS accession_number, html FROM pages)"


def filing_html_src() -> str:
    return f"""fh_src AS (
  SELECT {accession('page_id')} AS accession_number,
         replace(html, '<article>', concat('<div style="display: none"><ix:header>hidden <div>deep</div></ix:header></div><table><tr><th>Name</th><th>Votes</th></tr><tr><td>TK',
           CAST(page_id % 7 AS VARCHAR), '</td><td><ix:nonFraction>', CAST(page_id AS VARCHAR),
           '</ix:nonFraction></td></tr></table><article><p>preface</p><p>ITEM ', CAST(page_id % 9 + 1 AS VARCHAR), '. Section text</p>')) AS html
  FROM pages
)"""


def filing_events_cte() -> str:
    return f"""fe AS (
  SELECT p.page_id, {accession('p.page_id')} AS accession_number,
         concat('TK', CAST(p.page_id % 7 AS VARCHAR)) AS ticker,
         concat('Company ', CAST(p.page_id % 7 AS VARCHAR)) AS company_name,
         CASE p.page_id % 6 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN '8-K' WHEN 3 THEN '10-K/A'
              WHEN 4 THEN '10-q' ELSE '4' END AS form,
         CAST(DATE '2024-01-01' + CAST(p.page_id % 365 AS INTEGER) AS DATE) AS filing_date,
         concat('/data/', CAST(p.page_id AS VARCHAR), '.htm') AS local_path,
         p.url AS document_url, coalesce(e.ts, TIMESTAMP '2024-01-01 00:00:00') AS downloaded_at
  FROM pages p LEFT JOIN events e ON e.event_id = p.page_id
)"""


def ingest_events_cte() -> str:
    return f"""{filing_events_cte()},
iev AS (
  SELECT page_id AS event_no, accession_number, ticker, company_name, form, filing_date,
         CASE WHEN page_id % 23 = 0 THEN concat('/data/../etc/', CAST(page_id AS VARCHAR), '.htm')
              WHEN page_id % 29 = 0 THEN concat('/data/missing/', CAST(page_id AS VARCHAR), '.htm')
              ELSE local_path END AS local_path,
         document_url, downloaded_at
  FROM fe
)"""
