"""Text functions as Spark column expressions (JVM side, no Python per row).

Most helpers come in two shapes: ``*_sql(expr)`` returns Spark SQL text that can
be used inside higher-order-function lambdas, and the plain name returns a
``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.config import FORM_SELECTIONS, FORM_SPELLINGS

# Characters Python's ``str.strip()`` removes.  Spark's ``trim`` removes only
# the space, so the set is derived here from Python's own rule.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def sql_literal(text: str) -> str:
    """Quote ``text`` as a Spark SQL string literal (non-ASCII as \\uXXXX)."""
    out = []
    for ch in text:
        code = ord(ch)
        if ch == "'" or ch == "\\":
            out.append("\\" + ch)
        elif 0x20 <= code < 0x7F:
            out.append(ch)
        elif code <= 0xFFFF:
            out.append("\\u%04x" % code)
        else:  # surrogate pair in the literal
            hi, lo = divmod(code - 0x10000, 0x400)
            out.append("\\u%04x\\u%04x" % (0xD800 + hi, 0xDC00 + lo))
    return "'" + "".join(out) + "'"


WS_LITERAL = sql_literal(PY_WHITESPACE)


def py_strip_sql(expr: str) -> str:
    """Python ``str.strip()`` on a SQL expression."""
    return f"trim(BOTH {WS_LITERAL} FROM {expr})"


def py_strip(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c, F.lit(PY_WHITESPACE))


def upper_strip(col: Column | str) -> Column:
    """Strip then upper."""
    return F.upper(py_strip(col))


# --- keyword tokenizer (X18) ------------------------------------------------
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(F.lower(c), TOKEN_SPLIT), lambda t: t != F.lit(""))


# --- allow lists and form selections (P2, P9, X13) --------------------------
def parse_allow_list(text: str | None) -> list[str]:
    """Comma-separated setting -> trimmed non-empty items (driver-side helper)."""
    if text is None:
        return []
    return [item.strip() for item in text.split(",") if item.strip()]


def allow_list_col(col: Column | str) -> Column:
    """P2 as a column: split on commas, Python-strip, drop empties."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.transform(F.split(c, ","), lambda x: py_strip(x)), lambda x: x != F.lit(""))


def canonical_form_col(col: Column | str) -> Column:
    """P9 for one value: strip, upper, drop spaces, 10Q/10K/8K spelled with a dash."""
    c = F.col(col) if isinstance(col, str) else col
    out = F.replace(upper_strip(c), F.lit(" "), F.lit(""))
    for plain, dashed in FORM_SPELLINGS:
        out = F.replace(out, F.lit(plain), F.lit(dashed))
    return out


def canonical_form(value: str) -> str:
    """P9 for one string: fixed rule (strip, upper, no spaces, the fixed spellings) in plain replacements."""
    out = value.strip().upper().replace(" ", "")
    for plain, dashed in FORM_SPELLINGS:
        out = out.replace(plain, dashed)
    return out


def normalize_forms(forms: list[str] | None, supported=None) -> list[str] | None:
    """P9 for a request argument (a handful of strings, checked on the driver): the
    distinct forms in request order.  None means no choice and stays None; an empty
    list, or one with a form that nobody supports, raises ``ValueError`` and names what is wrong."""
    if forms is None:
        return None
    named = {canonical_form(f): f for f in reversed(forms)}
    wrong = sorted(named[f] for f in named.keys() - set(supported or FORM_SELECTIONS))
    if wrong or not named:
        raise ValueError(f"cannot load these forms: {wrong}" if wrong else "no form was chosen")
    return list(dict.fromkeys(map(canonical_form, forms)))
