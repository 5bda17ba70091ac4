"""Tables of HTML character references for the SQL restatement of X8, generated
from the Python standard library at import time, not typed in."""

from __future__ import annotations

import html
import html.entities

NAMED = dict(html.entities.html5)                      # "amp;" -> "&", "amp" -> "&", ...
LEGACY = sorted((k for k in NAMED if not k.endswith(";")), key=lambda k: (-len(k), k))
# numbers that stand for another character: 0x80 -> "\u20ac", 0x0D -> "\r", ...
CHARREF_REMAP = {n: html.unescape(f"&#{n};") for n in (0x00, 0x0D, *range(0x80, 0xA0))}

# one reference, or a run of text, or a lone "&"
PIECE_PATTERN = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
LEGACY_PATTERN = "^(" + "|".join(LEGACY) + ")"
