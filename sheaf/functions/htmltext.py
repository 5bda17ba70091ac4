"""The text runs of one HTML page: a small tree walk over the standard library's parser.

Elements nest without bound and close by rules (void elements, implied ends, XML's
``/>``), which no fixed set of column expressions can follow; so a page is
walked once, in the task that holds it, with a stack of open elements.  The walk
gives runs only; ``operators.html`` puts cells, rows, tables, blocks and texts together.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

# --- fixed values -------------------------------------------------------------
HIDDEN_STYLE = re.compile(r"display\s*:\s*none", re.IGNORECASE)
BLOCK_TAGS = frozenset(("p", "h1", "h2", "h3", "h4", "li"))
CELL_TAGS = frozenset(("td", "th"))
HIDING_TAGS = frozenset(("div", "span"))
SILENT_TAGS = frozenset(("script", "style"))
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = frozenset("address blockquote center dir div dl fieldset form h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul li dd dt".split())
# a start tag of the key ends an open element of the first set, unless one of the second stands between
ENDS = {"li": (frozenset(("li",)), frozenset(("ul", "ol", "table"))),
        "dd": (frozenset(("dd", "dt")), frozenset(("dl", "table"))), "dt": (frozenset(("dd", "dt")), frozenset(("dl", "table"))),
        "td": (CELL_TAGS, frozenset(("table",))), "th": (CELL_TAGS, frozenset(("table",))),
        "tr": (CELL_TAGS | {"tr"}, frozenset(("table",))),
        **{t: (CELL_TAGS | {"tr", "thead", "tbody", "tfoot"}, frozenset(("table",))) for t in ("thead", "tbody", "tfoot")}}
# ------------------------------------------------------------------------------


NOTHING = ("", False, None, None, None)


class Page(HTMLParser):
    """Collects stripped text runs under the cell, block and body they belong to.

    An open element is (name, hides, block, cell, place): what applies to text inside
    it; place is the table and row.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.xml = html.lstrip().startswith("<?xml")
        self.open: list[tuple[str, bool, int | None, tuple[int, int, int] | None, tuple[int, int] | None]] = []
        self.tables = self.rows = self.cells = self.blocks = 0
        self.body_at: int | None = None
        self.data: list[str] = []
        self.runs: list[tuple[str, bool, int | None, tuple[int, int, int] | None]] = []
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        run = "".join(self.data).strip()
        self.data.clear()
        if run and not (self.open and self.open[-1][1]):
            _, _, block, cell, place = self.open[-1] if self.open else NOTHING
            self.runs.append((run, place is not None, block, cell))

    def handle_data(self, data: str) -> None:
        self.data.append(data)

    def handle_comment(self, data: str) -> None:
        self.flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data: str) -> None:
        self.flush()
        if self.xml and data.startswith("CDATA["):
            self.data.append(data[6:])
            self.flush()

    def pop_to(self, k: int) -> None:
        del self.open[k:]

    def implied_ends(self, tag: str) -> None:
        targets, walls = ENDS.get(tag, (frozenset(), frozenset()))
        if tag in ENDS_PARAGRAPH:
            targets, walls = targets | {"p"}, walls | {"table", "td", "th", "li"} - targets
        last = None
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in targets:
                last = k
            elif self.open[k][0] in walls:
                break
        if last is not None:
            self.pop_to(last)

    def handle_starttag(self, tag: str, attrs) -> None:
        self.start(tag, attrs, empty=False)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.start(tag, attrs, empty=self.xml)

    def start(self, tag: str, attrs, empty: bool) -> None:
        self.flush()
        if not self.xml:
            self.implied_ends(tag)
        _, hides, block, cell, place = self.open[-1] if self.open else NOTHING
        hides = hides or tag in SILENT_TAGS or tag in HIDING_TAGS and bool(HIDDEN_STYLE.search(dict(attrs).get("style") or ""))
        if not hides:
            if tag == "table":
                self.tables += 1
                block, cell, place = None, None, (self.tables, 0)
            elif tag == "tr" and place:
                self.rows += 1
                cell, place = None, (place[0], self.rows)
            elif tag in CELL_TAGS and place:
                self.cells += 1
                cell = (*place, self.cells)
            elif tag in BLOCK_TAGS:
                self.blocks += 1
                block = self.blocks
            elif tag == "body" and self.body_at is None:
                self.body_at = len(self.runs)
        if not empty and (self.xml or tag not in VOID_TAGS):
            self.open.append((tag, hides, block, cell, place))

    def handle_endtag(self, tag: str) -> None:
        self.flush()
        walls = () if self.xml or tag in ("table", "body", "html") else ("table",) if tag in CELL_TAGS | {"tr"} else ("table", "td", "th")
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                # a paragraph that nobody ended goes on to the next block
                on = [e for e in self.open[k + 1:] if e[0] == "p" and not e[1] and e[4] is None and not self.xml]
                self.pop_to(k)
                self.open += on[-1:] if tag not in BLOCK_TAGS else []
                return
            if self.open[k][0] in walls:
                return


def page_runs(html: str | None) -> list[tuple[int | None, int | None, int | None, int | None, bool, str]]:
    """The visible text runs of a page's body in order, each with the table, row and cell and the block
    that it belongs to, whether it is inside a table, and its text with references decoded once more."""
    page = Page(html or "")
    return [(*(cell or (None, None, None)), block, in_table, unescape(run)) for run, in_table, block, cell in page.runs[page.body_at or 0:]]
