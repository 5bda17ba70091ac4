"""X1-X9 on pages with hand-written text."""

import html as pyhtml

from sheaf.operators.chunk import chunk_text
from sheaf.operators.html import extract_text

FILING = """<?xml version="1.0"?>
<html xmlns="http://www.w3.org/1999/xhtml" xmlns:ix="http://www.xbrl.org/2013/inlineXBRL"><head><title>t</title></head><body>
<div style="margin:0;display:none"><ix:header><ix:references>r1</ix:references></ix:header><br/></div>
<h2>ITEM 3.1 Locks and weirs</h2>
<p>The keeper, <ix:nonNumeric name="k">Odile Marsh</ix:nonNumeric>, opened <b>two</b> gates.</p>
<table><tr><th>Gate</th><th/><th>Width</th></tr><tr><td>North</td><td> </td><td><ix:nonFraction>4,750</ix:nonFraction></td></tr></table>
</body></html>"""


def _text(spark, pages):
    df = spark.createDataFrame(list(pages.items()), "accession_number string, html string")
    return {r.accession_number: r.text for r in extract_text(df).collect()}


def test_an_inline_filing(spark):
    assert _text(spark, {"a": FILING})["a"] == (
        "Gate | Width\nNorth | 4,750\n\nITEM 3.1 Locks and weirs\n\nThe keeper, Odile Marsh , opened two gates.")
    df = spark.createDataFrame([("a", FILING)], "accession_number string, html string")
    chunks = chunk_text(extract_text(df), "text", ["accession_number"], 60, 5).orderBy("chunk_index").collect()
    assert [c.chunk_index for c in chunks] == list(range(len(chunks)))
    assert {c.section for c in chunks} == {None, "ITEM 3.1 Locks and weirs"}


def test_no_visible_text_is_lost(spark):
    xml = "<?xml version='1.0'?><body>"
    pages = {
        "span ends with its cell": ("<table><tr><td>c<span style='display:none'>h</td><td>d</td></tr></table><p>seen</p>", "c | d\n\nseen"),
        "empty element": (xml + "<div style='display:none'><div/>x</div><p>seen</p></body>", "seen"),
        "hidden empty element": (xml + "<div style='display:none'/><p>seen</p></body>", "seen"),
        "not empty in HTML": ("<div style='display:none'/><p>gone</p>", ""),
        "block goes on": ("<li>intro <p>para</p> tail</li>", "intro tail\n\npara"),
        "cell goes on": ("<table><tr><td>A <table><tr><td>in</td></tr></table> B</td><td>C</td></tr></table>", "A B | C\n\nin"),
        "cdata": (xml + "<p><![CDATA[a < b]]></p></body>", "a < b"),
        "quoted end": ("<p title='a>b'>text</p>", "text"),
        "implied ends": ("<ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table><p>p<h3>q</h3>", "x | y\nz\n\none\n\ntwo\n\np\n\nq"),
        "stray end": ("<p>a</div></span>b</p>", "a b"),
        "only the body": ("<html><head><p>head</p></head><body><p>x</p></body></html>", "x"),
    }
    got = _text(spark, {k: h for k, (h, _) in pages.items()})
    assert got == {k: t for k, (_, t) in pages.items()}


def test_fallback_hidden_unclosed_and_entities(spark):
    t = _text(spark, {
        "fb": "<html><body><div>no blocks</div><span>x &amp;amp; y</span></body></html>",
        "uncl": "<p>one<p>two &nbsp; three</p><div style='DISPLAY:none'><p>gone</p>",
        "nested": "<div style=\"display : none\"><div>in</div>still hidden</div><p>shown</p>",
        "script": "<p>a<script>var t='</p>';</script>b</p><style>p{}</style>",
        "empty": "",
    })
    assert t["fb"] == "no blocks\nx & y"
    assert t["uncl"] == "one\n\ntwo three"
    assert t["nested"] == "shown"
    assert t["script"] == "a b"
    assert t["empty"] == ""


def test_references_are_decoded_twice(spark):
    cases = ["a &amp; b", "&amp;amp;", "&copy 2024", "&notit;", "&#65;&#x42;", "&#128;", "x & y", "&Aacute;&aacute", "&#x1F600;"]
    got = _text(spark, {c: f"<p>.{c}.</p>" for c in cases})
    assert got == {c: "." + pyhtml.unescape(pyhtml.unescape(c)) + "." for c in cases}


def test_runs_of_few_pages_are_python_objects_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    from sheaf.operators import html

    pages = [FILING, None, "", "<p>one</p>", "<p>two <b>three</b></p>"] * 5
    held, most = [0], [0]

    class Walked(list):
        def __init__(self, runs):
            super().__init__(runs)
            held[0] += 1

        def __del__(self):
            held[0] -= 1

    walk = html.page_runs
    given = [p or "" for p in pages]
    whole = html.runs_of(pa.array(given)).to_pylist()
    monkeypatch.setattr(html, "page_runs", lambda h: (Walked(walk(h)), most.append(held[0]))[0])
    assert html.runs_of(pa.array(given), 100).to_pylist() == whole == [[dict(zip(html.RUN.names, r, strict=True)) for r in walk(h)] for h in given]
    assert max(most) <= 12                      # of 25 pages
    df = spark.createDataFrame([("a", FILING)], "accession_number string, html string")
    assert extract_text(df).count() == 1
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= html.PAGES_AT_ONCE
