"""Search entry points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.config import API_TOP_K, MAX_TOP_K
from sheaf.functions.meta import meta_field
from sheaf.functions.text import WS_LITERAL
from sheaf.operators import keyword, semantic

MODES = ("semantic", "keyword")
NO_RESULTS = "No matching chunks found."


def check_request(q: str, top_k: int = API_TOP_K, mode: str = "semantic") -> tuple[str, int, str]:
    """Stripped non-empty query, 1 <= top_k <= 100, mode in MODES."""
    query = (q or "").strip()
    if not query:
        raise ValueError("the query has no characters to search for")
    if not 1 <= int(top_k) <= MAX_TOP_K:
        raise ValueError(f"top_k is {top_k}; it may be 1 to {MAX_TOP_K}")
    m = (mode or "").strip().lower()
    if m not in MODES:
        raise ValueError(f"no such mode: {mode}; there are {', '.join(MODES)}")
    return query, int(top_k), m


def search(q: str, chunks: DataFrame, filings: DataFrame, index: keyword.KeywordIndex | None = None,
           encoder=None, top_k: int = API_TOP_K, ticker: str | None = None, form: str | None = None,
           mode: str = "semantic") -> DataFrame:
    """Q3: route to keyword (Q1) or semantic (Q2) search and shape the rows
    (P15 similarity = round(1 - distance, 4); P16 rank = round(rank, 4))."""
    query, k, m = check_request(q, top_k, mode)
    if m == "keyword":
        if index is None:
            raise RuntimeError("keyword index is not ready")
        res = keyword.keyword_search(index, chunks, filings, query, k, ticker, form)
        return res.select("content", F.round("rank", 4).alias("rank"), "accession_number", "chunk_index", "metadata")
    if encoder is None:
        raise ValueError("semantic search needs an encoder")
    from sheaf.operators.embed import encode_query
    qvec = encode_query(chunks.sparkSession, query, encoder)
    top = semantic.semantic_search(chunks.select(*keyword.KEY, "embedding"), qvec, k, filings, ticker, form)
    out = top.join(chunks.select(*keyword.KEY, "content", "metadata"), keyword.KEY)
    return out.select("content", "distance", similarity(F.col("distance")).alias("similarity"),
                      "accession_number", "chunk_index", "metadata").orderBy("distance", *keyword.KEY)


def similarity(distance: F.Column) -> F.Column:
    """P15."""
    return F.round(F.lit(1.0) - distance, 4)


def search_reply(q: str, chunks: DataFrame, filings: DataFrame, index: keyword.KeywordIndex | None = None, encoder=None,
                 top_k: int = API_TOP_K, ticker: str | None = None, form: str | None = None, mode: str = "semantic") -> DataFrame:
    """Q3 as a reply: one row of query, mode, top_k, count and results, at most top_k of them in order."""
    query, k, m = check_request(q, top_k, mode)
    found = search(q, chunks, filings, index, encoder, top_k, ticker, form, mode)
    order = [F.desc("rank")] if m == "keyword" else [F.asc("distance")]
    place = F.row_number().over(Window.orderBy(*order, *keyword.KEY)).alias("place")      # of the k result rows
    rows = found.select(place, F.struct(*found.columns).alias("row"))
    results = F.transform(F.array_sort(F.collect_list(F.struct("place", "row"))), lambda x: x["row"])
    return rows.agg(F.lit(query).alias("query"), F.lit(m).alias("mode"), F.lit(k).alias("top_k"),
                    F.count(F.lit(1)).cast("int").alias("count"), results.alias("results"))


def stats(filings: DataFrame, chunks: DataFrame, index_ready: bool) -> DataFrame:
    """Q4 + A1: filing and chunk counts in one job, plus index readiness."""
    f = filings.agg(F.count(F.lit(1)).alias("filing_count"))
    c = chunks.agg(F.count(F.lit(1)).alias("chunk_count"))
    return f.join(c, how="inner").select("filing_count", "chunk_count", F.lit(index_ready).alias("bm25_ready"))


def render(results: DataFrame, score: str = "rank") -> DataFrame:
    """One text per result list ([i] ticker form (accession, chunk n)
    score=0.0000 | section, then the content, then a blank line).

    ``results`` holds at most top_k (<= 100) rows, so one group is bounded.
    """
    # a window without partition is fine here: the input is the k result rows
    n = F.row_number().over(Window.orderBy(
        F.col(score).desc() if score == "rank" else F.col(score).asc(), "accession_number", "chunk_index"))
    section = F.get_json_object("metadata", "$.section")
    head = F.format_string(f"[%d] %s %s (%s, chunk %d) {score}=%.4f", F.col("_n"), meta_field("metadata", "ticker"),
                           meta_field("metadata", "form"), F.col("accession_number"), F.col("chunk_index"),
                           F.col(score).cast("double"))
    head = F.when(F.coalesce(section, F.lit("")) != "", F.concat(head, F.lit(" | "), section)).otherwise(head)
    block = F.concat(head, F.lit("\n"), F.trim(F.col("content")), F.lit("\n"))
    rows = results.withColumn("_n", n).select("_n", block.alias("_b"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_b"))), lambda x: x["_b"]), "\n")
    return rows.agg(F.count(F.lit(1)).alias("_c"), joined.alias("_t")).select(
        F.when(F.col("_c") == 0, F.lit(NO_RESULTS)).otherwise(F.expr(f"trim(TRAILING {WS_LITERAL} FROM _t)")).alias("text"))
