"""URL filters: a sort-merge range join of urls with nested host/path rules.

A rule ``(host, path)`` fits its host and all subdomains if the url's path
starts with the rule's.  Its canonical key is the host with its labels
reversed, a separator and the path, so the rule covers one interval of keys:
those that start with its own.  A url has one point per host suffix (``a.b.c``:
``c``, ``c.b``, ``c.b.a``), each with its whole path, because subdomain labels would
otherwise stand between host and path.  Rules and points are range-partitioned
in one order and swept once.  Intervals of prefixes are nested or disjoint, so
the sweep's state is a stack: the rules that enclose the current key.  The
innermost rule left after popping the closed ones is the longest for that
suffix, and the longest over all suffixes wins.

Everything is DataFrame functions.  Equal urls are split by a salt in the sort
order, so a hot host, or one url on a third of all pages, spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.llm.common import settle, width

SEP = "\x01"           # sorts before every character of hosts and paths
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of one swept block of points, rules of one folded chunk.
BLOCK_ROWS = 100_000
CHUNK_RULES = 256
STACK = "array<struct<key:string,rule:string,verdict:string,length:int,host_length:int>>"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.substring_index(F.substr(url, F.instr(url, "://") + F.lit(3)), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    rest = F.substr(url, F.instr(url, "://") + F.lit(3))
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    slash = F.instr(rest, "/")
    return F.when((F.instr(url, "://") > 0) & (slash > 0), F.substr(rest, slash)).otherwise("")


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rule_key(host: Column, path: Column) -> Column:
    return F.concat(reversed_host(host), F.lit(SEP), path)


def rule_stacks(rules: DataFrame) -> DataFrame:
    """The first sweep, over the sorted rules alone: key -> the stack when the
    sweep stands on that rule (the rules that enclose it, outermost first, and itself).

    Chunks of ``CHUNK_RULES`` sorted rules are folded one by one; a second fold over
    one row per chunk carries what is open from chunk to chunk.
    """
    rhost, rpath = F.translate(rules["host"].cast("string"), UPPER, LOWER), rules["path"].cast("string")
    rules = (rules.select(rhost.alias("host"), rpath.alias("path"), rules["verdict"].cast("string").alias("verdict"))
             .filter("host <> '' AND path IS NOT NULL")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))      # the same rule twice: block wins
             .select(rule_key(F.col("host"), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"), "verdict",
                     (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length")))
    n = int(rules.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rules = settle(rules.repartitionByRange(n, "key").withColumn("block", F.spark_partition_id()), "url-rules")
    place = F.row_number().over(Window.partitionBy("block").orderBy("key")) - 1
    rules = rules.withColumn("chunk", F.floor(place / CHUNK_RULES).cast("int"))
    none = F.expr(f"cast(array() AS {STACK})")
    steps = F.expr(f"cast(array() AS array<struct<key:string,stack:{STACK}>>)")

    def popped(stack: Column, key: Column) -> Column:
        return F.filter(stack, lambda s: F.startswith(key, s["key"]))

    def last(folded: Column) -> Column:
        return F.coalesce(F.try_element_at(folded, F.lit(-1))["stack"], none)

    def push(folded: Column, r: Column) -> Column:
        return F.array_append(folded, F.struct(
            r["key"].alias("key"), F.concat(popped(last(folded), r["key"]), F.array(r)).alias("stack")))

    chunks = (rules.groupBy("block", "chunk")
              .agg(F.array_sort(F.collect_list(F.struct("key", "rule", "verdict", "length", "host_length"))).alias("opened"))
              .withColumn("folded", F.aggregate("opened", steps, push)))
    ends = chunks.select("block", "chunk", F.col("opened")[0]["key"].alias("first"),
                         F.element_at("folded", -1)["key"].alias("key"), last(F.col("folded")).alias("stack"))
    carried = F.aggregate(
        "ends", F.expr(f"cast(array() AS array<struct<block:int,chunk:int,entered:{STACK},stack:{STACK}>>)"),
        lambda acc, e: F.array_append(acc, F.struct(
            e["block"].alias("block"), e["chunk"].alias("chunk"), popped(last(acc), e["first"]).alias("entered"),
            F.concat(popped(last(acc), e["key"]), e["stack"]).alias("stack"))))
    entered = (ends.agg(F.array_sort(F.collect_list(F.struct("block", "chunk", "first", "key", "stack"))).alias("ends"))
               .select(F.explode(carried).alias("e")).select("e.block", "e.chunk", "e.entered"))
    return (chunks.join(entered, ["block", "chunk"])
            .select("entered", F.explode("folded").alias("f"))
            .select(F.col("f.key").alias("key"), F.concat(popped(F.col("entered"), F.col("f.key")), F.col("f.stack")).alias("stack")))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    ``rules``: host, path, verdict.  The longest rule (characters of host and
    path) wins; ties go to the longer host, then to the greater verdict word
    (block over allow), then to the greater rule.  ``default`` is the verdict where
    no rule fits: a filter of listed hosts lets the rest pass.  Null url or no
    ``://``: host and path empty, no rule.  Rules with a null host or path, or an
    empty host, fit nothing.  Repeated pages give repeated rows; null ids and extra
    columns are harmless; an empty table gives no rows, no rules the default.  A very long
    url is judged whole, by its whole path.
    """
    spark = pages.sparkSession
    hosted = pages.select(F.monotonically_increasing_id().alias("row"), pages["page_id"].alias("page_id"),
                          pages["url"].cast("string").alias("url"))
    hosted = hosted.select("row", "page_id", F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"),
                           F.coalesce(url_path(F.col("url")), F.lit("")).alias("path"))
    labels = F.reverse(F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, F.lit(1), i), "."))
    points = hosted.withColumn("suffix", F.explode(suffixes)).select(
        F.concat("suffix", F.lit(SEP), "path").alias("key"), F.lit(1).alias("kind"), "row", "page_id", "host", "path")
    opens = rule_stacks(rules).withColumns({"kind": F.lit(0), "row": F.lit(-1).cast("long")})

    # the sorted order: (key, rules first, row); the row is the salt of equal keys
    n = width(spark, 4 * pages.count() + 1, BLOCK_ROWS)
    events = points.unionByName(opens, allowMissingColumns=True).repartitionByRange(n, "key", "kind", "row")
    events = settle(events.withColumn("block", F.spark_partition_id()), "url-events")
    # what is open where a block starts: the stack of the last rule in the blocks before (one row per block)
    blocks = events.groupBy("block").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.last("stack", ignorenulls=True).over(before).alias("entered"))
    sweep = Window.partitionBy("block").orderBy("key", "kind", "row").rowsBetween(Window.unboundedPreceding, 0)
    swept = (events.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1")
             .join(blocks, "block")
             .withColumn("alive", F.filter(F.coalesce("open", "entered"), lambda s: F.startswith(F.col("key"), s["key"]))))
    inner = F.try_element_at("alive", F.lit(-1))
    best = swept.groupBy("row").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.when(inner.isNotNull(), F.struct(inner["length"].alias("length"), inner["host_length"].alias("host_length"),
                                                 inner["verdict"].alias("verdict"), inner["rule"].alias("rule")))).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
