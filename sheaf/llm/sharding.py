"""Sharding by balanced label propagation.

Documents start in shards cut from one order at equal sums of bytes; linked
documents stand together in that order.  Then rounds of joins tell each document its
neighbours' shards; it wants the one that holds most of them.  A round's moves between
two shards are granted in order of gain, up to a quota: what moves both ways is
exchanged, and one-way moves may use the room that the tolerance leaves.  So cut
links fall and sizes stay even; documents without links level what is left.  A group larger than a shard spreads over several.

The driver holds one number per pair of shards and round; documents and links stay in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import running_totals, settle

SHARDS = 16
SPREAD = 3                 # rounds that gather linked documents before the start
ROUNDS = 6
TOLERANCE = 0.005          # of the mean shard, either way, that moves may use


def leads(both: DataFrame, rounds: int = SPREAD) -> DataFrame:
    """Links in both directions -> node, lead: the least node met in a few rounds, in
    which each node hears its neighbours' leads and its lead's lead."""
    now = settle(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("lead")), "leads")
    for _ in range(rounds):
        heard = both.join(now, both["b"] == now["node"]).groupBy("a").agg(F.min("lead").alias("heard"))
        further = now.select(F.col("node").alias("lead"), F.col("lead").alias("further"))
        now = settle(now.join(further, "lead", "left").join(heard, F.col("node") == F.col("a"))
                     .select("node", F.least("lead", "further", "heard").alias("lead")), "leads")
    return now


def start(nodes: DataFrame, links: DataFrame, shards: int) -> DataFrame:
    """(node, size), (a, b) -> node, size, shard: shards of equal sums of sizes."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lead = leads(both)
    total = nodes.agg(F.sum("size")).first()[0] or 1
    placed = (nodes.join(lead, "node", "left").withColumn("lead", F.least("node", F.coalesce("lead", "node")))
              .withColumns({"mixed": F.xxhash64("lead"), "all": F.lit(0)}))
    placed = running_totals(placed, "all", ["mixed", "lead", "node"], "size", "before", "start")
    at = F.floor((F.col("before") + F.col("size") / 2) * shards / F.lit(float(total))).cast("int")
    return placed.select("node", "size", F.least(at, F.lit(shards - 1)).alias("shard"))


def wishes(state: DataFrame, links: DataFrame, turn: int) -> DataFrame:
    """node, size, shard, wish, gain: documents of this turn with more neighbours in ``wish``
    than where they are.  Half of them have their turn, or two neighbours would swap for ever."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    heard = both.join(state.select(F.col("node").alias("b"), F.col("shard").alias("there")), "b")
    votes = heard.groupBy("a", "there").agg(F.count("*").alias("votes"))
    votes = votes.join(state.withColumnRenamed("node", "a"), "a")
    best = votes.groupBy("a", "size", "shard").agg(
        F.max(F.struct("votes", (-F.col("there")).alias("order"))).alias("best"),
        F.coalesce(F.max(F.when(F.col("there") == F.col("shard"), F.col("votes"))), F.lit(0)).alias("now"))
    wish = -F.col("best.order")
    return (best.select(F.col("a").alias("node"), "size", "shard", wish.alias("wish"), (F.col("best.votes") - F.col("now")).alias("gain"))
            .filter("gain > 0").filter(F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0))


def quotas(flows: dict[tuple[int, int], int], loads: list[int], tolerance: float) -> dict[tuple[int, int], int]:
    """Bytes that may move between each pair of shards."""
    mean = sum(loads) / len(loads)
    low, high = mean * (1 - tolerance), mean * (1 + tolerance)
    granted = {(i, j): min(f, flows.get((j, i), 0)) for (i, j), f in flows.items()}
    loads = list(loads)
    for (i, j), f in sorted(flows.items(), key=lambda x: (-x[1], x[0])):
        more = int(max(0, min(f - granted[i, j], high - loads[j], loads[i] - low)))
        granted[i, j] += more
        loads[i] -= more
        loads[j] += more
    return granted


def loads_of(state: DataFrame, shards: int) -> list[int]:
    loads = [0] * shards
    for r in state.groupBy("shard").agg(F.sum("size").alias("s")).collect():
        loads[r["shard"]] = r["s"]
    return loads


def level(state: DataFrame, links: DataFrame, shards: int) -> DataFrame:
    """Even out what whole groups leave: documents without links, the smallest first, go
    from shards above the mean to shards below it, which cuts nothing."""
    loads = loads_of(state, shards)
    mean = sum(loads) // shards
    lack = {j: mean - load for j, load in enumerate(loads) if load < mean}
    goal, moves = F.lit(None).cast("int"), False
    for i, load in enumerate(loads):
        start, rest = 0, load - mean
        for j in sorted(lack, key=lambda j: -lack[j]) if rest > 0 else ():
            part = min(rest, lack[j])
            if part > 0:
                inside = (F.col("before") >= start) & (F.col("before") + F.col("size") <= start + part)
                goal, moves = F.when((F.col("shard") == i) & inside, F.lit(j)).otherwise(goal), True
                lack[j], rest, start = lack[j] - part, rest - part, start + part
    if not moves:
        return state
    linked = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    free = running_totals(state.join(linked, "node", "left_anti"), "shard", ["size", "node"], "size", "before", "level")
    moved = free.select("node", goal.alias("goal")).filter("goal IS NOT NULL")
    return settle(state.join(moved, "node", "left").select("node", "size", F.coalesce("goal", "shard").alias("shard")), "shards")


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(node, size) with unique nodes and (a, b) links -> node, size, shard."""
    links = settle(links.filter("a <> b").distinct(), "links")
    state = settle(start(nodes, links, shards), "shards")
    still = 0
    for turn in range(rounds):
        moving = settle(wishes(state, links, turn).withColumn("pair", F.col("shard") * shards + F.col("wish"))
                        .withColumn("loss", -F.col("gain")), "wishes")
        flows = {divmod(r["pair"], shards): r["s"] for r in moving.groupBy("pair").agg(F.sum("size").alias("s")).collect()}
        loads = loads_of(state, shards)
        granted = [(i * shards + j, q) for (i, j), q in quotas(flows, loads, tolerance).items() if q > 0]
        still = 0 if granted else still + 1
        if still == 2:      # neither half of the documents can move
            break
        if not granted:
            continue
        quota = F.try_element_at(F.create_map(*[F.lit(x) for pair in granted for x in pair]), F.col("pair"))
        placed = running_totals(moving, "pair", ["loss", "node"], "size", "before", "moves")
        moved = placed.filter(F.col("before") + F.col("size") <= F.coalesce(quota, F.lit(0))).select("node", "wish")
        state = settle(state.join(moved, "node", "left").select("node", "size", F.coalesce("wish", "shard").cast("int").alias("shard")), "shards")
    return level(state, links, shards)


def copies(keyed: DataFrame) -> DataFrame:
    """(node, key) -> links between each node and the smallest of its key; null keys link nothing."""
    given = keyed.filter("key IS NOT NULL")
    hubs = given.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("key", "hub")
    return given.join(hubs, "key").filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))


def shard_documents(docs: DataFrame, keep: list[str], shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: kept (a struct of the ``keep`` columns, doc_id among
    them), size (UTF-8 bytes of the text plus 1), text_crc32, shard, slot (place in
    the shard by doc_id, from 0).  Documents of equal text are linked.

    A null text has size 1, the checksum of no bytes and no links.  Null doc_ids come
    first in their shard; equal rows stand in any order.  An empty table gives no rows.
    A very long text is never cut: its shard is larger by what it alone holds.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("node"), F.struct(*[docs[c] for c in keep]).alias("kept"),
                       docs["text"].cast("string").alias("text"))
    rows = settle(rows.select(
        "node", "kept", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.md5("text").alias("key")), "sizes")
    state = propagate(rows.select("node", "size"), copies(rows.select("node", "key")), shards)
    placed = rows.join(state.select("node", "shard"), "node").select("kept", "size", "text_crc32", "shard", "node",
                                                                     F.col("kept.doc_id").alias("id"), F.lit(1).alias("one"))
    return running_totals(placed, "shard", ["id", "node"], "one", "slot", "slots").select("kept", "size", "text_crc32", "shard", "slot")
