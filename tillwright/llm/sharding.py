"""Sharding by balanced label propagation.

Documents that share a link (here: equal texts) should lie in one shard, and
shards should hold equally many rows. Linked documents start in balanced
shards. In each round every document looks at how many members of its links
lie in each shard, and wants to move to the fullest one. Moves are granted
under quotas: as many documents may go from shard s to shard t as come back,
and beyond that as many as t has room for, those with most neighbours there
first. So no shard ever exceeds its capacity, and a group larger than a shard
fills whole shards. Documents without links then fill the remaining room.

Each round is a few Spark joins over the linked documents. A hot group is
counted per shard before it meets, its join is split by Spark's skew join,
and its movers are ranked over range partitions. Only the shard-to-shard
table (``n_shards`` squared rows) reaches the driver.

Defined results: null is an empty text; rows that repeat a ``doc_id`` or a
text are placed each; shard sizes differ by at most one row; fewer rows than
shards leave shards empty; only doc_id and text are read, other columns may
have any name and are not returned; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, ranked, staged, staged_at

SHARDS = 24
#: Rounds in a row without a lower cut after which propagation ends.
PATIENCE = 10


def _quotas(wishes: dict[tuple[int, int], int], room: list[int]) -> list[tuple[int, int, int]]:
    """Granted moves (s, t, number): swaps first, then what t has room for."""
    room, granted = list(room), []
    for (s, t), n in sorted(wishes.items(), key=lambda x: (-x[1], x[0])):
        swap = min(n, wishes.get((t, s), 0))
        more = min(n - swap, room[t])
        room[t] -= more
        if swap + more:
            granted.append((s, t, swap + more))
    return granted


def wanted(state: DataFrame, members: DataFrame, n_shards: int, open_shards: list[int]) -> DataFrame:
    """(v, s, t, gain) of the documents that would rather be in another of the open shards."""
    placed = members.join(state, "v")
    counts = placed.groupBy("link").agg(*[F.count(F.when(F.col("shard") == t, 1)).alias(f"n{t}") for t in range(n_shards)])
    near = placed.join(counts, "link").groupBy("v", "shard").agg(*[F.sum(f"n{t}").alias(f"n{t}") for t in range(n_shards)], F.min("link").alias("link"))
    # Ties go by a preference that all members of a link share.
    turn = F.pmod(F.xxhash64("link"), F.lit(n_shards))
    choice = [F.struct(F.col(f"n{t}").alias("n"), F.pmod(F.lit(t) - turn, F.lit(n_shards)).alias("turn"), F.lit(t).alias("t")) for t in open_shards]
    here = F.array(*[F.col(f"n{t}") for t in range(n_shards)])[F.col("shard")]
    best = F.array_max(F.array(*choice))
    mine = F.struct(here.alias("n"), F.pmod(F.col("shard") - turn, F.lit(n_shards)).alias("turn"), F.col("shard").alias("t"))
    return near.select("v", "link", F.col("shard").alias("s"), best.alias("best"), mine.alias("mine")).filter("best > mine").select(
        "v", "link", "s", F.col("best.t").alias("t"), (F.col("mine.n") - F.col("best.n")).alias("loss")
    )


def cut_copies(state: DataFrame, members: DataFrame) -> int:
    """Over all links, the shards beyond the first that hold members of it."""
    places = members.join(state, "v").select("link", "shard").distinct()
    return places.groupBy("link").agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def propagated(state: DataFrame, members: DataFrame, capacity: list[int], patience: int = PATIENCE) -> DataFrame:
    """(v, shard) after balanced label propagation of ``state`` (v, shard) over ``members`` (v, link).

    ``capacity``: rows that each shard may hold; ``state`` must respect it.
    Rounds go on until no move is granted, or ``patience`` rounds in a row have
    not lowered the cut; the state of the lowest cut is returned.
    """
    spark, n = state.sparkSession, len(capacity)
    swapping, waited = False, 0
    room = list(capacity)
    for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect():
        room[r["shard"]] -= r["n"]
    best, least, at, best_at = state, cut_copies(state, members), None, None
    while least and waited < patience:
        open_shards = list(range(n)) if swapping else [t for t in range(n) if room[t] > 0]
        granted, movers_at = [], None
        if open_shards:
            movers, movers_at = staged_at(wanted(state, members, n, open_shards), "movers")
            wishes = {(r["s"], r["t"]): r["n"] for r in movers.groupBy("s", "t").agg(F.count("*").alias("n")).collect()}
            granted = _quotas(wishes, room)
        if not granted:
            if movers_at:
                dropped(spark, movers_at)
            if swapping:
                break
            swapping = True
            continue
        for s, t, k in granted:
            room[s] += k
            room[t] -= k
        # Only where a quota binds must the movers be ranked.
        quota = F.broadcast(spark.createDataFrame([(s, t, k, k < wishes[s, t]) for s, t, k in granted], "s int, t int, quota bigint, binds boolean"))
        asked = movers.join(quota, ["s", "t"])
        moved = asked.filter("NOT binds").select("v", F.col("t").alias("to"))
        if any(k < wishes[s, t] for s, t, k in granted):
            order = ranked(asked.filter("binds"), ["loss", "link", "v"], ["s", "t"], "movers")
            moved = moved.unionByName(order.filter("rank < quota").select("v", F.col("t").alias("to")))
        state, new_at = staged_at(state.join(moved, "v", "left").select("v", F.coalesce("to", "shard").alias("shard")), "shards")
        dropped(spark, movers_at)
        if at and at != best_at:
            dropped(spark, at)
        at, cut = new_at, cut_copies(state, members)
        if cut < least:
            if best_at:
                dropped(spark, best_at)
            best, least, best_at, waited = state, cut, new_at, 0
        else:
            waited += 1
    return best


def balanced_shards(docs: DataFrame, n_shards: int = SHARDS, patience: int = PATIENCE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law,
    shard, slot, grown_shard and the text's ``link``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("link"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    rows = staged(ranked(rows, ["doc_id", "link", "_tie"], name="rows").withColumnRenamed("rank", "v").drop("_tie"), "rows")
    n = rows.count()
    capacity = [n // n_shards + (t < n % n_shards) for t in range(n_shards)]
    shared = rows.groupBy("link").agg(F.count("*").alias("n")).filter("n > 1").select("link")
    members = staged(rows.select("v", "link").join(shared, "link"), "members")
    # Row numbers are gapless, so their remainders fill no shard beyond its capacity.
    start = members.select("v", F.pmod("v", F.lit(n_shards)).cast("int").alias("shard"))
    state = propagated(staged(start, "shards"), members, capacity, patience)

    held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    free = ranked(rows.join(state.select("v"), "v", "left_anti").select("v"), ["v"], name="free")
    shard, filled = F.lit(0), 0
    for t, c in enumerate(capacity[:-1]):
        filled += c - held.get(t, 0)
        shard = shard + (F.col("rank") >= filled).cast("int")
    placed = state.unionByName(free.select("v", shard.alias("shard")))
    out = ranked(rows.join(placed, "v"), ["v"], ["shard"], "slots")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "link"
    )
