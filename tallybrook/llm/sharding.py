"""Balanced label propagation: linked documents move to one shard, shards stay even.

Documents are linked through hubs (here: equal texts). Shards begin even. In each
round the members of a hub want to go where most of them are; what a shard takes
in is limited by what it can give away in turn, so counts never change by a move.
Only DataFrame functions work on rows; the driver sees counts per pair of shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.shared import ranked, settled, spread

SHARDS = 16
ROUNDS = 10
# A shard that can take no more than this share of those who want to come is full.
LEAST_SHARE = 0.02


def text_hub(text: Column) -> Column:
    """Hub of equal texts: 128 bits of hash; a null text has no hub."""
    return F.when(text.isNotNull(), F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7919), text).alias("b")))


def propagated(rows: DataFrame, key: str, hub: str, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(key, hub, spread, shard): every row's shard, counts at most one apart.

    A null hub, or one with a single row, links nothing. A hub with more rows
    than a shard holds fills shards one after another. Rounds end when nothing
    moves. Rows that repeat are rows of their own.
    """
    order = rows.select(F.col(key).alias("key"), F.col(hub).alias("hub"), spread(F.col(key)).alias("spread"))
    # Without the texts, which are read once.
    order = settled(order, "documents")
    linked = order.where("hub IS NOT NULL").groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hub")
    linked = linked.withColumnRenamed("hub", "_hub").withColumn("linked", F.lit(True))
    begun = ranked(order, [], ["spread", "key"], "place").select(
        "key", "hub", "spread", (F.col("place") % shards).cast("int").alias("shard")
    )
    state = settled(
        begun.join(linked, F.col("hub") == F.col("_hub"), "left").select(
            "key", F.when(F.col("linked"), F.col("hub")).alias("hub"), "spread", "shard"
        ),
        "shards",
    )
    closed: set[int] = set()
    for _ in range(rounds):
        known = set(closed)
        moved = _round(state, shards, closed)
        if moved is None and closed == known:
            break
        state = state if moved is None else moved
    return state


def _round(state: DataFrame, shards: int, closed: set[int]) -> DataFrame | None:
    """The state after one round of moves; None when nothing can move.

    Shards that can take in next to nothing are added to `closed`, and no hub
    chooses them any more.
    """
    counts = settled(state.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n")), "hub-counts")
    free = {r["shard"]: r["n"] for r in counts.where("hub IS NULL").groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    free = {s: free.get(s, 0) for s in range(shards)}
    linked = counts.where("hub IS NOT NULL")
    is_open = ~F.col("shard").isin(sorted(closed)) if closed else F.lit(True)
    # The open shard where most members are; equal counts are decided by a hash.
    choice = F.struct("n", F.xxhash64("hub", "shard").alias("tie"), "shard")
    homes = (
        linked.groupBy("hub")
        .agg(F.max(F.when(is_open, choice)).alias("home"))
        .select(F.col("hub").alias("_hub"), F.col("home.shard").alias("home"), F.col("home.n").alias("home_n"), F.col("home.tie").alias("home_tie"))
    )
    # A member stays where more others are.
    fewer = (F.col("n") < F.col("home_n")) | (
        (F.col("n") == F.col("home_n")) & (~is_open | (F.xxhash64("hub", "shard") < F.col("home_tie")))
    )
    gains = linked.join(homes, F.col("hub") == F.col("_hub")).where((F.col("home") != F.col("shard")) & fewer)
    gains = gains.select("_hub", F.col("shard").alias("_shard"), "home")
    wishes = state.join(
        gains, (F.col("hub") == F.col("_hub")) & (F.col("shard") == F.col("_shard")), "left"
    ).select("key", "hub", "spread", "shard", F.when(F.col("hub").isNull(), -1).otherwise(F.col("home")).alias("to"))
    wishes = settled(wishes, "wishes")
    wanted = {(r["shard"], r["to"]): r["n"] for r in wishes.where("to >= 0").groupBy("shard", "to").agg(F.count(F.lit(1)).alias("n")).collect()}
    moves = quotas(wanted, free)
    for s in range(shards):
        coming = sum(n for (_, to), n in wanted.items() if to == s)
        taken = sum(high - low for _, to, low, high, _ in moves if to == s)
        # Also full is a shard that gave all its free rows away and still could not take everyone.
        if coming and (taken <= LEAST_SHARE * coming or 0 < free[s] and taken < coming):
            closed.add(s)
    if not moves:
        return None
    spark = state.sparkSession
    table = spark.createDataFrame(moves, "_shard int, _to int, low bigint, high bigint, goal int")
    candidates = ranked(wishes.where("to IS NOT NULL"), ["shard", "to"], ["spread", "key"], "place")
    allowed = (
        (F.col("shard") == F.col("_shard"))
        & (F.col("to") == F.col("_to"))
        & (F.col("place") >= F.col("low"))
        & (F.col("place") < F.col("high"))
    )
    # At most three rows per pair of shards, so the table's size does not depend on the input.
    after = candidates.join(F.broadcast(table), allowed, "left")
    after = after.select("key", "hub", "spread", F.coalesce("goal", "shard").alias("shard"))
    staying = wishes.where("to IS NULL").select("key", "hub", "spread", "shard")
    return settled(after.unionByName(staying), "shards")


def quotas(
    wanted: dict[tuple[int, int], int], free: dict[int, int]
) -> list[tuple[int, int, int, int, int]]:
    """(shard, to, low, high, goal): which places of each wish go where, counts kept.

    `wanted` has the members of `shard` that want to go `to` another; `free` the
    rows of a shard without links, which make room. Wishes into a shard that
    cannot give enough away are cut in proportion.
    """
    taken = dict(wanted)
    while True:
        net = dict.fromkeys(free, 0)
        for (shard, to), n in taken.items():
            net[to] += n
            net[shard] -= n
        over = [s for s in net if net[s] > free[s]]
        if not over:
            break
        for s in over:
            pairs = sorted(p for p, n in taken.items() if p[1] == s and n)
            coming, cut = sum(taken[p] for p in pairs), net[s] - free[s]
            # In proportion, rounded so that what is cut adds up.
            done = seen = 0
            for p in pairs:
                seen += taken[p]
                part = seen * cut // coming - done
                taken[p] -= part
                done += part
    moves = [(shard, to, 0, n, to) for (shard, to), n in sorted(taken.items()) if n]
    places = dict.fromkeys(free, 0)
    short = [[s, -n] for s, n in sorted(net.items()) if n < 0]
    for s, n in sorted(net.items()):
        while n > 0:
            part = min(n, short[0][1])
            moves.append((s, -1, places[s], places[s] + part, short[0][0]))
            places[s] += part
            n -= part
            short[0][1] -= part
            if not short[0][1]:
                short.pop(0)
    return moves


def sharded(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot): equal texts together as far as shards hold them.

    `size` is the text's UTF-8 bytes and one more; a null text has none, and the
    checksum 0, like an empty one. `slot` is gapless from 0 within a shard. The
    law that holds is `rows`: shards differ by one row at most.
    """
    bytes_ = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    item = F.struct(
        F.col(key).alias("key"),
        (F.octet_length(bytes_) + 1).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
    )
    rows = docs.select(item.alias("item"), text_hub(F.col(text)).alias("hub"))
    # The item travels as the key, so that the texts are read once and joined to nothing.
    placed = propagated(rows, "item", "hub", shards, rounds)
    return ranked(placed, ["shard"], ["spread", "key"], "slot").select(
        F.col("key.key").alias(key), "key.size", "key.text_crc32", F.lit("rows").alias("law"), "shard", "slot"
    )
