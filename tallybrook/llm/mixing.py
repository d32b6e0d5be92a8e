"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are cut into blocks. Of a source of weight w, block j is
released at slot (j-1)/w and due by slot j/w; every slot takes the released block
that is due first. So after any number of slots each source has had its share to
within one block. Weights are whole parts of a period, after which the schedule
repeats: one period is worked out, and Spark places every row by it without
moving rows into one place.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import defaultdict
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.shared import ranked, spread

BLOCK_ROWS = 16
PERIOD = 1000
# Without targets, weights follow the sources' rows to this power: large sources are
# still mixed in more often, but less than they are large.
SIZE_POWER = 0.5
# Turns of the schedule that one row is unfolded into at once.
TURNS_CUT = 10_000


def whole_parts(weights: list[float], period: int) -> list[int]:
    """Weights as whole parts of the period, one at least, by largest remainder."""
    total = math.fsum(weights)
    ideal = [period * (w / total) if total else period / len(weights) for w in weights]
    parts = [max(1, math.floor(x)) for x in ideal]
    order = sorted(range(len(parts)), key=lambda i: (-(ideal[i] - math.floor(ideal[i])), i))
    for i in order[: max(0, period - sum(parts))]:
        parts[i] += 1
    largest = [(-part, i) for i, part in enumerate(parts)]
    heapq.heapify(largest)
    for _ in range(sum(parts) - period):  # many small sources were raised to one part
        part, i = largest[0]
        parts[i] -= 1
        heapq.heapreplace(largest, (part + 1, i))
    return parts


def one_period(parts: list[int]) -> list[int]:
    """The source of each slot of a period of sum(parts) slots, earliest deadline first."""
    period = sum(parts)
    # (release, source, block) and (deadline, source, block)
    waiting = [(0, source, 0) for source in range(len(parts))]
    ready: list[tuple[int, int, int]] = []
    slots = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, source, block = heapq.heappop(waiting)
            due = math.ceil(Fraction((block + 1) * period, parts[source]))
            heapq.heappush(ready, (due, source, block))
        _, source, block = heapq.heappop(ready)
        slots.append(source)
        if block + 1 < parts[source]:
            heapq.heappush(waiting, ((block + 1) * period // parts[source], source, block + 1))
    return slots


def mixed(
    rows: DataFrame,
    targets: dict[str | None, float] | None = None,
    source: str = "source",
    key: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
) -> DataFrame:
    """All rows with `block`, `slot`, `position` and `on_target`; sort by `position` for the mix.

    `targets` gives each source's weight; they need not sum to one. A source with
    rows but no target, or one of 0, gets one part of the period, the least there
    is; null is a source like others. Within a source, rows come in the order of
    a hash of `key`, those without a key by a hash of the whole row. When a source
    has run out, its slots are passed over, and the rest keep their weights among
    themselves. `position` counts rows, gapless from 0. `on_target` marks the slots
    before the first source has run out, in which the deviation of each source
    stays under one block.

    One row per source is brought to the driver, and the period is made longer
    where there are more sources than a tenth of it; the schedule has one entry per
    slot of a period. Positions are counted within each turn of the schedule, which
    holds no more than a block per slot, and turns start where a table of their
    sizes says. Rows that repeat take places of their own. A given column named
    like an added one is replaced.
    """
    placed, plan = _placed(rows, targets, source, key, block_rows, period)
    in_turn = Window.partitionBy("turn").orderBy("at", "rank")
    starts = _turn_starts(rows.sparkSession, plan)
    counted = placed.withColumn("place", F.row_number().over(in_turn) - 1)
    slot = F.col("turn") * F.lit(plan.period) + F.col("at")
    added = ("block", "slot", "position", "on_target")
    return counted.join(starts, F.col("turn") == F.col("_turn")).select(
        *[F.col("row")[c].alias(c) for c in rows.columns if c not in added],
        "block",
        slot.alias("slot"),
        (F.col("start") + F.col("place")).alias("position"),
        (slot < F.lit(plan.first_end)).alias("on_target"),
    )


def in_mixed_order(
    rows: DataFrame, targets: dict[str | None, float] | None = None, source: str = "source", key: str = "doc_id"
) -> DataFrame:
    """All rows with their own columns, sorted into the mix, so that files hold it in order.

    The order is that of `mixed`; the rows' slots say it, so no position is counted.
    """
    placed, _ = _placed(rows, targets, source, key, BLOCK_ROWS, PERIOD)
    return placed.orderBy("turn", "at", "rank").select("row.*")


@dataclass(frozen=True)
class _Plan:
    """The sources with their rows and parts, and what follows from them."""

    rows: list[int]
    parts: list[int]
    block_rows: int
    slots_of: list[list[int]]

    @property
    def period(self) -> int:
        return sum(self.parts)

    @property
    def first_end(self) -> int:
        """The first slot of a source that has run out."""
        ends = []
        for n, part, slots in zip(self.rows, self.parts, self.slots_of, strict=True):
            turn, at = divmod(-(-n // self.block_rows), part)
            ends.append(turn * self.period + slots[at])
        return min(ends, default=0)

    def spans(self) -> list[tuple[int, int, int, int]]:
        """(first turn, turn after the last, rows before the first, rows a turn), in order.

        A source fills its parts of every turn but its last; so turns between two
        such ends are of one size, and there are two spans per source at most.
        """
        change: dict[int, int] = defaultdict(int)
        for n, part in zip(self.rows, self.parts, strict=True):
            full, rest = divmod(n, part * self.block_rows)
            change[0] += part * self.block_rows
            change[full] += rest - part * self.block_rows
            change[full + 1] -= rest
        spans = []
        before = size = 0
        turns = sorted(change)
        for turn, after in itertools.pairwise(turns):
            size += change[turn]
            if size:
                spans.append((turn, after, before, size))
            before += size * (after - turn)
        return spans


def _placed(
    rows: DataFrame,
    targets: dict[str | None, float] | None,
    source: str,
    key: str,
    block_rows: int,
    period: int,
) -> tuple[DataFrame, _Plan]:
    """(row, rank, block, turn, at): each row's block, and its slot `at` in which turn of the schedule."""
    counted = rows.groupBy(F.col(source).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n")).collect()
    counted.sort(key=lambda r: (r["source"] is not None, r["source"] or ""))
    if targets is None:
        weights = [float(r["n"]) ** SIZE_POWER for r in counted]
    else:
        weights = [max(0.0, float(targets.get(r["source"], 0.0))) for r in counted]
    parts = whole_parts(weights, max(period, 10 * len(counted))) if counted else []
    slots_of: list[list[int]] = [[] for _ in parts]
    for slot, i in enumerate(one_period(parts)):
        slots_of[i].append(slot)
    plan = _Plan([r["n"] for r in counted], parts, block_rows, slots_of)
    by_source = rows.sparkSession.createDataFrame(
        [(r["source"], p, at) for r, p, at in zip(counted, parts, slots_of, strict=True)],
        "_source string, parts bigint, slots array<int>",
    )
    columns = [F.col(f"`{c}`") for c in rows.columns]
    # Rows without a key are many at times; their hash parts them.
    by_row = spread(F.to_json(F.struct(*columns)))
    order = rows.select(
        F.struct(*columns).alias("row"),
        F.col(source).cast("string").alias("source"),
        F.when(F.col(key).isNull(), by_row).otherwise(spread(F.col(key))).alias("spread"),
        F.col(key).alias("key"),
    )
    ordered = ranked(order, ["source"], ["spread", "key"], "rank")
    block = F.floor(F.col("rank") / block_rows).cast("long")
    joined = ordered.join(F.broadcast(by_source), F.col("source").eqNullSafe(F.col("_source")))
    placed = joined.withColumn("block", block).select(
        "row",
        "rank",
        "block",
        F.floor(F.col("block") / F.col("parts")).cast("long").alias("turn"),
        F.get(F.col("slots"), (F.col("block") % F.col("parts")).cast("int")).cast("long").alias("at"),
    )
    return placed, plan


def _turn_starts(spark: SparkSession, plan: _Plan) -> DataFrame:
    """(_turn, start): the number of rows before every turn of the schedule."""
    spans = spark.createDataFrame(plan.spans(), "first bigint, after bigint, before bigint, size bigint")
    # Long spans are cut in two steps, so that no row holds all their turns.
    cut = spans.withColumn("from", F.explode(F.expr(f"sequence(first, after - 1, {TURNS_CUT}L)")))
    turns = cut.withColumn("_turn", F.explode(F.expr(f"sequence(`from`, least(after, `from` + {TURNS_CUT}) - 1)")))
    return turns.select("_turn", (F.col("before") + (F.col("_turn") - F.col("first")) * F.col("size")).alias("start"))


# The same in SQL: the period by recursion, one slot a step.
SQL = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
ideal AS (SELECT source, n, {PERIOD} * (n ** {SIZE_POWER} / (SELECT sum(n ** {SIZE_POWER}) FROM sizes)) AS x FROM sizes),
shares AS (
  SELECT source, n, CAST(greatest(1, floor(x)) AS BIGINT)
         + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, source)
                     <= {PERIOD} - (SELECT sum(greatest(1, floor(x))) FROM ideal) THEN 1 ELSE 0 END AS parts
  FROM ideal),
lists AS (SELECT list(parts ORDER BY source) AS a, list(source ORDER BY source) AS s FROM shares),
period AS (
  SELECT 0 AS slot, NULL::BIGINT AS pick, list_transform(a, lambda x: 0::BIGINT) AS done FROM lists
  UNION ALL
  SELECT slot + 1, pick, list_transform(done, lambda x, i: x + CASE WHEN i = pick THEN 1 ELSE 0 END)
  FROM (
    SELECT slot, done, list_min(list_filter(list_transform(a, lambda x, i:
             CASE WHEN done[i] < x AND (done[i] * {PERIOD}) // x <= slot
                  THEN ((done[i] + 1) * {PERIOD} + x - 1) // x * 1000000 + i END), lambda v: v IS NOT NULL)) % 1000000 AS pick
    FROM period, lists WHERE slot < {PERIOD})),
slots AS (
  SELECT s[pick] AS source, slot - 1 AS pos, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS i
  FROM period, lists WHERE pick IS NOT NULL),
blocks AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rank,
         rank // {BLOCK_ROWS} AS block FROM documents),
placed AS (
  SELECT b.*, (block // parts) * {PERIOD} + pos AS slot
  FROM blocks b JOIN shares h USING (source) JOIN slots t ON t.source = b.source AND t.i = b.block % h.parts),
ends AS (
  SELECT min(((n + {BLOCK_ROWS} - 1) // {BLOCK_ROWS}) // parts * {PERIOD} + pos) AS first_end
  FROM shares h JOIN slots t ON t.source = h.source AND t.i = ((n + {BLOCK_ROWS} - 1) // {BLOCK_ROWS}) % parts)
SELECT doc_id, source, block, slot, row_number() OVER (ORDER BY slot, rank) - 1 AS position,
       slot < first_end AS on_target
FROM placed, ends
"""
