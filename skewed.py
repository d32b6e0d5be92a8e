"""Write a larger, skewed table of events for timing: one user has a third of all rows.

    python skewed.py ROWS FOLDER
    BENCH_SF_DIR=FOLDER BENCH_QUERIES=sliding_count,user_profile python bench.py

FOLDER gets `events.parquet` with the columns of the given table; the rows follow
from their numbers, so every run writes the same.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybrook.session import build_session

KINDS = ["click", "view", "purchase", "signup", "error"]


def main(rows: int, folder: str) -> None:
    spark = build_session("skewed", "local[*]", spark__ui__enabled="false")

    def draw(seed: int, below: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(below))

    user = F.when(draw(1, 3) == 0, 0).otherwise(draw(2, 100_000))
    micros = F.lit(1_704_067_200_000_000) + draw(3, 30 * 86_400) * 1_000_000 + draw(4, 1_000_000)
    events = spark.range(rows).select(
        F.col("id").alias("event_id"),
        F.timestamp_micros(micros).cast("timestamp_ntz").alias("ts"),
        user.cast("bigint").alias("user_id"),
        F.element_at(F.array(*[F.lit(k) for k in KINDS]), (draw(5, len(KINDS)) + 1).cast("int")).alias("event_type"),
        (draw(6, 10_000) / 100).alias("value"),
        F.to_json(F.struct(draw(7, 100).alias("k"))).alias("props"),
    )
    events.write.mode("overwrite").parquet(f"{folder}/events.parquet")


if __name__ == "__main__":
    main(int(sys.argv[1]), sys.argv[2].rstrip("/"))
