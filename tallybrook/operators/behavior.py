"""User-preference profiles from behaviour messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook import constants as C
from tallybrook.functions import text as tf
from tallybrook.operators.groups import concat_groups


def preferences(
    messages: DataFrame, text: str = "value", kept: str = C.KEPT_BEHAVIOR
) -> DataFrame:
    """(user_id, info_type), one row per type of every valid message.

    A message `user,behaviour,type[,type...]` is valid when it is not blank and
    its behaviour is the kept one. Empty types give no row.
    """
    split = messages.where(tf.non_blank(F.col(text))).select(
        tf.once(tf.fields(F.col(text), ",")).alias("_f")
    )
    valid = split.where(F.get("_f", F.lit(1)) == kept)
    types = F.slice("_f", F.lit(3), F.greatest(F.size("_f") - 2, F.lit(0)))
    return valid.select(
        F.get("_f", F.lit(0)).alias("user_id"), F.explode(types).alias("info_type")
    ).where(F.col("info_type") != "")


def preference_counts(prefs: DataFrame) -> DataFrame:
    """(user_id, info_type, n)."""
    return prefs.groupBy("user_id", "info_type").agg(F.count(F.lit(1)).alias("n"))


def profiles(counts: DataFrame, parts: int = 1) -> DataFrame:
    """Per user, `type:n` joined with commas, sorted.

    The counting before this has already reduced a user to one row per type, so
    one part per user holds as many entries as there are types. Where there are
    more types than fit in a row, ask for more parts.
    """
    shown = counts.select(
        "user_id", "info_type", F.concat_ws(":", "info_type", "n").alias("_shown")
    )
    joined = concat_groups(shown, ["user_id"], "_shown", F.xxhash64("info_type"), ",", parts=parts)
    return joined.withColumnsRenamed({"n_values": "n_types", "joined": "profile"})


def user_profiles(messages: DataFrame, text: str = "value") -> DataFrame:
    return profiles(preference_counts(preferences(messages, text)))
