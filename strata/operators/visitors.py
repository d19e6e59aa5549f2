"""A2: distinct counts that add up over days.

Per (keys, day, bucket of 32,768 ids) a bitmap of the ids seen.  Bitmaps are
aggregates with map-side partial bitmaps, so a hot key is merged before the
shuffle; a longer period is the OR of its days, and a count is the sum of set bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def daily_states(events: DataFrame, keys: Sequence[str], user: str = "user_id", ts: str = "event_time") -> DataFrame:
    """keys, day, bucket, bitmap; ``user`` is an integer, rows without it or
    without a time count nothing.  At most 4 kB per row."""
    seen = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    return (seen.groupBy(*keys, F.to_date(F.col(ts)).alias("day"), F.bitmap_bucket_number(F.col(user)).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(user))).alias("bitmap")))


def merge_states(*states: DataFrame) -> DataFrame:
    """States of the same keys and day, from several loads, as one."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    by = [c for c in out.columns if c != "bitmap"]
    return out.groupBy(*by).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def unique_over(states: DataFrame, keys: Sequence[str], period: Column, name: str = "period") -> DataFrame:
    """Distinct users per keys and period of days, from daily states alone."""
    merged = states.groupBy(*keys, period.alias(name), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*keys, name).agg(F.sum(F.bitmap_count("bitmap")).alias("unique_users"))
