"""Scalar expressions (X*, F7, F8, F13-F15, F21).  All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

__all__ = [
    "col_", "tier", "normalize_referrer", "first_last_ratio",
    "fill_unknown", "day_range", "as_date", "properties_map", "bucket_of",
    "bits_of_dates", "bit_count_masked", "DEFAULT_REFERRER_RULES",
    "SCORING_TIERS", "QUALITY_TIERS", "SKILL_TIERS", "RATING_TIERS", "array_text",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Tier ladders of the reference's CASE expressions.
SCORING_TIERS = [(20, "star"), (15, "good"), (10, "average")]          # strict >, else bad
QUALITY_TIERS = [(8, "star"), (7, "good"), (6, "average")]             # strict >, else bad
SKILL_TIERS = [(20, "Elite"), (10, "Good")]                            # strict >, else Beginner
RATING_TIERS = [(8, "Excellent"), (7, "Good"), (6, "Average"), (5, "Below Average")]  # >=, else Poor


def tier(c, ladder: Sequence[tuple[float, str]], default: str,
         inclusive: bool = False) -> Column:
    """CASE ladder, first matching threshold wins (tested top-down)."""
    c = col_(c)
    out = None
    for thr, label in ladder:
        cond = (c >= thr) if inclusive else (c > thr)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


# Ordered LIKE rules of the referrer normalisation (F8).
DEFAULT_REFERRER_RULES = [
    ("%linkedin%", "Linkedin"),
    ("%t.co%", "Twitter"),
    ("%google%", "Google"),
    ("%lnkd%", "Linkedin"),
]


def normalize_referrer(c, on_site_patterns: Sequence[str] = (),
                       rules: Sequence[tuple[str, str]] = DEFAULT_REFERRER_RULES) -> Column:
    """F8: ordered LIKE rules, then the site's own hosts as 'On Site', else as is."""
    c = col_(c)
    all_rules = list(rules) + [(p, "On Site") for p in on_site_patterns]
    out = None
    for pat, label in all_rules:
        cond = c.like(pat)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(c) if out is not None else c


def first_last_ratio(arr, field: str) -> Column:
    """last element's field / first element's field; a zero first gives 1."""
    a = col_(arr)
    first = F.element_at(a, 1)[field]
    last = F.element_at(a, -1)[field]
    return F.when(first == 0, F.lit(1.0)).otherwise(last / first)


def fill_unknown(c, value: str = "unknown") -> Column:
    """F9."""
    return F.coalesce(col_(c), F.lit(value))


def as_date(ds) -> Column:
    if isinstance(ds, Column):
        return ds
    if isinstance(ds, (_dt.date, _dt.datetime)):
        ds = ds.isoformat()[:10]
    return F.lit(ds).cast("date")


def day_range(ts, start, days: int = 1) -> Column:
    """``start <= ts < start + days`` on a timestamp column.  A half-open
    range on the raw column (not ``to_date(ts) = ds``) keeps the predicate
    pushable to the parquet scan and prunable on partitioned input."""
    s = as_date(start)
    t = col_(ts)
    lo = s.cast("timestamp_ntz")
    hi = F.date_add(s, days).cast("timestamp_ntz")
    return (t >= lo) & (t < hi)


def properties_map(pairs: Sequence[tuple[str, object]]) -> Column:
    """String map of named properties (values cast to string)."""
    args = []
    for k, v in pairs:
        args += [F.lit(k), col_(v).cast("string")]
    return F.create_map(*args)


def bucket_of(experiment, unit, buckets: int = 10000) -> Column:
    """Deterministic assignment bucket in [0, buckets): the first 32 bits of
    md5('experiment:unit') read as an unsigned integer, modulo ``buckets``.
    Same value in any engine with md5 (no engine-specific hash)."""
    key = F.concat(col_(experiment).cast("string"), F.lit(":"), col_(unit).cast("string"))
    hi32 = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return hi32 % buckets


def bits_of_dates(dates, snapshot, width: int = 32) -> Column:
    """A date array -> bitmap (BIGINT) of the ``width`` days ending at
    ``snapshot``; the snapshot day is bit ``width-1`` (most significant), the day
    before bit ``width-2`` and so on.  Dates outside the window are ignored."""
    snap = as_date(snapshot)
    return F.aggregate(
        col_(dates), F.lit(0).cast("bigint"),
        lambda acc, d: F.when(
            (F.datediff(snap, d) >= 0) & (F.datediff(snap, d) < width),
            acc.bitwiseOR(F.pow(F.lit(2.0), (width - 1) - F.datediff(snap, d)).cast("bigint")),
        ).otherwise(acc))


def bit_count_masked(bits, mask: int) -> Column:
    return F.bit_count(col_(bits).bitwiseAND(F.lit(mask).cast("bigint"))).cast("bigint")


def array_text(arr, null_text: str = "null", sep: str = ",") -> Column:
    """Array -> 'a,b,c' text (NULL elements spelled out) for oracle comparison."""
    return F.array_join(F.transform(col_(arr), lambda x: F.coalesce(x.cast("string"), F.lit(null_text))), sep)
