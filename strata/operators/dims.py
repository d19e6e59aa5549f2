"""Cumulative dimensions.

A cumulative dimension keeps, per entity and snapshot period, the full
history of period stats as an array of structs plus attributes read from the
latest element (class, years since last active, active flag).  Two forms:

* ``cumulate_step``      yesterday's snapshot FULL JOIN today's rows (D1, D4);
* ``cumulative_history`` every snapshot at once from the raw period rows (D2),
  used for backfills -- no driver loop over periods.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from strata.functions.columns import QUALITY_TIERS, SCORING_TIERS, tier
from strata.operators.sample import key_hash

Classify = Callable[[Column], Column]


def scoring_class(last: Column) -> Column:
    """Class from the latest season's points (strict >20/15/10, else bad)."""
    return tier(last["pts"], SCORING_TIERS, "bad")


def quality_class(last: Column) -> Column:
    """Class from the latest year's average rating (strict >8/7/6, else bad),
    tested exactly on integer hundredths: avg > t  <=>  sum_c > 100 * t * n."""
    out = None
    for thr, label in QUALITY_TIERS:
        cond = last["rating_c_sum"] > F.lit(int(thr * 100)) * last["num_films"]
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("bad")


def _rating_c() -> Column:
    return F.round(F.col("rating") * 100).cast("bigint")


def _stats_struct(period: str, stats: Sequence[str]) -> Column:
    return F.struct(*([F.col(period)] + [F.col(s) for s in stats]))


def cumulative_history(rows: DataFrame, key: str, period: str, end_period: int,
                       stats: Sequence[str], static: Sequence[str] = (),
                       classify: Classify = scoring_class,
                       class_name: str = "scoring_class",
                       history_name: str = "seasons") -> DataFrame:
    """One row per (key, period) from the key's first period to
    ``end_period``.

    ``rows`` has at most one row per (key, period).  Static attributes are the
    ``max`` per key.  The running array is a window ``collect_list`` per key
    ordered by period; NULL structs (periods without a row) are skipped, like
    ``ARRAY_REMOVE(..., NULL)``.  The window length is bounded by the number of
    periods in the spine, independent of the data volume.
    """
    firsts = rows.groupBy(key).agg(F.min(period).alias("_first"),
                                   *[F.max(c).alias(c) for c in static])
    spine = firsts.select(key, *static,
                          F.explode(F.sequence(F.col("_first"),
                                               F.lit(end_period).cast("bigint"))).alias(period))
    r = rows.select(key, F.col(period).alias("_p"), _stats_struct(period, stats).alias("_row"))
    x = spine.join(r, (spine[key] == r[key]) & (spine[period] == r["_p"]), "left") \
             .select(spine[key], *[spine[c] for c in static], spine[period], r["_row"])
    w = (Window.partitionBy(key).orderBy(period)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn(history_name, F.collect_list("_row").over(w)).drop("_row")
    last = F.element_at(F.col(history_name), -1)
    return x.select(key, *static, history_name,
                    classify(last).alias(class_name),
                    (F.col(period) - last[period]).cast("bigint").alias("years_since_last_active"),
                    (last[period] == F.col(period)).alias("is_active"),
                    F.col(period).alias("current_" + period))


def cumulate_step(prev: DataFrame, cur: DataFrame, key: str, period: str,
                  period_value: int, stats: Sequence[str], static: Sequence[str] = (),
                  classify: Classify = scoring_class, class_name: str = "scoring_class",
                  history_name: str = "seasons") -> DataFrame:
    """Snapshot of ``period_value`` from the previous snapshot and this
    period's rows.  ``prev`` has the columns of ``cumulative_history``; ``cur``
    holds rows of ``period_value`` only (one per key)."""
    cur_period = "current_" + period
    p = prev.where(F.col(cur_period) == period_value - 1).alias("p")
    c = (cur.where(F.col(period) == period_value)
            .select(key, *[F.col(s).alias("_c_" + s) for s in static],
                    _stats_struct(period, stats).alias("_row")).alias("c"))
    j = p.join(c, key, "full")
    active = F.col("_row").isNotNull()
    empty = F.array().cast(ArrayType(c.schema["_row"].dataType))
    history = F.concat(F.coalesce(F.col(history_name), empty),
                       F.when(active, F.array(F.col("_row"))).otherwise(empty))
    return j.select(
        key,
        *[F.coalesce(F.col("p." + s), F.col("_c_" + s)).alias(s) for s in static],
        history.alias(history_name),
        F.when(active, classify(F.col("_row"))).otherwise(F.col("p." + class_name)).alias(class_name),
        F.when(active, F.lit(0).cast("bigint"))
         .otherwise(F.col("p.years_since_last_active") + 1).alias("years_since_last_active"),
        active.alias("is_active"),
        F.lit(period_value).cast("bigint").alias(cur_period))


def yearly_dimension(films: DataFrame, key: str = "actorid", year: str = "year",
                     name: str = "actor") -> DataFrame:
    """D3: one row per (actor, year) with the year's films as an array of
    structs and their average rating.  A partial/final hash aggregate; the
    array per row holds one entity's films of one year."""
    return (films.groupBy(key, year)
                 .agg(F.max(name).alias(name),
                      F.array_sort(F.collect_list(F.struct("film", "votes", "rating", "filmid")))
                      .alias("films"),
                      F.avg("rating").alias("avg_rating"),
                      F.sum(_rating_c()).alias("rating_c_sum"),
                      F.count(F.lit(1)).alias("num_films")))


def actor_history(films: DataFrame, end_year: int, with_films: bool = True) -> DataFrame:
    """D4 in backfill form: per actor and year, the films so far (as yearly
    structs), quality class of the latest active year, active flag.

    ``with_films=False`` keeps only the yearly averages and counts in the
    history -- what SCD and state tracking need -- so the running array does
    not copy every film of every earlier year into every snapshot row."""
    if with_films:
        yearly = yearly_dimension(films)
        stats = ["rating_c_sum", "num_films", "films"]
    else:
        yearly = (films.groupBy("actorid", "year")
                       .agg(F.max("actor").alias("actor"),
                            F.sum(_rating_c()).alias("rating_c_sum"),
                            F.count(F.lit(1)).alias("num_films")))
        stats = ["rating_c_sum", "num_films"]
    return cumulative_history(yearly, "actorid", "year", end_year,
                              stats=stats, static=["actor"],
                              classify=quality_class, class_name="quality_class",
                              history_name="film_years")


# ------------------------------------------------------- films in chunks


def film_chunks(films: DataFrame, size: int = 1000, key: str = "actorid", year: str = "year") -> DataFrame:
    """D3/A14 in rows of bounded size: (key, year, chunk) with about ``size`` films.

    An entity-year of n films has ceil(n / size) chunks, and a film goes to one by
    the hash of its id, so no task sees all films of a hot entity-year.  The counts
    are joined by (key, year, part): each count is repeated for 16 parts of the
    films, which keeps a hot entity-year's films apart there too."""
    parts, h = 16, key_hash(["filmid"])
    counts = films.groupBy(key, year).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    x = films.withColumn("_part", F.pmod(F.xxhash64("filmid"), F.lit(parts)).cast("int")).join(counts, [key, year, "_part"])
    chunk = (h % F.ceil(F.col("_n") / size)).cast("int")
    return (x.groupBy(key, year, chunk.alias("chunk"))
             .agg(F.array_sort(F.collect_list(F.struct("film", "votes", "rating", "filmid"))).alias("films")))


def actor_references(films: DataFrame, end_year: int, size: int = 1000) -> DataFrame:
    """D4 over chunks: as ``actor_history``, but a year of the history holds its
    sums and the number of its chunks; ``film_chunks`` has the films."""
    yearly = (films.groupBy("actorid", "year")
                   .agg(F.max("actor").alias("actor"), F.sum(_rating_c()).alias("rating_c_sum"),
                        F.count(F.lit(1)).alias("num_films"))
                   .withColumn("num_chunks", F.ceil(F.col("num_films") / size).cast("bigint")))
    return cumulative_history(yearly, "actorid", "year", end_year, stats=["rating_c_sum", "num_films", "num_chunks"],
                              static=["actor"], classify=quality_class, class_name="quality_class",
                              history_name="film_years")


def films_so_far(history: DataFrame, chunks: DataFrame, period: str = "current_year") -> DataFrame:
    """The chunks that rows of ``actor_references`` refer to: (actorid, period,
    year, chunk, films)."""
    refs = history.select("actorid", period, F.explode("film_years").alias("_y"))
    refs = refs.select("actorid", period, F.col("_y.year").alias("year"),
                       F.explode(F.sequence(F.lit(0), (F.col("_y.num_chunks") - 1).cast("int"))).alias("chunk"))
    return refs.join(chunks, ["actorid", "year", "chunk"])
