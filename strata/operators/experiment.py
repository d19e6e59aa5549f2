"""Experiment assignment and readout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.functions.columns import bucket_of


def assign_variant(units: DataFrame, experiment: str, cells: Sequence[tuple[str, float]],
                   unit: str = "user_id", buckets: int = 10000) -> DataFrame:
    """Deterministic assignment.  The unit's bucket (md5 of
    'experiment:unit', 0..buckets-1) falls into the cell whose cumulative
    weight range contains it; the same unit always gets the same cell and
    no state is kept.  A per-row expression: no shuffle."""
    total = float(sum(w for _, w in cells))
    b = bucket_of(F.lit(experiment), F.col(unit), buckets)
    cell: Column | None = None
    acc = 0.0
    for i, (name, w) in enumerate(cells):
        acc += w
        cut = int(round(acc / total * buckets))
        if i == len(cells) - 1:
            cell = F.lit(name) if cell is None else cell.otherwise(F.lit(name))
        else:
            cell = F.when(b < cut, F.lit(name)) if cell is None else cell.when(b < cut, F.lit(name))
    return units.select(unit, b.alias("bucket"), cell.alias("cell"),
                        F.lit(experiment).alias("experiment"))


def experiment_readout(assignments: DataFrame, conversions: DataFrame, control: str,
                       unit: str = "user_id") -> DataFrame:
    """Per cell: units, converters, conversion rate, lift against the
    control cell and the two-proportion z statistic against it.  The
    converter set is reduced to distinct units before the join; the per-cell
    table (a handful of rows) carries the control's numbers via a window."""
    conv = conversions.select(unit).distinct().withColumn("_conv", F.lit(1))
    j = assignments.join(conv, unit, "left")
    per = j.groupBy("cell").agg(F.count(F.lit(1)).alias("units"),
                                F.count("_conv").alias("converters"))
    per = per.withColumn("rate", F.col("converters") / F.col("units"))
    allw = Window.partitionBy(F.lit(1))
    is_ctl = F.col("cell") == control
    x = (per.withColumn("_cu", F.max(F.when(is_ctl, F.col("units"))).over(allw))
            .withColumn("_cc", F.max(F.when(is_ctl, F.col("converters"))).over(allw))
            .withColumn("_cr", F.max(F.when(is_ctl, F.col("rate"))).over(allw)))
    pooled = (F.col("converters") + F.col("_cc")) / (F.col("units") + F.col("_cu"))
    se = F.sqrt(pooled * (1 - pooled) * (1 / F.col("units") + 1 / F.col("_cu")))
    return x.select("cell", "units", "converters", "rate",
                    (F.col("rate") / F.col("_cr") - 1).alias("lift"),
                    F.when(se > 0, (F.col("rate") - F.col("_cr")) / se).alias("z"))
