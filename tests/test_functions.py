"""Scalar helpers and function registration."""

import pandas as pd
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.functions.udf import register_builtin_functions, register_pandas_function
from strata.operators import experiment


def test_sql_function_is_inlined(spark):
    register_builtin_functions(spark)
    df = spark.sql("SELECT ip_to_long('10.1.2.3') AS v, ip_to_long('bad') AS w")
    assert tuple(df.collect()[0]) == (167838211, None)
    plan = spark.sql("SELECT ip_to_long(CAST(id AS STRING)) FROM range(3)")._jdf \
        .queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_pandas_function(spark):
    register_pandas_function(spark, "times_two", lambda s: s * 2, "long")
    assert spark.sql("SELECT times_two(id) AS v FROM range(3)").collect()[2].v == 4


def test_tiers_are_strict_or_inclusive(spark):
    df = spark.createDataFrame([(20.0,), (20.5,), (8.0,)], "x double")
    got = [r[0] for r in df.select(C.tier("x", C.SCORING_TIERS, "bad")).collect()]
    assert got == ["good", "star", "bad"]
    got = [r[0] for r in df.select(C.tier("x", C.RATING_TIERS, "Poor", inclusive=True)).collect()]
    assert got == ["Excellent", "Excellent", "Excellent"]


def test_bits_of_dates_snapshot_is_top_bit(spark):
    df = spark.createDataFrame([(["2024-01-30", "2024-01-29", "2023-12-01"],)], "d array<string>")
    df = df.select(F.transform("d", lambda x: x.cast("date")).alias("d"))
    bits = df.select(C.bits_of_dates("d", "2024-01-30").alias("b")).collect()[0].b
    assert bits == (1 << 31) | (1 << 30)


def test_referrer_rules_in_order(spark):
    df = spark.createDataFrame([("https://lnkd.in/x",), ("https://www.linkedin.com",),
                                ("https://t.co/z",), ("https://me.example/a",), (None,)], "r string")
    got = [r[0] for r in df.select(C.normalize_referrer("r", ["%me.example%"])).collect()]
    assert got == ["Linkedin", "Linkedin", "Twitter", "On Site", None]


def test_assignment_is_deterministic_and_balanced(spark):
    users = spark.range(0, 10000).withColumnRenamed("id", "user_id")
    a = experiment.assign_variant(users, "exp", [("control", 50), ("treatment", 50)])
    b = experiment.assign_variant(users, "exp", [("control", 50), ("treatment", 50)])
    assert a.exceptAll(b).count() == 0
    share = a.where(F.col("cell") == "control").count() / 10000
    assert abs(share - 0.5) < 0.02
