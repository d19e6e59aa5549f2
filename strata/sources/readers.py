"""Batch readers (S1, S2) and the driver parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """Header CSV.  With a schema nothing is inferred (one pass, typed);
    without one every column is read as a string, never inferred, so a job does
    not pay an extra scan of the input."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table or temp view by name."""
    return spark.table(name)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Expose DataFrames to ``spark.sql`` under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


class Tables:
    """Lazy accessor for the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_parquet_table(self.spark, self.sf_dir, name)
