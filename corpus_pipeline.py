"""Training-corpus pipeline: stages over ``documents``, each on all rows that
its predecessor kept, written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import pii
from strata.llm.common import documents, prepare, use_checkpoint_dir
from strata.llm.decontaminate import contaminated
from strata.llm.ngram_join import near_duplicates
from strata.llm.packing import pack
from strata.llm.quality import scored
from strata.llm.queries import TOKENIZER

ORACLE_SQL = None    # a trained model and similarity joins cannot be expressed; see tests/llm


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    prepare(spark)
    return scored(docs, _table(spark, sf_dir, "labels")).where("predicted = 1").select(*docs.columns)


KEY = "__key"


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows named by id (null last) and text, never null: decisions depend on no
    more, so rows that share a key share a decision, whatever their ids."""
    return docs.withColumn(KEY, F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id",
                                         F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest doc_id (null
    last), then text digest.  Documents without words are in no group and stay."""
    prepare(spark)
    wordless = F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    first = near_duplicates(_keyed(docs), KEY).where(F.col(KEY) == F.col("component_id")).select(KEY).distinct()
    kept = _keyed(docs.where(~wordless)).dropDuplicates([KEY]).join(first, KEY, "left_semi").select(*docs.columns)
    return kept.unionByName(docs.where(wordless))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    prepare(spark)
    held = contaminated(_keyed(docs), _table(spark, sf_dir, "benchmark"), KEY).select(KEY).distinct()
    return _keyed(docs).join(held, KEY, "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows."""
    prepare(spark)
    found = pii.find(docs).withColumn("text", pii.masked())
    return found.withColumn("n_chars", F.when(F.size("spans") > 0, F.char_length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    prepare(spark)
    return pack(docs, TOKENIZER).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                        "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", quality),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over the documents of ``sf_dir``."""
    base = f"{use_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{k}-{name}")
            docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
