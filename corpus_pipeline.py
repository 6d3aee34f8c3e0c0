"""From raw documents to packed training sequences, stage by stage.

Each stage works on all that the stage before kept, which is written as Parquet and read again. All but the
last return the columns of ``documents``. Nulls, empty texts, repeated rows, empty tables and more columns are
handled as the stages' operators say: a null text passes until it is packed as an empty document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.llm import decontaminate, line_dedup, packing, simhash, toxicity
from lapframe.llm.ship import ship
from lapframe.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labels, does not call toxic."""
    ship(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).filter("predicted = 0").select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the line blocks that they share with earlier ones."""
    ship(spark)
    cut = line_dedup.dedup_lines(docs).select("row.*")
    counted = F.length("text").cast(dict(docs.dtypes)["n_chars"]) if "n_chars" in docs.columns else None
    return cut if counted is None else cut.withColumn("n_chars", counted)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near duplicates."""
    ship(spark)
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", dedup_documents),
    ("decontaminate", drop_benchmark),
    ("packing", pack),
]

#: The stages are learned, aligned and packed; SQL cannot say that. Tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
