"""From raw documents to packed training windows: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.decontaminate import contaminated
from termloom.llm.files import prepare_session
from termloom.llm.gam import apply_model, features, train
from termloom.llm.near_dup import near_duplicates
from termloom.llm.packing import pack_documents
from termloom.llm.quality_rules import passing
from termloom.llm.registered import id_hash, table
from termloom.llm.tokens import default_tokenizer_file
from termloom.session import new_path, stage


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose id is not among the rejected ones; rows with a null id stay."""
    return docs.join(stage(rejected.select("doc_id").dropna().distinct(), "rejected"), "doc_id", "left_anti").select(
        docs.columns
    )


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that keep to the quality rules."""
    prepare_session(spark)
    return passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, learnt from the labelled ones among them, takes for good.

    The same fold as in the registered query is held out. Rows that share an id go together when one is rejected.
    """
    prepare_session(spark)
    found = stage(features(docs), "features")
    scored = apply_model(found, train(found, table(spark, sf_dir, "labels"), held_out=id_hash() % 4 == 2))
    return _without(docs, scored.filter("predicted = 0"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; empty ones are in no group."""
    prepare_session(spark)
    return _without(docs, near_duplicates(docs).filter(~F.col("kept")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return _without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens."""
    prepare_session(spark)
    return pack_documents(docs, default_tokenizer_file(), added_tokens=True)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Compression, boosting, signatures, alignment and tokenization are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written below the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
