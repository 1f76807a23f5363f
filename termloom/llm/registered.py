"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from .decontaminate import contaminated
from .files import prepare_session
from .fill_middle import fill_in_middle, write_frames
from .gam import classify
from .html_text import extract_text
from .licenses import recognise_licences
from .merkle import manifest_proofs
from .near_dup import near_duplicates
from .packing import pack_documents
from .quality_rules import quality_rules
from .suffix_tree import score_documents
from .token_files import read_token_files, write_token_files
from .tokens import default_tokenizer_file
from .top_k import nearest_vectors
from .warc import mark_revisits, page_of_record_id, read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_hash(doc_id: str = "doc_id") -> Column:
    """The fixed hash that deals documents into folds; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0))


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Write every page as a WARC record, read the archives back."""
    archive = new_path(spark, "warc")
    manifest = write_warc(mark_revisits(table(spark, folder, "pages")), archive)
    records = read_warc(manifest, archive, with_payload=False)
    return records.select(
        page_of_record_id(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of_record_id(F.col("refers_to")).alias("refers_to"),
    )


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Score the quality of every document, learning from three of four folds."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return classify(docs, labels, held_out=id_hash() % 4 == 2)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Find every document that holds a copy of a benchmark item, exact or edited."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pack all documents into windows of 2048 tokens."""
    return pack_documents(table(spark, folder, "documents"), default_tokenizer_file(), added_tokens=True)


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Judge every document by counts and compression bands."""
    return quality_rules(table(spark, folder, "documents"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Group near-duplicate documents and keep one of each group."""
    return near_duplicates(table(spark, folder, "documents"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Write the ids of all documents as plane-split shards, read them back."""
    shards = new_path(spark, "token-ids")
    manifest = write_token_files(table(spark, folder, "documents"), shards, default_tokenizer_file(), added_tokens=True)
    found = read_token_files(manifest, shards)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Extract the main text of every page."""
    return extract_text(table(spark, folder, "pages"))


def op9_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Recognise the licences of every document by sentence rules."""
    return recognise_licences(table(spark, folder, "documents"))


def op10_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Score every document with a suffix tree learnt from six of seven folds."""
    return score_documents(table(spark, folder, "documents"), held_out=id_hash() % 7 == 2)


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Store every text as seekable frames, cut it for filling in the middle, rebuild it from the result."""
    frames = new_path(spark, "frames")
    index = write_frames(table(spark, folder, "documents"), frames)
    return fill_in_middle(index, frames, texts=False)


def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of all vectors for every 20th of them."""
    return nearest_vectors(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Hash every document into a tree per source and one over all, and check each by its proof."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return manifest_proofs(table(spark, folder, "documents"), tampered)


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_token_files": op7_token_files,
    "op8_html_text": op8_html_text,
    "op9_licences": op9_licences,
    "op10_suffix_tree": op10_suffix_tree,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_exact_top_k": op12_exact_top_k,
    "op13_merkle_manifest": op13_merkle_manifest,
}
