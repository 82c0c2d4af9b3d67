"""The corpus pipeline: filter, clean, deduplicate, sanitise and pack ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import line_dedup as lines
from barline.llm import ngram_join, packing, pii, quality
from barline.llm.queries import tokenizer_file
from barline.llm.shared import documents, materialise


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one, so that their names can't clash with an operator's."""
    return docs.select("doc_id", "text", F.struct(F.lit(1).alias("_one"), *(c for c in docs.columns if c not in ("doc_id", "text"))).alias("_row"))


def _restored(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*(c if c in ("doc_id", "text") else F.col("_row")[c].alias(c) for c in columns))


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with n_chars of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps; it includes the base rules."""
    return _restored(quality.apply_policy(quality.ledger(_carried(docs))).where("kept"), docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go; so does a document that consisted of nothing else."""
    out = lines.drop_recurring_lines(_carried(docs))
    left = (F.col("n_dropped") == 0) | (F.trim(F.translate("text", "\n\t\r", "   ")) != "")
    return _recounted(_restored(out.where(left), docs.columns), docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    gone = ngram_join.ngram_links(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, disclosing terms are generalised or removed."""
    return _recounted(_restored(pii.sanitise(_carried(docs)), docs.columns), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document with sequence and offset."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: MinHash candidates, disclosure statistics and tokenising have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
