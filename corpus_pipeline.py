"""Corpus pipeline over ``documents``: language ID, near-duplicates, mixing, SentencePiece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm.common import read_table, written
from clickpulse.llm.langid import known_language
from clickpulse.llm.minhash import one_of_each_group
from clickpulse.llm.mixing import mix_documents
from clickpulse.llm.pieces import MODEL_PATH, encode, read_vocabulary

ORACLE_SQL = None  # the stages cannot be written in SQL; tests/llm compares them with brute force


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text has a language; texts that are null or have no letters go."""
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more): the smallest id."""
    return one_of_each_group(docs, shingle_words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it (0, 1 or 2 times)."""
    return mix_documents(docs, read_table(spark, sf_dir, "labels"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces and the piece ids of the whole text."""
    rows = encode(docs.select("doc_id", "lang", "source", "text"), read_vocabulary(MODEL_PATH))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("language ID", language),
    ("near-duplicates", near_duplicates),
    ("mixing", mix),
    ("SentencePiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
