"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickpulse.llm import sql
from clickpulse.llm.alignment import alignment_report
from clickpulse.llm.common import read_table
from clickpulse.llm.crossentropy import lm_report
from clickpulse.llm.langid import language_report
from clickpulse.llm.lexical import search_items
from clickpulse.llm.lzprint import fingerprint_report
from clickpulse.llm.minhash import near_duplicate_report
from clickpulse.llm.mixing import mix_report
from clickpulse.llm.pieces import piece_report
from clickpulse.llm.pivots import search_report
from clickpulse.llm.quotes import reply_ordered
from clickpulse.llm.simhash import simhash_report
from clickpulse.llm.tokencounts import token_report
from clickpulse.llm.urlfilter import url_report


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_report(read_table(spark, sf_dir, "embeddings"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_report(read_table(spark, sf_dir, "pages"))


def op4_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(read_table(spark, sf_dir, "conversations"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(read_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(read_table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(read_table(spark, sf_dir, "documents"))


def op8_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(read_table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_report(read_table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(read_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_top_k": op2_top_k,
        "op3_url_filter": op3_url_filter,
        "op4_quotation_links": op4_quotation_links,
        "op5_language_id": op5_language_id,
        "op6_token_counts": op6_token_counts,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_lz_fingerprint": op8_lz_fingerprint,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_minhash": op10_minhash,
        "op11_simhash": op11_simhash,
        "op12_lexical_search": op12_lexical_search,
        "op13_alignment": op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": sql.OP1, "op2_top_k": sql.OP2, "op3_url_filter": sql.OP3, "op10_minhash": sql.OP10, "op12_lexical_search": sql.OP12}
