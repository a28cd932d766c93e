"""A training corpus from documents: language ID, near duplicates, benchmark decontamination, mixing, token store.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents; the last returns a row for each document of the store."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import common, decontam, langid, mixing, near_dedup, token_store

#: A document whose score is lower is rejected, as is one without any letter. Texts of languages that weren't learned score far lower; short
#: texts of learned ones that hold a key or a number score 0.38 and more.
LEAST_SCORE = 0.25
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """fn, whose scratch folders live until the next stage is called: by then its result is written. Folders of other calls stay."""

    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release(spark, "pipeline")
        with common.owned("pipeline"):
            return fn(spark, docs, sf_dir)

    return run


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents that aren't held out; those without a letter or without a likely language go.

    A null or empty text has no letter and goes; a null lang is only not learned from. Rows are judged one by one, so repeated rows
    share their fate, and a null doc_id counts as one that isn't held out. Without a learned language all go. No documents give no rows; other columns
    than those of documents are left out, whatever their names."""
    model = langid.train(docs.where(~langid.held_out()).select("doc_id", "text", "lang"))
    judged = langid.identify(docs.select(*COLUMNS), model)
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest doc_id, a null one last. Equal ids, or none, don't make
    rows one document: rows link by their texts. Texts without words link with nothing; of equal rows of them one stays."""
    # Rows get a key of their own, which holds because it is written.
    rows = common.staged(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), f"{common.scratch(spark, 'rows')}/rows")
    found = near_dedup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id", "n_shingles")
    # Which row of a group stays follows from its values, not from how rows were dealt.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"), F.xxhash64("lang", "source", "n_chars").alias("x"), "row").alias("rank")
    ranked = rows.select("row", rank, "doc_id", F.when(~F.col("text").rlike(common.WORD), F.col("text")).alias("blank")).hint("merge").join(found, "row")
    empty = F.col("n_shingles") == 0
    group = [F.when(~empty, F.col("component_id")).alias("c"), F.when(empty, F.col("doc_id")).alias("d"), F.when(empty, F.col("blank")).alias("b")]
    kept = ranked.groupBy(*group).agg(F.min("rank").alias("rank")).select(F.col("rank.row").alias("row"))
    return rows.join(kept.hint("merge"), "row", "left_semi").select(*COLUMNS)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go. A null or empty text holds none and stays, as does all if the benchmark is empty; repeated rows
    are judged one by one. No documents give no rows; other columns than those of documents are left out, whatever their names."""
    flagged = decontam.flag(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return flagged.where(F.size("item_ids") == 0).select(*COLUMNS)


@_stage
def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportions 3, 1, 2 over 150 % of all words; a document stands in the result as often as the mix takes it,
    which may be not at all. A null source is a source of its own, a null text has no words and goes with its source's share; rows of one doc_id are taken together.
    No documents give no rows; other columns than those of documents are left out, whatever their names."""
    return mixing.mixed(docs.select(*COLUMNS), weights=(3, 1, 2), epochs=1.5, cap=2.0).select(*COLUMNS)


@_stage
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document (each copy in the mix) of a token store, read back and verified.

    A null or empty text is its end id alone; a null doc_id comes first; repeated rows are documents of their own. No documents give no rows."""
    return token_store.encode_documents(docs, end_id=0, remembered=150_000)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_weights),
    ("token_output", token_output),
]

#: Language models and tokenizers aren't expressible in SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root, before = f"{common.scratch_root(spark)}/corvane-pipeline-{common.unique()}", None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        docs = common.staged(out, f"{root}/{k}-{name}")
        if before:
            common.delete(spark, before)
        before = f"{root}/{k}-{name}"
    return docs
