"""Corpus pipeline: five stages from raw documents to a mix of sources.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the docs of
the next.  A stage judges all rows that its predecessor kept, and only them.  All but the last return the columns of the
documents; the last returns how much of each document the mix takes.

Nulls: a null text has no letter and leaves in the first stage; a null doc_id counts as the largest; other columns may be
null.  Repeated rows are near duplicates of each other, so one stays.  Very long texts are judged and cut whole.  Further
columns go through the first four stages unchanged, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolewise.llm import (op2_ngram_jaccard_join as jaccard, op4_decontamination as benchmark, op6_suffix_array_dedup as suffixes,
                          op7_language_id as language, op8_source_mix as mixing)
from rolewise.llm.stage import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
UNIFORM_BITS = 8.0          # a text that takes more bits a byte than uniform coding fits no language


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those that every language codes worse than uniform bytes."""
    model = language.train(docs.select("doc_id", "lang", "text").filter(~language.held_out()))
    judged = language.identify(docs, model)
    return judged.filter((F.col("lang_pred") != "und") & (F.col("bits") <= UNIFORM_BITS)).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document of the smallest doc_id stays."""
    return jaccard.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated byte strings are cut out; a character that a cut splits goes too, as do documents with nothing left."""
    names = docs.columns
    cut = suffixes.suffix_array_dedup(docs, carry=tuple(names)).withColumn("kept_text", suffixes.whole_characters(F.col("kept")))
    text = F.when(F.col("n_removed") == 0, F.col(f"_{names.index('text')}")).otherwise(
        F.col("kept_text"))
    cut = cut.filter((F.col("n_removed") == 0) | (F.length("kept") > 0)).withColumn("_text", text)
    new = {"text": F.col("_text"), "n_chars": F.when(F.col("n_removed") == 0, F.col(f"_{names.index('n_chars')}")).otherwise(
        F.length("_text")).cast(docs.schema["n_chars"].dataType) if "n_chars" in names else None}
    return cut.select(*[(new[c] if c in new else F.col(f"_{i}")).alias(c) for i, c in enumerate(names)])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return benchmark.clean_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.taken(docs)


def carrying(stage):
    """The stage with all further columns of docs kept: under neutral names, so none meets a column that a stage makes."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        neutral = [c if c in COLUMNS else f"_extra{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*neutral), sf_dir).toDF(*docs.columns)
    return run_stage


STAGES = [
    ("language_id", carrying(keep_known_languages)),
    ("near_duplicates", carrying(keep_one_of_near_duplicates)),
    ("repeated_passages", carrying(cut_repeated_passages)),
    ("benchmark_decontamination", carrying(drop_contaminated)),
    ("source_mix", mix_sources),
]

ORACLE_SQL = None           # language ID is not expressible in SQL; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs
