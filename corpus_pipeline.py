"""Pipeline over ``documents``: quality rules, language, near duplicates,
personal data, packing.

Each stage works on all that the stage before kept, which is written as
Parquet and read again.  All stages but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import language_id
from kpiloom.llm.common import on_executors, read, stored
from kpiloom.llm.ngram_jaccard import keep_one
from kpiloom.llm.packing import best_fit_pack
from kpiloom.llm.quality_rules import DEFAULT_POLICY, apply_policy, ledger
from kpiloom.llm.queries import SURROGATE_KEY, tokenizer_file, word_ids
from kpiloom.llm.surrogates import replace_entities

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose language is less certain than this goes.
MIN_LANGUAGE_SCORE = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every rule of the policy accepts."""
    led = apply_policy(ledger(docs, carry=tuple(COLUMNS)), DEFAULT_POLICY)
    return led.where("kept").select(*[f"row.{c}" for c in COLUMNS])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, told with some certainty; it fills in ``lang``
    where that is missing.  The model learns from the rows that have one.
    Without any such row nothing can be told and all documents with a letter
    are kept."""
    on_executors(spark)
    model = language_id.train(docs)
    judged = language_id.predict(docs, model, carry=tuple(F.col(c) for c in COLUMNS))
    if not model.languages:
        return judged.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    sure = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return judged.where(sure).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    on_executors(spark)
    return keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; ``n_chars`` follows."""
    safe = replace_entities(docs.select(*COLUMNS), SURROGATE_KEY)
    return safe.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2,048 tokens."""
    on_executors(spark)
    return best_fit_pack(docs, word_ids(tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("best_fit_packing", packing_stage),
]
#: Language, components and packing are not expressed in SQL: tests/llm holds
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
