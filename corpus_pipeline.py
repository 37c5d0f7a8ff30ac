"""From raw documents to token ids: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import bpe, jaccard, language, mixing, substring
from ledgerloom.llm.common import documents, fresh, stored
from ledgerloom.llm.queries import TOKENIZERS, VOCABULARY

#: Columns of the given tables; others pass through all stages but the last.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def passing(docs: DataFrame, added: tuple[str, ...], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of `docs` out of `step`, also those that have the name of a column it adds."""
    aside = {c: fresh(docs, f"{c}_") for c in docs.columns if c.lower() in added}
    done = step(docs.withColumnsRenamed(aside))
    return done.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages; those without a letter or between two languages go."""
    model = language.fit(docs)
    sure = (F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")
    return passing(docs, ("lang_pred", "score", "ambiguous"), lambda own: language.predict(own, model).filter(sure))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose word 5-grams agree by 75 percent or more."""
    return passing(docs, (), jaccard.keep_one)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words in windows of 35 words that occur elsewhere too; a text of nothing else goes."""
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))

    def step(own: DataFrame) -> DataFrame:
        cleaned = substring.remove_repeats(own).filter("n_removed = 0 or n_removed < n_words")
        return cleaned.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))

    return passing(docs, ("n_words", "n_removed", "kept_text"), step)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources with the same share of characters, copies drawn per document, in random order."""
    return passing(docs, ("copy_no", "n_copies", "shuffle_key"), mixing.mix)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy of every document, and what they decode to."""
    done = bpe.tokenize(docs, os.path.join(TOKENIZERS, VOCABULARY))
    return done.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("source_mixing", mix_sources),
    ("bpe", encode),
]

#: SQL has no counterpart of these stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
