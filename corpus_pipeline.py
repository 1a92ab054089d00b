"""Cleans the documents table in stages; each stage works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moodtide.llm import bpe, decontaminate, langid, simhash, substrings
from moodtide.llm.frames import materialize, read_table, row_of
from moodtide.llm.queries import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# A text keeps its place if one language has this mean probability over its bytes; a share
# for each of two languages is enough, noise in no known language is not.
MIN_SCORE = 0.35


def beside(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one, so that none can clash with an operator's; ``whole`` undoes it."""
    return docs.select(row_of(docs.drop("text")).alias("row"), "doc_id", "text")


def whole(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of ``docs`` in their order, those in ``new`` replaced."""
    own = {"text": F.col("text")} | new
    return [own.get(c, F.col("row")[c]).alias(c) for c in docs.columns]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; ``und`` and those it is not sure of go."""
    marked = langid.identify(beside(docs), langid.learn(docs))
    return marked.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(*whole(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return simhash.keep_one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat; a text that has none stays as it is."""
    done, cut = substrings.dedup_substrings(beside(docs)), F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("row")["n_chars"])
    return done.select(*whole(docs, text=text, n_chars=n_chars))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor one with a few words changed."""
    return decontaminate.without_benchmarks(docs, read_table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with token_ids, their number, and whether decoding gives the text back."""
    docs = docs.drop("token_ids", "n_tokens", "round_trip")
    back = bpe.encode(beside(docs), vocabulary_path(), ids="token_ids", decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return back.select(*whole(docs), "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("simhash_near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", no_benchmark),
    ("bpe_encoding", encoded),
]

# No stage but the third can be said in SQL; tests/llm/test_pipeline.py compares all with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
