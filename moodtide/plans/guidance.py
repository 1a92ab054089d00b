"""Guidance corpus build: crawl the cache, chunk, publish."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame

from moodtide.operators import corpus
from moodtide.session import materialize
from moodtide.schemas import CHUNKS, DOCUMENTS
from moodtide.sources import layers

DOCUMENTS_TABLE, CHUNKS_TABLE = "documents", "chunks"


def build(
    seeds: DataFrame,
    payloads: DataFrame,
    root: str,
    allowed: Iterable[str] | DataFrame = corpus.ALLOWED_HOSTS,
    chunk_words: int = corpus.CHUNK_WORDS,
    overlap_words: int = corpus.OVERLAP_WORDS,
    retrieved_at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(report, failures); an empty build leaves the published corpus as it was.

    Documents and chunks are one version. Each is written once, chunks are cut
    from the documents written, and the report counts what was published.
    """
    spark = seeds.sparkSession
    # Cleaning is the costly step and feeds documents, failures and the report.
    crawled = materialize(corpus.crawl(seeds, payloads, allowed, retrieved_at), "crawled")
    version = layers.next_version(spark, root)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{version}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{version}/{name}")

    docs = written(corpus.documents(crawled), DOCUMENTS_TABLE)
    if docs.isEmpty():
        layers.discard(spark, root, version)
        docs = spark.createDataFrame([], DOCUMENTS)
        chunks = spark.createDataFrame([], CHUNKS)
    else:
        chunks = written(corpus.chunk_documents(docs, chunk_words, overlap_words), CHUNKS_TABLE)
        layers.point_to(spark, root, version)
    return corpus.corpus_report(crawled, docs, chunks), corpus.failures(crawled)
