"""Fixed table contracts, one ``StructType`` per layer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


BRONZE = _struct(
    post_id=StringType(),
    subreddit=StringType(),
    author=StringType(),
    created_date=StringType(),
    post=StringType(),
    period=StringType(),
    source_file=StringType(),
    ingested_at=TimestampType(),
)

SILVER = _struct(
    post_id=StringType(),
    subreddit=StringType(),
    created_date=DateType(),
    author_hash=StringType(),
    text=StringType(),
    period=StringType(),
    source_file=StringType(),
    ingested_at=TimestampType(),
)

GOLD_POSTS = _struct(
    post_id=StringType(),
    subreddit=StringType(),
    created_date=DateType(),
    week=DateType(),
    author_hash=StringType(),
    n_chars=LongType(),
    n_words=LongType(),
    sentiment_score=DoubleType(),
    sentiment_label=StringType(),
    crisis_score=DoubleType(),
    crisis_flag=BooleanType(),
)

GOLD_WEEKLY = _struct(
    subreddit=StringType(),
    week=DateType(),
    n_posts=LongType(),
    n_active_authors=LongType(),
    avg_word_count=DoubleType(),
    sentiment=DoubleType(),
    crisis_count=LongType(),
    crisis_rate=DoubleType(),
)

# Columns a warehouse copy of each Gold table must never hold as NULL.
GOLD_POSTS_REQUIRED = ("post_id", "subreddit", "created_date", "week", "n_chars", "n_words")
GOLD_WEEKLY_REQUIRED = ("subreddit", "week", "n_posts", "n_active_authors")

SENTIMENT_SCORES = _struct(
    post_id=StringType(), sentiment_score=DoubleType(), sentiment_label=StringType()
)
CRISIS_SCORES = _struct(
    post_id=StringType(), crisis_score=DoubleType(), crisis_flag=BooleanType()
)

DOCUMENTS = _struct(
    url=StringType(),
    title=StringType(),
    source=StringType(),
    topic=StringType(),
    text=StringType(),
    retrieved_at=StringType(),
    content_hash=StringType(),
)

CHUNKS = _struct(
    chunk_id=StringType(),
    text=StringType(),
    url=StringType(),
    title=StringType(),
    source=StringType(),
    topic=StringType(),
    retrieved_at=StringType(),
    chunk_index=IntegerType(),
)

# A page payload as cached: ``title`` may be a string or a list of strings.
PAYLOADS = _struct(
    key=StringType(),
    success=BooleanType(),
    data=_struct(
        markdown=StringType(),
        metadata=_struct(title=VariantType(), sourceURL=StringType(), url=StringType()),
    ),
)


def conform(schema: StructType) -> list[Column]:
    """Select list that casts a frame to ``schema``, in contract order."""
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
