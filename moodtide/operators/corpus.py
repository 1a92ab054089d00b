"""Guidance corpus: validate, clean, de-duplicate and chunk pages."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from moodtide.functions import text as T
from moodtide.operators.silver import first_per_key
from moodtide.schemas import CHUNKS, DOCUMENTS, conform

# --- fixed values ---------------------------------------------------------------
ALLOWED_HOSTS = (
    "www.nimh.nih.gov",
    "nimh.nih.gov",
    "www.nhs.uk",
    "www.who.int",
    "www.cdc.gov",
    "988lifeline.org",
    "www.samhsa.gov",
    "www.mind.org.uk",
)
MIN_DOC_WORDS = 80
CHUNK_WORDS = 220
OVERLAP_WORDS = 40
DEFAULT_TOPIC = "general"
CACHE_KEY_LENGTH = 20
HASH_LENGTH = 16

# Why a page was left out.
NON_HTTPS = "non-https url"
HOST_NOT_ALLOWED = "host not on the allowlist"
NOT_CACHED = "not cached"
NOT_SUCCESSFUL = "unsuccessful payload"
NO_MARKDOWN = "no markdown"
THIN = "too little prose after cleaning"


def check_urls(df: DataFrame, allowed: Iterable[str] | DataFrame = ALLOWED_HOSTS) -> DataFrame:
    """Add ``url_reason``: NULL for https URLs on an allowed host.

    A list of names is put into the expression. A frame with a ``host`` column is
    joined; whether it is sent to the pages or both are shuffled is Spark's choice.
    """
    hosted = df.withColumn("_host", T.url_host("url"))
    if isinstance(allowed, DataFrame):
        names = allowed.select(F.col("host").alias("_host")).where("_host IS NOT NULL").distinct()
        hosted = hosted.join(names.withColumn("_known", F.lit(True)), "_host", "left")
    else:
        hosted = hosted.withColumn("_known", F.col("_host").isin(list(allowed)))
    on_list = F.coalesce("_known", F.lit(False))
    reason = F.when(T.url_scheme("url") != "https", NON_HTTPS).when(~on_list, HOST_NOT_ALLOWED)
    return hosted.withColumn("url_reason", reason).select(*df.columns, "url_reason")


def cache_key(url: Column | str) -> Column:
    return T.content_hash(url, CACHE_KEY_LENGTH)


def join_cache(seeds: DataFrame, payloads: DataFrame) -> DataFrame:
    """Seeds with their cached payload; ``cached`` is false on a miss."""
    hit = payloads.withColumn("cached", F.lit(True))
    joined = seeds.withColumn("key", cache_key("url")).join(hit, "key", "left")
    return joined.withColumn("cached", F.coalesce("cached", F.lit(False)))


def payload_reason(success: Column, markdown: Column) -> Column:
    """NULL for a usable payload, else what is wrong with it."""
    return F.when(~F.coalesce(success, F.lit(False)), NOT_SUCCESSFUL).when(
        F.coalesce(markdown, F.lit("")) == "", NO_MARKDOWN
    )


def thin_page(text: Column | str) -> Column:
    """Fewer words than a page worth indexing."""
    return T.word_count(text) < MIN_DOC_WORDS


def page_title(title: Column, url: Column) -> Column:
    """Title as given, first of a list, or the last path segment of the URL."""
    one = F.try_variant_get(title, "$", "string")
    many = F.try_variant_get(title, "$", "array<string>")
    given = F.when(many.isNotNull(), F.try_element_at(many, F.lit(1))).otherwise(one)
    present = F.when(many.isNotNull(), F.size(many) > 0).otherwise(F.coalesce(one, F.lit("")) != "")
    return T.strip(F.when(present, F.coalesce(given, F.lit(""))).otherwise(T.last_segment(url)))


def to_documents(pages: DataFrame, retrieved_at: Column) -> DataFrame:
    """Page rows (url, topic, data) to document rows, thin pages included."""

    def given(c: str) -> Column:
        return F.when(F.col(c) != "", F.col(c))

    source_url = F.coalesce(given("data.metadata.sourceURL"), given("data.metadata.url"), "url")
    cleaned = pages.withColumn("text", T.clean_markdown("data.markdown"))
    return cleaned.withColumns(
        {
            "seed_url": F.col("url"),
            "title": page_title(F.col("data.metadata.title"), F.col("url")),
            "url": source_url,
            "source": T.url_host(source_url),
            "retrieved_at": retrieved_at,
            "content_hash": T.content_hash("text", HASH_LENGTH),
            "thin": thin_page("text"),
        }
    )


def utc_now() -> Column:
    """Retrieval time in ISO form, seconds, UTC."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def crawl(
    seeds: DataFrame,
    payloads: DataFrame,
    allowed: Iterable[str] | DataFrame = ALLOWED_HOSTS,
    retrieved_at: Column | None = None,
) -> DataFrame:
    """Every seed (position, url, topic) as a document or with the reason it is none."""
    topical = seeds.withColumn("topic", F.coalesce("topic", F.lit(DEFAULT_TOPIC)))
    joined = join_cache(check_urls(topical, allowed), payloads)
    refused = F.coalesce(
        F.col("url_reason"),
        F.when(~F.col("cached"), NOT_CACHED),
        payload_reason(F.col("success"), F.col("data.markdown")),
    )
    # Refused pages need no cleaning: their markdown is emptied first.
    usable = joined.withColumn("_refused", refused).withColumn(
        "data", F.when(F.col("_refused").isNull(), F.col("data"))
    )
    built = to_documents(usable, utc_now() if retrieved_at is None else retrieved_at)
    reason = F.coalesce(F.col("_refused"), F.when(F.col("thin"), THIN))
    return built.withColumn("reason", reason).select(
        "position", "seed_url", "reason", *[f.name for f in DOCUMENTS.fields]
    )


def failures(crawled: DataFrame) -> DataFrame:
    """(url, reason) of seeds that gave no document."""
    return crawled.where(F.col("reason").isNotNull()).select(F.col("seed_url").alias("url"), "reason")


def documents(crawled: DataFrame) -> DataFrame:
    """Documents, the first in seed order of those with the same content."""
    good = crawled.where(F.col("reason").isNull())
    return first_per_key(good, "content_hash", "position", "seed_url").select(*conform(DOCUMENTS))


def chunk_spans(counts: Column, chunk_words: int, overlap_words: int) -> Column:
    """Chunks as array<struct<first, last, words, carried>> from the word counts of paragraphs.

    first and last are paragraph numbers, words the words before paragraph
    ``first``, carried how many of them the chunk begins with. The fold carries
    numbers only, whatever the length of the texts.
    """
    span = "array<struct<first:int,last:int,words:int,carried:int>>"
    start = F.struct(
        F.array().cast(span).alias("done"), F.lit(0).alias("i"), F.lit(0).alias("first"), F.lit(0).alias("seen"),
        F.lit(0).alias("words"), F.lit(0).alias("carried"), F.lit(0).alias("n"),
    )

    def closed(acc: Column) -> Column:
        one = F.struct(acc["first"].alias("first"), (acc["i"] - 1).alias("last"), acc["words"].alias("words"), acc["carried"].alias("carried"))
        return F.concat(acc["done"], F.array(one))

    def step(acc: Column, count: Column) -> Column:
        full = (acc["i"] > 0) & (acc["n"] + count > chunk_words)
        carried = F.least(acc["n"], F.lit(overlap_words))
        pick = lambda new, old: F.when(full, new).otherwise(old)
        return F.struct(
            pick(closed(acc), acc["done"]).alias("done"),
            (acc["i"] + 1).alias("i"),
            pick(acc["i"], acc["first"]).alias("first"),
            (acc["seen"] + count).alias("seen"),
            pick(acc["seen"], acc["words"]).alias("words"),
            pick(carried, acc["carried"]).alias("carried"),
            (pick(carried, acc["n"]) + count).alias("n"),
        )

    return F.aggregate(counts, start, step, lambda acc: F.when(acc["i"] > 0, closed(acc)).otherwise(acc["done"]))


def chunk_texts(
    text: Column, chunk_words: int = CHUNK_WORDS, overlap_words: int = OVERLAP_WORDS
) -> Column:
    """Greedy packing of one document's paragraphs into chunks.

    A chunk is closed when the next paragraph would overfill it; its last words
    start the next chunk, and that paragraph is added unchecked, so a paragraph is
    never split. A chunk is thus a range of paragraphs after some words that stand
    before it, and its text is cut out once, when all ranges are known.
    """
    if overlap_words >= chunk_words:
        raise ValueError("overlap_words must be smaller than chunk_words")
    paragraphs = F.filter(F.transform(F.split(text, "\n\n"), T.strip), lambda p: p != "")
    counted = F.transform(paragraphs, lambda p: F.struct(p.alias("p"), T.word_count(p).alias("n")))
    words = F.filter(F.split(text, rf"[{T.SPACE}]+"), lambda w: w != "")

    def cut(whole: Column, span: Column) -> Column:
        tail = F.slice(whole["words"], span["words"] - span["carried"] + 1, span["carried"])
        body = F.transform(F.slice(whole["items"], span["first"] + 1, span["last"] - span["first"] + 1), lambda x: x["p"])
        parts = F.when(span["carried"] > 0, F.concat(F.array(F.array_join(tail, " ")), body)).otherwise(body)
        return F.array_join(parts, "\n\n")

    def packed(whole: Column) -> Column:
        counts = F.transform(whole["items"], lambda x: x["n"].cast("int"))
        return F.transform(chunk_spans(counts, chunk_words, overlap_words), lambda span: cut(whole, span))

    # Bound as a lambda's variable, paragraphs and words are made once for all chunks.
    whole = F.array(F.struct(counted.alias("items"), words.alias("words")))
    return F.transform(whole, packed)[0]


def chunk_documents(
    docs: DataFrame, chunk_words: int = CHUNK_WORDS, overlap_words: int = OVERLAP_WORDS
) -> DataFrame:
    """One row per chunk, citation columns kept; no shuffle."""
    pieces = chunk_texts(F.col("text"), chunk_words, overlap_words)
    cited = [c for c in ("url", "title", "source", "topic", "retrieved_at", "content_hash")]
    exploded = docs.select(*cited, F.posexplode(pieces).alias("chunk_index", "text"))
    return exploded.withColumn(
        "chunk_id", F.format_string("%s-%03d", F.col("content_hash"), F.col("chunk_index"))
    ).select(*conform(CHUNKS))


def corpus_report(crawled: DataFrame, docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Build totals in one row."""
    seeds = crawled.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count("reason").alias("failed"))
    ).scalar()
    pieces = chunks.agg(F.count(F.lit(1))).scalar()
    totals = docs.agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(T.word_count("text")), F.lit(0)).alias("words"),
        F.count_distinct("source").alias("sources"),
        F.count_distinct("topic").alias("topics"),
    )
    return totals.withColumn("_s", seeds).select(
        F.col("_s.n").alias("seeds"),
        "documents",
        pieces.alias("chunks"),
        "words",
        "sources",
        "topics",
        F.col("_s.failed").alias("failures"),
    )


def corpus_names(docs: DataFrame) -> DataFrame:
    """(kind, name, documents): every source and topic; as many rows as there are names."""
    named = docs.select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("name")) for k in ("source", "topic")))).alias("x"))
    return named.groupBy("x.kind", "x.name").agg(F.count(F.lit(1)).alias("documents"))
