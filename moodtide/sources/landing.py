"""Raw corpus files to Bronze."""

from __future__ import annotations

import re
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moodtide.functions.text import derive_post_id
from moodtide.schemas import BRONZE, conform

RAW_COLUMNS = ("subreddit", "author", "date", "post")
FILE_SUFFIX = "_posts.csv"  # of the corpus files, where a caller names no other


def file_path() -> Column:
    """Path of the file a row was read from (the metadata column is URL-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def source_name(path: Column) -> Column:
    """Name of the corpus file: the first path component ending in ``.csv``.

    A corpus file may be a plain file or, better for large ones, a folder of part
    files (quoted line breaks keep a single CSV file from being split).
    """
    return F.regexp_extract(path, r"([^/=]+\.csv)(?:/|\z)", 1)


def file_lineage(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Community and period from ``<community>_<period>_...``, lower-cased."""
    parts = F.split(F.col(column), "_")
    return df.withColumns(
        {
            "file_subreddit": F.lower(F.get(parts, F.lit(0))),
            "file_period": F.lower(F.get(parts, F.lit(1))),
        }
    )


def csv_reader(reader):
    """Options of the corpus format, for batch and streaming readers alike."""
    return (
        reader.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
    )


def to_bronze(raw: DataFrame, path: Column, ingested_at: Column | None = None) -> DataFrame:
    """Raw rows with lineage and content-derived ids, in Bronze order."""
    named = raw.select(*RAW_COLUMNS, source_name(path).alias("source_file"))
    landed = file_lineage(named).withColumnsRenamed({"date": "created_date", "file_period": "period"})
    return landed.withColumns(
        {
            "post_id": derive_post_id("subreddit", "author", "created_date", "post"),
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        }
    ).select(*conform(BRONZE))


def land_csv(spark: SparkSession, *paths: str, ingested_at: Column | None = None) -> DataFrame:
    """Corpus CSV files as Bronze rows.

    Files are read by header, all strings; selecting the four raw columns lets
    the parser skip the hundreds of feature columns. One task parses one file;
    ``split_csv.land`` reads large ones by many tasks.
    """
    raw = csv_reader(spark.read).csv(list(paths))
    return to_bronze(raw, file_path(), ingested_at)


# --- catalog --------------------------------------------------------------------


def wanted_pairs(
    spark: SparkSession, subreddits: Sequence[str], periods: Sequence[str], suffix: str = FILE_SUFFIX
) -> DataFrame:
    """Requested files ``<community>_<period><suffix>`` in request order, from two configuration lists."""
    rows = [
        (i * len(periods) + j, s.lower(), p.lower(), f"{s}_{p}{suffix}")
        for i, s in enumerate(subreddits)
        for j, p in enumerate(periods)
    ]
    return spark.createDataFrame(
        rows, "position int, file_subreddit string, file_period string, expected string"
    )


def missing_pairs(wanted: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested pairs the catalog (``key``) has no file for."""
    keyed = file_lineage(catalog, "key")
    return wanted.join(keyed, ["file_subreddit", "file_period"], "left_anti")


def select_files(wanted: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog entry of every requested pair; fails when one is missing."""
    # As long as the request at most, which the caller holds in memory.
    missing = missing_pairs(wanted, catalog).orderBy("position").collect()
    if missing:
        pairs = [(r["file_subreddit"], r["file_period"]) for r in missing]
        raise ValueError(f"corpus has no file for: {pairs}")
    keyed = file_lineage(catalog, "key")
    return wanted.drop("expected").join(keyed, ["file_subreddit", "file_period"]).orderBy("position")


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Path, name, size and time of all files; contents are not read.

    The scan leaves empty files out. They are in the file index, which the driver
    holds anyway, and are listed with length 0 and no time.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    # Local files are file:///x in the index and file:/x in the scan.
    indexed = [(re.sub("^file:/+", "file:/", unquote(p)),) for p in found.inputFiles()]
    sized = found.select("path", "length", "modificationTime")
    listing = spark.createDataFrame(indexed, "path string").join(sized, "path", "left")
    name = F.element_at(F.split("path", "/"), -1)
    return listing.select("path", name.alias("name"), F.coalesce("length", F.lit(0)).alias("length"), "modificationTime")


def expected_files(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """Requested files with the number of files found for each (0 = missing)."""
    found = (
        listing.select(source_name(F.col("path")).alias("expected"), "length")
        .groupBy("expected")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )
    joined = wanted.join(found, "expected", "left")
    return joined.withColumn("n_files", F.coalesce("n_files", F.lit(0)))


def require_files(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """``expected_files`` that raises when a file is missing."""
    expected = expected_files(wanted, listing)
    missing = expected.where("n_files = 0").orderBy("position").collect()
    if missing:
        raise FileNotFoundError(f"expected {[r['expected'] for r in missing]}")
    return expected


# --- checksums ------------------------------------------------------------------


def file_digests(spark: SparkSession, *paths: str) -> DataFrame:
    """Path, name, size and MD5 of every file, empty ones included.

    One task hashes one file's content, which must fit into a cell (2 GB); larger
    corpus files are folders of part files of bounded size (see ``digest_roots``).
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    hashed = found.select("path", F.md5("content").alias("md5"))
    nothing = F.md5(F.lit("").cast("binary"))
    listed = list_files(spark, *paths).join(hashed, "path", "left")
    return listed.select("path", "name", "length", F.coalesce("md5", nothing).alias("md5"))


def part_digests(files: DataFrame) -> DataFrame:
    """key, part, length, md5 of each of ``file_digests``: the corpus file, and the name below it (its own if it is one file)."""
    key = source_name(F.col("path"))
    below = F.call_function("substring_index", F.col("path"), F.concat(key, F.lit("/")), F.lit(-1))
    part = F.when(F.col("path").endswith(F.concat(F.lit("/"), key)), key).otherwise(below)
    return files.select(key.alias("key"), part.alias("part"), "length", "md5").where("key <> ''")


def digest_roots(parts: DataFrame) -> DataFrame:
    """key, n_parts, length, md5 of each corpus file: one digest over those of its parts.

    A plain file keeps its own MD5, the one that an archive publishes. A folder's is
    the root of a tree: parts are dealt to 4,096 inner nodes by a hash of their
    names, a node digests its parts' names, lengths and MD5s in order of names, the
    root the nodes in their order. So no content becomes one cell, and no list is
    longer than a 4,096th of the parts.
    """
    own = F.concat_ws(":", "part", "length", "md5")
    nodes = parts.groupBy("key", F.substring(F.md5("part"), 1, 3).alias("node")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("length").alias("length"),
        F.md5(F.array_join(F.array_sort(F.collect_list(own)), "\n")).alias("digest"),
        F.max(F.when(F.col("part") == F.col("key"), F.col("md5"))).alias("plain"),
    )
    tree = F.md5(F.array_join(F.array_sort(F.collect_list(F.concat("node", F.lit(":"), "digest"))), "\n"))
    plain = F.when(F.sum("n") == 1, F.max("plain"))
    return nodes.groupBy("key").agg(
        F.sum("n").alias("n_parts"), F.sum("length").alias("length"), F.coalesce(plain, tree).alias("md5")
    )


def verify_parts(parts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Each corpus file of a manifest of parts: key, status (verified, mismatch or missing) and the parts that differ.

    Roots are compared first; only files whose roots differ are looked into. ``changed``,
    ``lost`` and ``added`` count their parts. Where they are: ``changed_parts``.
    """
    ours, theirs = digest_roots(parts), digest_roots(manifest).withColumnRenamed("md5", "wanted")
    status = (
        F.when(F.col("md5").isNull(), "missing").when(F.col("md5") == F.col("wanted"), "verified").otherwise("mismatch")
    )
    roots = theirs.select("key", "wanted").join(ours.select("key", "md5"), "key", "left").withColumn("status", status)
    counts = changed_parts(parts, manifest, roots.where("status = 'mismatch'").select("key")).groupBy("key").agg(
        *[F.count_if(F.col("change") == c).alias(c) for c in ("changed", "lost", "added")]
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("changed", "lost", "added")}
    return roots.select("key", "status").join(counts, "key", "left").withColumns(zero)


def changed_parts(parts: DataFrame, manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """key, part, change (changed, lost or added) of the parts of ``keys`` that differ from the manifest."""
    ours = parts.join(keys, "key", "left_semi").select("key", "part", F.struct("length", "md5").alias("ours"))
    theirs = manifest.join(keys, "key", "left_semi").select("key", "part", F.struct("length", "md5").alias("theirs"))
    change = F.when(F.col("ours").isNull(), "lost").when(F.col("theirs").isNull(), "added").otherwise("changed")
    both = ours.join(theirs, ["key", "part"], "full").where(~F.col("ours").eqNullSafe(F.col("theirs")))
    return both.select("key", "part", change.alias("change"))


def verify_checksums(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Each manifest entry (key, md5): verified, mismatch or missing."""
    actual = files.select("key", F.col("md5").alias("actual"))
    status = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("actual") == F.col("md5"), "verified")
        .otherwise("mismatch")
    )
    return manifest.join(actual, "key", "left").withColumn("status", status)
