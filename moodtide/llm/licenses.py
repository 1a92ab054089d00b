"""License scan: sparse TF-IDF cosine to templates, then inheritance down directories. Built-in functions only."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.license_blocks import FILES, HEADERS, OPENINGS

# (license, text) of headers and of the first lines of licence files.
TEMPLATES = (
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)
RESERVED = "(all rights reserved)"
TEMPLATES = (*TEMPLATES, (RESERVED, "All rights reserved."))
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+()-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9.+()-]+)*)"
COSINE = 0.8
ROOT = "/"


def tokens_of(text: str) -> list[str]:
    return [t for t in re.split("[^a-z0-9]+", text.lower()) if t]


def tokens(text: Column) -> Column:
    """Runs of a-z and 0-9 of the lower-cased text."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


@dataclass
class Templates:
    """Weights of bounded, given templates: idf over them and unit vectors."""

    idf: dict[str, float]
    unseen: float
    vectors: dict[str, dict[str, float]]

    @classmethod
    def of(cls, templates: Sequence[tuple[str, str]]) -> Templates:
        counts = [(name, Counter(tokens_of(text))) for name, text in templates]
        held = Counter(t for _, c in counts for t in c)
        weigh = lambda n: math.log((1 + len(counts)) / (1 + n)) + 1
        idf = {t: weigh(n) for t, n in held.items()}
        vectors = {}
        for name, c in counts:
            raw = {t: n * idf[t] for t, n in c.items()}
            norm = math.sqrt(sum(x * x for x in raw.values())) or 1.0
            vectors[name] = {t: x / norm for t, x in raw.items()}
        return cls(idf, weigh(0), vectors)


def lines_of(text: Column) -> Column:
    """(line, tokens) of every line, and as line -1 of the whole text."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line"), tokens(x).alias("tokens")))
    return F.concat(lines, F.array(F.struct(F.lit(-1).alias("line"), tokens(text).alias("tokens"))))


def windows_of(text: Column, sizes: Sequence[int], opening: bool) -> Column:
    """(line, tokens) of the next n tokens from every line on, for each n of ``sizes``, and as line -1 of the whole text.

    If ``opening``, of the first n tokens of the text only, as lines below 0.
    """
    every = tokens(text)
    whole = F.array(F.struct(F.lit(-1).alias("line"), every.alias("tokens")))
    if opening:
        first = [F.struct(F.lit(-1 - k).alias("line"), F.slice(every, 1, n).alias("tokens")) for k, n in enumerate(sizes, 1)]
        return F.concat(whole, F.array(*first))
    counts = F.transform(F.split(text, "\n"), lambda x: F.size(tokens(x)))
    start = lambda i, own: F.aggregate(F.slice(own, F.lit(1), i), F.lit(0), lambda a, n: a + n) + 1
    # Bound as lambda variables, tokens and counts are found once.
    each = lambda own: F.transform(
        own["counts"],
        lambda n, i: F.array(
            *(F.struct((i * len(sizes) + k).alias("line"), F.slice(own["every"], start(i, own["counts"]), size).alias("tokens")) for k, size in enumerate(sizes))
        ),
    )
    windows = F.flatten(F.flatten(F.transform(F.array(F.struct(every.alias("every"), counts.alias("counts"))), each)))
    return F.concat(windows, whole)


def similar_units(
    docs: DataFrame, key: Sequence[str], text: str, known: Templates, cosine: float, units_of: Callable[[Column], Column] = lines_of
) -> DataFrame:
    """(*key, whole, license, cosine) of every unit (a line, by default), and every whole text, of cosine at least ``cosine`` to a template."""
    spark = docs.sparkSession
    vocabulary = spark.createDataFrame(sorted(known.idf.items()), "token string, idf double")
    vectors = spark.createDataFrame(
        [(t, name, x) for name, v in known.vectors.items() for t, x in v.items()], "token string, license string, weight double"
    )
    words = F.array(*(F.lit(t) for t in sorted(known.idf)))

    def near(held: Column) -> Column:
        """Whether some template's weight among the tokens shared allows the cosine, which is at most that weight's root."""
        weight = lambda shared, v: sum((F.when(F.array_contains(shared, t), x * x).otherwise(0.0) for t, x in v.items()), F.lit(0.0))
        enough = lambda shared: F.greatest(*(weight(shared, v) for v in known.vectors.values()), F.lit(0.0)) >= cosine**2 - 1e-6
        # Bound as a lambda's variable, the shared tokens are found once.
        return F.exists(F.array(F.array_intersect(held, words)), enough)

    held = docs.select(*key, text).where(near(tokens(F.col(text))))
    units = held.select(*key, F.explode(units_of(F.col(text))).alias("u")).select(*key, "u.line", "u.tokens").where(near(F.col("tokens")))
    counted = units.select(*key, "line", F.explode("tokens").alias("token")).groupBy(*key, "line", "token").agg(F.count("*").alias("n"))
    weighed = counted.join(F.broadcast(vocabulary), "token", "left").withColumn("x", F.col("n") * F.coalesce("idf", F.lit(known.unseen)))
    norms = weighed.groupBy(*key, "line").agg(
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"),
        F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("token", "x"))).alias("own"),
    )
    # own holds tokens of the templates only, so it is as bounded as they are.
    dots = norms.select(*key, "line", "norm", F.explode("own").alias("o")).join(F.broadcast(vectors), F.col("o.token") == F.col("token"))
    scores = dots.groupBy(*key, "line", "license").agg((F.sum(F.col("o.x") * F.col("weight")) / F.first("norm")).alias("cosine"))
    rounded = F.round("cosine", 6)
    return scores.select(*key, (F.col("line") < 0).alias("whole"), "license", rounded.alias("cosine")).where(F.col("cosine") >= cosine)


def similar_blocks(docs: DataFrame, key: Sequence[str], text: str, cosine: float) -> DataFrame:
    """As ``similar_units``, of neighbouring lines and whole texts with FILES, of neighbouring lines with HEADERS, of how texts open with OPENINGS, and of SPDX tags."""
    out = []
    for given, opening in ((FILES + HEADERS, False), (OPENINGS, True)):
        known = Templates.of([(f"{name}#{k}", x) for k, (name, x) in enumerate(given)])
        sizes = sorted({len(tokens_of(x)) for _, x in given})
        found = similar_units(docs, key, text, known, cosine, lambda t, n=sizes, o=opening: windows_of(t, n, o))
        of_file = F.lit(opening) | (F.substring_index("license", "#", -1).cast("int") < len(FILES))
        out.append(found.where(~F.col("whole") | of_file).withColumn("license", F.substring_index("license", "#", 1)))
    tags = docs.where(F.col(text).contains("SPDX-License-Identifier:")).select(*key, F.explode(F.regexp_extract_all(text, F.lit(SPDX), F.lit(1))).alias("license"))
    return reduce(DataFrame.union, [*out, tags.select(*key, F.lit(False).alias("whole"), "license", F.lit(1.0).alias("cosine"))])


def parent(path: Column) -> Column:
    """Directory of a path, with a slash at its end."""
    return F.regexp_extract(path, "^(.*/)?", 0)


def ancestors(directory: Column) -> Column:
    """The directory and all above it, nearest first, down to the root."""
    parts = F.split(F.regexp_replace(directory, "/$", ""), "/")
    each = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda k: F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")))
    return F.transform(each, lambda d, i: F.struct(d.alias("above"), i.alias("distance")))


def scan_licenses(
    docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
    cosine: float = COSINE,
) -> DataFrame:
    """id, path, license, cosine, found (header, file, inherited or null), distance of each row of ``docs``.

    Every line and every whole text is compared with ``templates`` by cosine of
    TF-IDF vectors (tokens are runs of a-z0-9 in lower case; idf over the
    templates, tokens in none weigh most). So are whole texts, and from every line on
    as many tokens as a block has, with FILES and (not whole texts) HEADERS, and the
    first tokens of a text with OPENINGS of long licence files; an SPDX tag names its licence. A row
    whose whole text or opening is similar is a licence file and stands for its
    directory; one with a similar line or block has a header; any other inherits from the licence file in the nearest directory at
    or above its own, distance counting the steps up. Of several, the highest
    cosine (6 decimals) wins, then the last license by name; RESERVED only if alone.

    The tokens that a text shares with a template bound its cosine; texts and lines
    that cannot reach ``cosine`` are left out before anything is counted, nothing
    else is. Only the
    templates, a parameter, are broadcast. Inheritance joins distinct directories
    with those that have a licence, so a directory with a third of all rows is one
    row; the join back has unique directories on one side.

    Null and empty texts are no licence and may inherit; a null path is in no
    directory. Rows that share id, path and text are judged alike and each returned;
    other columns are not looked at; an empty table gives an empty table.
    """
    known = Templates.of(templates)
    rows = docs.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text_col).alias("text"))
    rows = rows.withColumns({"h": F.xxhash64("text"), "dir": F.when(F.col("path").isNotNull(), parent(F.concat(F.lit(ROOT), "path")))})
    keys = ["id", "path", "h"]
    lines = similar_units(rows, keys, "text", known, cosine).union(similar_blocks(rows, keys, "text", cosine))
    rank = F.struct((F.col("license") != RESERVED).alias("named"), "cosine", "license")
    top = lambda whole: F.max(F.when(F.col("whole") == whole, rank))
    own = lines.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(top(True).alias("file"), top(False).alias("header"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    marked = rows.drop("text").join(own, same, "left").drop(*(f"_{k}" for k in keys))
    files = own.where("file is not null").select(
        parent(F.concat(F.lit(ROOT), "_path")).alias("above"), "file"
    )
    licensed = files.where("above is not null").groupBy("above").agg(F.max("file").alias("from"))
    reach = rows.select("dir").where("dir is not null").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("a"))
    nearest = reach.select("dir", "a.above", "a.distance").join(licensed, "above").groupBy("dir").agg(F.min_by(F.struct("from", "distance"), "distance").alias("up"))
    out = marked.join(nearest, "dir", "left")
    chosen = F.coalesce("file", "header", "up.from")
    found = F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header").when(F.col("up").isNotNull(), "inherited")
    return out.select(
        F.col("id").alias(id_col), "path", chosen["license"].alias("license"), chosen["cosine"].alias("cosine"), found.alias("found"),
        F.when(found == "inherited", F.col("up.distance")).alias("distance"),
    )


def source_path(source: str = "source", lang: str = "lang", id_col: str = "doc_id") -> Column:
    """A path for tables that have none: source/lang/shard of 64 ids/id."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("_"))
    shard = F.coalesce(F.floor(F.col(id_col) / 64).cast("string"), F.lit("_"))
    return F.concat_ws("/", part(source), part(lang), shard, part(id_col))
