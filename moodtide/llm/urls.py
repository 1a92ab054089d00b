"""URL filter: domain and path rules first, then a template tree judged by labelled purity. Built-in functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.frames import materialize

ALLOW, BLOCK = "allow", "block"
# (verdict, host, path) of the rules that the registered query is given.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
ALPHA = 0.05  # of the test whether two branches differ
WEIGHT = 4.0  # labelled pages that the prior of a template's purity counts for
REJECT = 0.5  # smoothed share of bad pages from which a template is rejected

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; '' for null or without ://."""
    own = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(own, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _ruled(rules: Sequence[tuple[str, str, str]], own: Column, way: Column, value: int | None) -> Column:
    """Of the rules that fit, the longest one's string, or its field ``value``."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the last test made is the outermost
        below = (own == rule[1]) | own.endswith("." + rule[1])
        out = F.when(below & way.startswith(rule[2]), F.lit(rule[1] + rule[2] if value is None else rule[value])).otherwise(out)
    return out


def _differs(a: Column, n_a: Column, b: Column, n_b: Column) -> Column:
    """Whether shares a / n_a and b / n_b differ by more than chance allows (Hoeffding's bound)."""
    bound = math.sqrt(0.5 * math.log(2 / ALPHA))
    n_a, n_b = (F.nullif(n.cast("double"), F.lit(0.0)) for n in (n_a, n_b))
    apart = F.abs(a / n_a - b / n_b) > bound * (1 / F.sqrt(n_a) + 1 / F.sqrt(n_b))
    return F.coalesce(apart, F.lit(False))


# Pages of a node up to which no two of its branches can differ: half and half, the bound is 1 here.
TOO_FEW = math.floor(8 * 0.5 * math.log(2 / ALPHA))


def _rest(depth: Column) -> Column:
    return F.slice("segments", depth + 1, F.greatest(F.size("segments") - depth, F.lit(0)))


def _under(node: Column, names: Column) -> Column:
    return F.concat_ws("/", node, F.when(F.size(names) > 0, F.array_join(names, "/")))


def _finished(rows: DataFrame) -> DataFrame:
    """Rows of nodes with one shape or with too few pages to part any branches, at their ends at once.

    A level at which all go on to the same segment keeps its name, any other is *.
    At most TOO_FEW shapes of a node meet here.
    """
    longest = F.array_max(F.transform("shapes", F.size))
    at = lambda i: F.array_distinct(F.filter(F.transform("shapes", lambda x: F.get(x, i)), lambda x: x.isNotNull()))
    name = F.transform(F.sequence(F.lit(0), longest - 1), lambda i: F.when(F.size(at(i)) == 1, at(i)[0]).otherwise("*"))
    names = rows.groupBy("node").agg(F.collect_list("rest").alias("shapes")).select("node", name.alias("names"))
    done = rows.join(names, "node").withColumn("node", _under(F.col("node"), F.slice("names", 1, F.size("rest"))))
    return done.withColumn("depth", F.size("segments"))


def _grown(rows: DataFrame) -> DataFrame:
    """Every row down the tree by the segments that all of its node share, and by one more: to its own segment, or
    to * if its branch is like its siblings together.

    Branches differ if the share of bad pages among the labelled does, or the share
    of pages that end there. A rare segment cannot differ, so variable ones become *.
    """
    short = F.least(F.size("low"), F.size("high"))
    same = F.transform(F.sequence(F.lit(0), F.greatest(short - 1, F.lit(0))), lambda i: F.get("low", i) == F.get("high", i))
    shared = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, short.cast("long")).cast("int")
    # The least and the greatest row of a node agree in what all have in common; the last of it stays for the next step.
    step = F.least(shared, F.size("low") - 1)
    rows = rows.withColumn("node", _under(F.col("node"), F.slice("rest", F.lit(1), step))).withColumn("depth", F.col("depth") + step)
    at = F.get("segments", F.col("depth"))
    ends = F.when(F.size("segments") == F.col("depth") + 1, F.col("n")).otherwise(0)
    branches = rows.groupBy("node", at.alias("segment")).agg(
        F.sum("n").alias("b_n"), F.sum("labelled").alias("b_labelled"), F.sum("bad").alias("b_bad"), F.sum(ends).alias("b_ends")
    )
    nodes = branches.groupBy("node").agg(
        F.sum("b_n").alias("a_n"), F.sum("b_labelled").alias("a_labelled"), F.sum("b_bad").alias("a_bad"), F.sum("b_ends").alias("a_ends"),
        F.count("*").alias("siblings"),
    )
    rest = lambda name: F.col(f"a_{name}") - F.col(f"b_{name}")
    own = (F.col("siblings") == 1) | _differs(F.col("b_bad"), F.col("b_labelled"), rest("bad"), rest("labelled"))
    own = own | _differs(F.col("b_ends"), F.col("b_n"), rest("ends"), rest("n"))
    names = branches.join(nodes, "node").select("node", "segment", F.when(own, F.col("segment")).otherwise("*").alias("name"))
    down = rows.withColumn("segment", at).join(names, ["node", "segment"])
    return down.withColumns({"node": F.concat("node", F.lit("/"), "name"), "depth": F.col("depth") + 1})


def _round(rows: DataFrame) -> DataFrame:
    """One step for all rows that have segments left."""
    rows_rest = rows.withColumn("rest", _rest(F.col("depth")))
    stats = rows_rest.groupBy("node").agg(
        F.sum("n").alias("pages"), F.count("*").alias("n_shapes"), F.min("rest").alias("low"), F.max("rest").alias("high")
    )
    placed = rows_rest.join(stats, "node")
    few = (F.col("n_shapes") == 1) | (F.col("pages") <= TOO_FEW)
    return _finished(placed.where(few)).select(rows.columns).union(_grown(placed.where(~few)).select(rows.columns))


def shape(way: Column) -> Column:
    """A path's segments with every run of digits as one #."""
    return F.filter(F.split(F.regexp_replace(way, "[0-9]+", "#"), "/"), lambda s: s != "")


def templates(labelled_pages: DataFrame) -> DataFrame:
    """(host, shape, template, purity) of each distinct shape in (host, path, n, labelled, bad).

    purity is the share of bad pages among a template's labelled pages, smoothed
    towards its host's share, and that towards the share of all. The tree grows to
    the last segment of every path. A round takes each node over all segments that
    its rows share and one more; a node with one shape, or with too few pages for any
    test, is done at once: there are as many rounds as nodes that really branch lie
    above each other.
    """
    one = labelled_pages.withColumn("shape", F.array_join(shape(F.col("path")), "/"))
    counts = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    shapes = one.groupBy("host", "shape").agg(*counts)
    parts = F.filter(F.split("shape", "/"), lambda s: s != "")
    rows = materialize(shapes.withColumns({"segments": parts, "node": F.col("host"), "depth": F.lit(0)}), "shapes")
    left = F.size("segments") > F.col("depth")
    done = [rows.where(~left)]
    rows = rows.where(left)
    while not rows.isEmpty():
        step = materialize(_round(rows), "tree-level")
        done.append(step.where(~left))
        rows = step.where(left)
    rows = reduce(DataFrame.union, done)
    total = rows.agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).first()
    prior = (total["bad"] or 0) / max(total["labelled"] or 0, 1)
    smooth = lambda towards: (F.sum("bad") + WEIGHT * towards) / (F.sum("labelled") + WEIGHT)
    hosts = rows.groupBy("host").agg(smooth(F.lit(prior)).alias("host_purity"))
    each = rows.groupBy("host", "node").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("l")).join(hosts, "host")
    judged = each.select("host", "node", ((F.col("b") + WEIGHT * F.col("host_purity")) / (F.col("l") + WEIGHT)).alias("purity"))
    return rows.join(judged, ["host", "node"]).select("host", "shape", F.col("node").alias("template"), "purity")


def filter_urls(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
    label_id: str = "doc_id",
) -> DataFrame:
    """id, host, path, rule, verdict, template, purity of each row of ``pages``.

    A rule fits a host, and all its subdomains, if the path starts with its path;
    the longest fitting rule gives the verdict. Any other page is judged by its
    template: per host, paths form a tree whose levels are all their segments, with
    digits as #; branches of a node that are statistically like their siblings are merged
    into *, and a template is rejected if the smoothed share of bad pages (labelled
    with quality 0 or toxic 1) among its labelled ones reaches REJECT.

    Pages are counted by (host, shape) with partial sums before anything is joined,
    so a host with a third of all rows is few rows from there on; the join that
    brings verdicts back has unique rows on its other side. A null url, or one
    without ://, has an empty host and path and the root's template. Repeated pages
    are judged each; repeated labels of a page count once, bad if any is. Without
    labels every template has purity 0. Other columns are not looked at; an empty
    table gives an empty table.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"))
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.col("quality") == 0, F.col("toxic") == 1, F.lit(False))
    marks = labels.select(F.col(label_id).alias("id"), bad.cast("int").alias("bad")).where("id is not null").groupBy("id").agg(F.max("bad").alias("bad"))
    known = rows.join(marks, "id", "left").select(
        "host", "path", F.lit(1).alias("n"), F.col("bad").isNotNull().cast("int").alias("labelled"), F.coalesce("bad", F.lit(0)).alias("bad")
    )
    tree = templates(known)
    ruled = rows.withColumns(
        {
            "shape": F.array_join(shape(F.col("path")), "/"),
            "rule": _ruled(rules, F.col("host"), F.col("path"), None),
            "ruled": _ruled(rules, F.col("host"), F.col("path"), 0),
        }
    )
    method = F.when(F.col("purity") >= REJECT, BLOCK).otherwise(ALLOW)
    return ruled.join(tree, ["host", "shape"], "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity"
    )
