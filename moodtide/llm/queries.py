"""One query for each operator of this subpackage, over its whole table, and its DuckDB twin where SQL can say it."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from moodtide.llm import bpe, chat, decontaminate, embeddings, importance, langid, licenses, one_bit, simhash, substrings, token_counts, urls, vector_codes
from moodtide.llm.frames import read_table
from moodtide.llm.twins import codes_twin, nearest_twin, resample_twin

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path() -> str:
    """The public byte-level BPE vocabulary of the queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
    return judged.withColumn("purity", F.round("purity", 9))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), vocabulary_path())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link_embeddings(read_table(spark, sf_dir, "embeddings"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"), licenses.source_path())


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_near_copies(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    marked = docs.select("doc_id", "text", langid.held_out("doc_id").alias("held_out"))
    return langid.identify(marked, langid.learn(docs)).drop("text")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["conv_id", "turn", "role", "text"]
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select(fields).union(extra)
    return chat.digest(chat.format_conversations(turns))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.dedup_substrings(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary_path())


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return one_bit.nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_bpe": op2_bpe,
    "op3_decontamination": op3_decontamination,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_simhash": op6_simhash,
    "op7_language_id": op7_language_id,
    "op8_chat_format": op8_chat_format,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_vector_codes": op13_vector_codes,
}

TWIN_LEVELS = 8  # more than any path of the given tables has


def url_twin() -> str:
    """The template tree with the levels of the given tables written out."""
    bound = repr(math.sqrt(0.5 * math.log(2 / urls.ALPHA)))

    def differs(a: str, n_a: str, b: str, n_b: str) -> str:
        apart = f"abs(({a}) / nullif({n_a}, 0)::DOUBLE - ({b}) / nullif({n_b}, 0)::DOUBLE)"
        return f"coalesce({apart} > {bound} * (1 / sqrt(nullif({n_a}, 0)::DOUBLE) + 1 / sqrt(nullif({n_b}, 0)::DOUBLE)), false)"

    def fits(host: str, path: str) -> str:
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"

    longest = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest) + " END"
    ruled = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest) + " END"
    parts = "list_filter(string_split(shape, '/'), lambda s: s <> '')"
    steps = []
    for k in range(TWIN_LEVELS):
        at = f"segments[{k + 1}]"
        own = " OR ".join(
            ["siblings = 1", differs("b.bad", "b.labelled", "a.bad - b.bad", "a.labelled - b.labelled"), differs("b.ends", "b.n", "a.ends - b.ends", "a.n - b.n")]
        )
        steps += [
            f"""b{k} AS (SELECT node, {at} AS segment, sum(n) AS n, sum(labelled) AS labelled, sum(bad) AS bad,
                    sum(CASE WHEN len(segments) = {k + 1} THEN n ELSE 0 END) AS ends
                FROM t{k} WHERE len(segments) > {k} GROUP BY ALL)""",
            f"""a{k} AS (SELECT node, sum(n) AS n, sum(labelled) AS labelled, sum(bad) AS bad, sum(ends) AS ends, count(*) AS siblings
                FROM b{k} GROUP BY node)""",
            f"""m{k} AS (SELECT b.node, b.segment, CASE WHEN {own} THEN b.segment ELSE '*' END AS name FROM b{k} b JOIN a{k} a USING (node))""",
            f"""t{k + 1} AS (SELECT t.* REPLACE (coalesce(t.node || '/' || m.name, t.node) AS node)
                FROM t{k} t LEFT JOIN m{k} m ON m.node = t.node AND m.segment = t.{at} AND len(t.segments) > {k})""",
        ]
    last = f"t{TWIN_LEVELS}"
    return rf"""
        WITH after AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
        cut AS (
            SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}'), '') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM after),
        p AS (
            SELECT *, array_to_string(list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda s: s <> ''), '/') AS shape
            FROM cut),
        marks AS (
            SELECT doc_id, max(CAST(coalesce(quality = 0 OR toxic = 1, quality = 0, toxic = 1, false) AS INT)) AS bad
            FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        shapes AS (
            SELECT host, shape, count(*) AS n, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad
            FROM p LEFT JOIN marks ON doc_id = page_id GROUP BY ALL),
        t0 AS (
            SELECT *, host AS node, {parts} AS segments FROM shapes),
        {", ".join(steps)},
        hosts AS (
            SELECT host, (sum(bad) + {urls.WEIGHT} * prior) / (sum(labelled) + {urls.WEIGHT}) AS host_purity
            FROM {last}, (SELECT sum(bad) / greatest(sum(labelled), 1)::DOUBLE AS prior FROM {last}) GROUP BY host, prior),
        nodes AS (
            SELECT host, node, (sum(bad) + {urls.WEIGHT} * host_purity) / (sum(labelled) + {urls.WEIGHT}) AS purity
            FROM {last} JOIN hosts USING (host) GROUP BY host, node, host_purity)
        SELECT page_id, p.host, p.path, {rule.replace('host', 'p.host').replace('path', 'p.path')} AS rule,
               coalesce({ruled.replace('host', 'p.host').replace('path', 'p.path')},
                        CASE WHEN purity >= {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
               t.node AS template, round(purity, 9) AS purity
        FROM p JOIN {last} t USING (host, shape) JOIN nodes n ON n.host = t.host AND n.node = t.node"""


def license_twin() -> str:
    known = licenses.Templates.of(licenses.TEMPLATES)
    idf = ", ".join(f"('{t}', {x!r}::DOUBLE)" for t, x in sorted(known.idf.items()))
    vectors = ", ".join(f"('{n}', '{t}', {x!r}::DOUBLE)" for n, v in known.vectors.items() for t, x in v.items())
    return rf"""
        WITH vocabulary(token, idf) AS (VALUES {idf}),
        vectors(license, token, weight) AS (VALUES {vectors}),
        d AS (
            SELECT doc_id, text, coalesce(source, '_') || '/' || coalesce(lang, '_') || '/' ||
                   coalesce(floor(doc_id / 64.0)::BIGINT::VARCHAR, '_') || '/' || coalesce(doc_id::VARCHAR, '_') AS path
            FROM documents),
        units AS (
            SELECT doc_id, unnest(range(len(x))) AS line, unnest(x) AS unit
            FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM d)
            UNION ALL SELECT doc_id, -1, text FROM d),
        tokens AS (
            SELECT doc_id, line, token, count(*) AS n
            FROM (SELECT doc_id, line, unnest(regexp_split_to_array(lower(unit), '[^a-z0-9]+')) AS token FROM units)
            WHERE token <> '' GROUP BY ALL),
        weighed AS (
            SELECT t.*, n * coalesce(idf, {known.unseen!r}::DOUBLE) AS x FROM tokens t LEFT JOIN vocabulary USING (token)),
        norms AS (SELECT doc_id, line, sqrt(sum(x * x)) AS norm FROM weighed GROUP BY ALL),
        scores AS (
            SELECT doc_id, line, license, round(sum(x * weight) / any_value(norm), 6) AS cosine
            FROM weighed JOIN vectors USING (token) JOIN norms USING (doc_id, line) GROUP BY ALL),
        top AS (
            SELECT doc_id, line = -1 AS whole, cosine, license FROM scores WHERE cosine >= {licenses.COSINE}
            QUALIFY row_number() OVER (PARTITION BY doc_id, line = -1 ORDER BY cosine DESC, license DESC) = 1),
        dirs AS (
            SELECT doc_id, unnest(range(4)) AS up, path FROM d),
        above AS (
            SELECT doc_id, up, CASE up WHEN 3 THEN '/' ELSE
                '/' || array_to_string(string_split(path, '/')[1:3 - up], '/') || '/' END AS dir FROM dirs),
        licensed AS (
            SELECT dir, cosine, license FROM top JOIN above USING (doc_id) WHERE whole AND up = 0
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, license DESC) = 1),
        nearest AS (
            SELECT doc_id, up, cosine, license FROM above JOIN licensed USING (dir)
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY up) = 1)
        SELECT d.doc_id, path, coalesce(f.license, h.license, i.license) AS license,
               coalesce(f.cosine, h.cosine, i.cosine) AS cosine,
               CASE WHEN f.doc_id IS NOT NULL THEN 'file' WHEN h.doc_id IS NOT NULL THEN 'header'
                    WHEN i.doc_id IS NOT NULL THEN 'inherited' END AS found,
               CASE WHEN f.doc_id IS NULL AND h.doc_id IS NULL THEN i.up::INT END AS distance
        FROM d LEFT JOIN (SELECT * FROM top WHERE whole) f ON f.doc_id = d.doc_id
        LEFT JOIN (SELECT * FROM top WHERE NOT whole) h ON h.doc_id = d.doc_id
        LEFT JOIN nearest i ON i.doc_id = d.doc_id"""


ORACLE: dict[str, str] = {
    "op1_url_filter": url_twin(),
    "op5_license_scan": license_twin(),
    "op8_chat_format": r"""
        WITH m AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (
            SELECT *, regexp_replace(
                text, '([<\[])(\\*(?:/?s>|/?INST\]|IMG\]|AUD\]|DOC\]))', '\1\\\2', 'g') AS body FROM m),
        a AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body) AS turns,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '') AS loss,
                   3 + sum(7 + length(url_encode(role)) + 9 + length(body) + 4) AS formatted_chars
            FROM e GROUP BY conv_id)
        SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
        FROM a""",
    "op9_substring_dedup": r"""
        WITH w AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        starts AS (
            SELECT r, unnest(range(1, len(words) - 33)) AS i, words FROM w WHERE len(words) >= 35),
        windows AS (SELECT r, i, array_to_string(words[i:i + 34], ' ') AS win FROM starts),
        repeated AS (SELECT win FROM windows GROUP BY win HAVING count(*) > 1),
        covered AS (
            SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM windows JOIN repeated USING (win)),
        each AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM w),
        kept AS (
            SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text
            FROM each ANTI JOIN covered USING (r, k) GROUP BY r)
        SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (r)""",
    "op11_nearest_neighbours": nearest_twin(),
    "op12_importance_resampling": resample_twin(),
    "op13_vector_codes": codes_twin(),
}
