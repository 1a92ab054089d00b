"""The same inputs and helpers as DuckDB SQL, for the side-by-side check.

``compose(body)`` puts the common table expressions a statement mentions, and
those they mention in turn, in front of it. Regular expressions here are RE2:
no look-around, ASCII ``\\s``, ``\\w`` and ``\\b``; hence the explicit classes.
"""

from __future__ import annotations

import re

from moodtide.bindings import views as V
from moodtide.functions import text as T
from moodtide.operators import signal

SP = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"\p{L}\p{N}_"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
MARK = "\ue000"  # a private-use character that no text contains


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(items) -> str:
    return ", ".join(quote(i) for i in items)


def normalize(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{SP}]+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SP}]+|[{SP}]+$', '', 'g')"


def round_even(x: str, places: int) -> str:
    return f"round_even(({x}) * 1e{places}, 0) / 1e{places} + 0.0"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{SP}]+'), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"len({words(x)})"


def email(x: str) -> str:
    return rf"regexp_replace({x}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}', '[REDACTED:email]', 'g')"


def url(x: str) -> str:
    return rf"regexp_replace({x}, '(?:https?://|www\.)[^{SP}]+', '[REDACTED:url]', 'gi')"


def handle(x: str) -> str:
    return rf"regexp_replace({x}, '(^|[^{WORD}/])/?u/[A-Za-z0-9_-]+', '\1[REDACTED:handle]', 'gi')"


def mention(x: str) -> str:
    return rf"regexp_replace({x}, '(^|[^{WORD}])@[A-Za-z0-9_]{{2,}}', '\1[REDACTED:mention]', 'g')"


def marked(x: str) -> str:
    """Put a mark on both sides of every non-word character and of the text, so
    that neighbouring matches never compete for the character between them."""
    return rf"('{MARK}' || regexp_replace({x}, '([^{WORD}])', '{MARK}\1{MARK}', 'g') || '{MARK}')"


PHONE = rf"{MARK}((?:{MARK}\+{MARK})?\p{{Nd}}(?:\p{{Nd}}|{MARK}[{SP}().-]{MARK}){{5,}}\p{{Nd}}){MARK}"


def phone(x: str) -> str:
    return (
        f"replace(regexp_replace({marked(x)}, '{PHONE}', "
        f"'{MARK}[REDACTED:phone]{MARK}', 'g'), '{MARK}', '')"
    )


def scrub(x: str) -> str:
    return phone(mention(handle(url(email(x)))))


def distinct_hits(x: str, terms) -> str:
    return " + ".join(f"CAST(contains(lower({x}), {quote(t)}) AS INT)" for t in terms)


def count_hits(x: str, terms) -> str:
    return " + ".join(
        f"(length(lower({x})) - length(replace(lower({x}), {quote(t)}, ''))) // {len(t)}"
        for t in terms
    )


def count_tokens(x: str, tokens) -> str:
    """Whole tokens; marks make each occurrence end where its neighbour starts."""

    def spelled(token: str) -> str:
        return token.replace("'", f"{MARK}''{MARK}")

    choice = "|".join(spelled(t) for t in tokens)
    return f"len(regexp_extract_all({marked(x)}, '(?i){MARK}(?:{choice}){MARK}'))"


def host(x: str) -> str:
    return (
        rf"lower(regexp_extract({x}, "
        rf"'^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]*)', 1))"
    )


def clean_markdown(x: str) -> str:
    nav = rf"^[{SP}]*(?:[-*+][{SP}]*)?(?:\[[^\]]*\]\([^)]*\)[{SP}]*)+$"
    image = r"!\[[^\]]*\]\([^)]*\)"
    link = r"\[([^\]]+)\]\([^)]*\)"
    line = strip(f"regexp_replace(l, '{image}', '', 'g')")
    lines = f"list_transform(regexp_split_to_array({x}, '{BREAK}'), lambda l: {line})"
    prose = f"list_filter({lines}, lambda l: NOT regexp_matches(l, '{nav}'))"
    plain = rf"list_transform({prose}, lambda l: regexp_replace(l, '{link}', '\1', 'g'))"
    joined = f"array_to_string({plain}, chr(10))"
    return strip(rf"regexp_replace({joined}, '\n{{3,}}', chr(10) || chr(10), 'g')")


_CASES = """
    CASE WHEN doc_id % 41 = 0 THEN '[deleted]'
         WHEN doc_id % 43 = 0 THEN '   '
         WHEN doc_id % 47 = 0 THEN NULL
         WHEN doc_id % 7 = 1 THEN text || ' write to kim.w+' || doc_id || '@post.example.org today'
         WHEN doc_id % 7 = 2 THEN 'look at HTTPS://pages.example.net/p/' || doc_id || ' and www.example.net/y too ' || text
         WHEN doc_id % 7 = 3 THEN 'as u/kim_' || doc_id || ' put it.' || chr(9) || chr(10) || ' ' || text
         WHEN doc_id % 7 = 4 THEN text || ' credit to /u/Lee-Park.'
         WHEN doc_id % 7 = 5 THEN text || ' cc @lee' || doc_id || ' as well'
         WHEN doc_id % 7 = 6 THEN 'my number is +44 (20) 7946-0018, ' || text
         ELSE text END
"""

_INTRO = (
    "'# Notes' || chr(10) || '![logo](https://cdn.example.net/logo.png)' || chr(10)"
    " || '- [Start](https://b.example.net/) [All notes](https://b.example.net/all/)' || chr(10)"
    " || chr(10) || chr(10) || chr(10)"
    " || 'More in the [full notes](https://b.example.net/full/) on this.' || chr(10) || chr(10)"
)


NEWTON_STEPS = 12


def newton() -> str:
    """Weights b0..b5 of the penalised logistic regression on ``scaled``, by Newton steps spelled out.

    Each step sums gradient and Hessian over the training rows and eliminates one
    unknown after the other.
    """
    k = len(signal.FEATURES) + 1
    x = [f"x{i}" for i in range(k - 1)] + ["1.0"]
    margin = " + ".join(f"b{i} * {x[i]}" for i in range(k))
    steps = [
        """z AS MATERIALIZED (
            SELECT *, CASE WHEN label = 1 THEN n / (2.0 * n1) ELSE n / (2.0 * (n - n1)) END AS w
            FROM scaled, (SELECT count(*) AS n, sum(label) AS n1 FROM scaled WHERE is_train) WHERE is_train)""",
        f"w0 AS (SELECT {', '.join(f'0.0::DOUBLE AS b{i}' for i in range(k))})",
    ]
    for it in range(1, NEWTON_STEPS + 1):
        ridge = [1.0] * (k - 1) + [0.0]
        cells = [f"sum(c * {x[i]} * {x[j]}) + {ridge[i] if i == j else 0.0} AS a{i}{j}" for i in range(k) for j in range(k)]
        cells += [f"sum(r * {x[i]}) + {ridge[i]} * any_value(b{i}) AS a{i}{k}" for i in range(k)]
        kept = ", ".join(f"any_value(b{i}) AS b{i}" for i in range(k))
        steps.append(
            f"""s{it} AS MATERIALIZED (SELECT {kept}, {', '.join(cells)} FROM (
                SELECT *, w * (p - label) AS r, w * p * (1 - p) AS c
                FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM z, w{it - 1})))"""
        )
        below = f"s{it}"
        for m in range(k):
            rows = [
                f"a{i}{j} - a{i}{m} * a{m}{j} / a{m}{m} AS a{i}{j}" if i != m else f"a{m}{j} / a{m}{m} AS a{m}{j}"
                for i in range(k)
                for j in range(m + 1, k + 1)
            ]
            weights = ", ".join(f"b{i}" for i in range(k))
            steps.append(f"e{it}_{m} AS MATERIALIZED (SELECT {weights}, {', '.join(rows)} FROM {below})")
            below = f"e{it}_{m}"
        steps.append(f"w{it} AS (SELECT {', '.join(f'b{i} - a{i}{k} AS b{i}' for i in range(k))} FROM {below})")
    return f"WITH {', '.join(steps)} SELECT * FROM w{NEWTON_STEPS}"


def _week(day: str) -> str:
    return f"CAST(date_trunc('week', {day}) AS DATE)"


CTES: dict[str, str] = {
    "dated_docs": "SELECT *, DATE '2019-01-01' + CAST(doc_id * 7 % 480 AS INT) AS day FROM documents",
    "raw_posts": f"""
        SELECT doc_id, source AS subreddit,
               CASE WHEN doc_id % 31 = 0 THEN NULL WHEN doc_id % 37 = 0 THEN ''
                    ELSE 'user_' || (doc_id % 97) END AS author,
               CASE WHEN doc_id % 53 = 0 THEN 'not-a-date'
                    WHEN doc_id % 29 = 0 THEN strftime(day, '%Y/%-m/%-d')
                    ELSE strftime(day, '%Y/%m/%d') END AS created_date,
               {_CASES} AS post,
               unnest(CASE WHEN doc_id % 10 = 0
                           THEN [CASE WHEN day < DATE '2020-03-11' THEN 'pre' ELSE 'post' END, '2019']
                           ELSE [CASE WHEN day < DATE '2020-03-11' THEN 'pre' ELSE 'post' END] END) AS period
        FROM dated_docs""",
    "bronze": """
        SELECT *, subreddit || '_' || period || '_posts.csv' AS source_file,
               substr(sha1(coalesce(subreddit, '') || '|' || coalesce(author, '') || '|'
                           || coalesce(created_date, '') || '|' || coalesce(post, '')), 1, 16) AS post_id
        FROM raw_posts""",
    "checked": f"""
        SELECT *, {normalize('post')} AS clean,
               coalesce({normalize('post')} NOT IN ('', '[deleted]', '[removed]'), false) AS good_text,
               CAST(try_strptime(created_date, '%Y/%m/%d') AS DATE) AS good_day
        FROM bronze""",
    "deduped": """
        SELECT * FROM checked WHERE good_text AND good_day IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY period, source_file, good_day) = 1""",
    "silver": f"""
        SELECT post_id, subreddit, good_day AS created_date,
               CASE WHEN length(author) > 0 THEN sha256('{V.SALT}:' || author) END AS author_hash,
               {scrub('clean')} AS text, period, source_file
        FROM deduped""",
    "gold_posts": f"""
        SELECT post_id, subreddit, created_date, {_week('created_date')} AS week, author_hash,
               CAST(length(text) AS BIGINT) AS n_chars, CAST({word_count('text')} AS BIGINT) AS n_words
        FROM silver""",
    "hits": f"""
        SELECT post_id, {count_hits('text', V.POSITIVE)} AS pos, {count_hits('text', V.NEGATIVE)} AS neg
        FROM silver""",
    "lexicon_scores": f"""
        SELECT post_id, {round_even("pos / CAST(pos + neg + 1 AS DOUBLE) - neg / CAST(pos + neg + 1 AS DOUBLE)", 4)} AS sentiment_score,
               CASE WHEN neg >= pos AND neg >= 1 THEN 'negative' WHEN pos > 1 THEN 'positive'
                    ELSE 'neutral' END AS sentiment_label
        FROM hits""",
    "weak": f"""
        SELECT post_id,
               CAST(({distinct_hits('text', V.ACUTE)}) >= 1 OR ({distinct_hits('text', V.SEVERE)}) >= 2 AS BIGINT) AS label
        FROM silver""",
    "densities": f"""
        SELECT post_id,
               100.0 * ({count_hits('text', V.SEVERE)}) / greatest({word_count('text')}, 1) AS severe_density,
               100.0 * {count_tokens('text', T.FIRST_PERSON)} / greatest({word_count('text')}, 1) AS first_person_density,
               100.0 * {count_tokens('text', T.NEGATION)} / greatest({word_count('text')}, 1) AS negation_density,
               ln(1 + greatest({word_count('text')}, 1)) AS log_n_words
        FROM silver""",
    "features": """
        SELECT post_id, severe_density, first_person_density, negation_density,
               coalesce(sentiment_score, 0.0) AS sentiment_score, log_n_words
        FROM densities LEFT JOIN lexicon_scores USING (post_id)""",
    "linear": "SELECT post_id, 1 / (1 + exp(-({intercept} + {terms}))) AS p FROM features".format(
        intercept=V.INTERCEPT,
        terms=" + ".join(f"({w}) * {c}" for c, w in V.COEFFICIENTS.items()),
    ),
    "signal_scores": f"""
        SELECT post_id, {round_even("p", 4)} AS crisis_score, p >= {V.THRESHOLD} AS crisis_flag, label
        FROM linear JOIN weak USING (post_id)""",
    "score_bins": """
        SELECT crisis_score AS score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
        FROM signal_scores GROUP BY crisis_score""",
    "split_sizes": "SELECT label, count(*) AS c, sum(count(*)) OVER () AS total FROM weak GROUP BY label",
    "split_shares": """
        SELECT *, floor(0.8 * total) AS target, floor(0.8 * total) * c / total AS exact FROM split_sizes""",
    "split_quotas": """
        SELECT label, floor(exact) + CAST(row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
                      <= target - sum(floor(exact)) OVER () AS INT) AS quota FROM split_shares""",
    "scaled": "SELECT post_id, label, is_train, "
    + ", ".join(
        f"({f} - avg({f}) FILTER (is_train) OVER ()) / coalesce(nullif(stddev_pop({f}) FILTER (is_train) OVER (), 0), 1) AS x{i}"
        for i, f in enumerate(signal.FEATURES)
    )
    + """
        FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(post_id || ':7'), post_id) <= quota AS is_train
              FROM features JOIN weak USING (post_id) JOIN split_quotas USING (label))""",
    "weights": newton(),
    "fitted": f"""
        SELECT post_id, label, is_train, p, {round_even("p", 4)} AS crisis_score
        FROM (SELECT s.*, 1 / (1 + exp(-({" + ".join(f"b{i} * x{i}" for i in range(len(signal.FEATURES)))} + b{len(signal.FEATURES)}))) AS p
              FROM scaled s, weights)""",
    "fitted_weights": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(b{i}, 4) AS coefficient FROM weights" for i, f in enumerate(signal.FEATURES)
    ),
    "valued_orders": """
        SELECT *, (o_totalprice - 250000) / 250009 AS s, CAST(o_orderdate AS DATE) AS day,
               o_orderkey % 11 <> 0 AS scored
        FROM orders""",
    "scored_posts": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS post_id, o_orderpriority AS subreddit, day AS created_date,
               {_week('day')} AS week, sha256('{V.SALT}:' || o_custkey) AS author_hash,
               o_orderkey % 900 + 40 AS n_chars, o_orderkey % 180 + 8 AS n_words,
               CASE WHEN scored THEN s END AS sentiment_score,
               CASE WHEN scored AND s < -0.33 THEN 'negative' WHEN scored AND s > 0.33 THEN 'positive'
                    WHEN scored THEN 'neutral' END AS sentiment_label,
               CASE WHEN scored THEN o_totalprice / 500009 END AS crisis_score,
               CASE WHEN scored THEN o_orderstatus = 'F' END AS crisis_flag
        FROM valued_orders""",
    "weekly": f"""
        SELECT subreddit, week, count(*) AS n_posts, count(DISTINCT author_hash) AS n_active_authors,
               {round_even('avg(n_words)', 2)} AS avg_word_count, avg(sentiment_score) AS sentiment,
               CAST(sum(CAST(crisis_flag AS INT)) AS BIGINT) AS crisis_count,
               sum(CAST(crisis_flag AS INT)) / CAST(count(*) AS DOUBLE) AS crisis_rate
        FROM scored_posts GROUP BY subreddit, week""",
    "overview": f"""
        SELECT subreddit, CAST(sum(n_posts) AS BIGINT) AS posts, {round_even("avg(sentiment)", 3)} AS avg_sentiment,
               CAST(coalesce(sum(crisis_count), 0) AS BIGINT) AS crisis_signals,
               CASE WHEN sum(n_posts) > 0
                    THEN {round_even("coalesce(sum(crisis_count), 0) / CAST(sum(n_posts) AS DOUBLE)", 4)}
                    ELSE 0.0 END AS crisis_share
        FROM weekly GROUP BY subreddit""",
    "answer": """
        SELECT 'Lowest mean sentiment over all weeks: **r/' || (SELECT subreddit FROM overview ORDER BY avg_sentiment, subreddit LIMIT 1)
               || '** ('
               || (SELECT printf('%+.3f', avg_sentiment) FROM overview ORDER BY avg_sentiment, subreddit LIMIT 1)
               || '). Largest share of flagged posts: **r/' || (SELECT subreddit FROM overview ORDER BY crisis_share DESC, subreddit LIMIT 1)
               || '** ('
               || (SELECT CAST(round(CAST(crisis_share AS DECIMAL(9, 4)) * 100, 1) AS DECIMAL(9, 1))
                   FROM overview ORDER BY crisis_share DESC, subreddit LIMIT 1)
               || '%). Both are aggregate figures of whole communities.' AS answer""",
    "addresses": """
        SELECT doc_id AS position, text,
               coalesce(p.url, 'https://docs.example.org/en/') || '#d' || doc_id AS url
        FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages)""",
    "seeds": """
        SELECT position, url,
               CASE WHEN position % 17 <> 0 THEN 'topic' || (position % 6) END AS topic FROM addresses""",
    "allowed": f"SELECT DISTINCT {host('url')} AS host FROM pages WHERE {host('url')} LIKE '%.example.org'",
    "page_markdown": f"""
        SELECT position AS page_id, url,
               CASE WHEN position % 13 = 6 THEN ''
                    ELSE {_INTRO} || replace(text, chr(10), chr(10) || chr(10)) END AS markdown
        FROM addresses""",
    "checked_urls": f"""
        SELECT position, url, coalesce(topic, 'general') AS topic,
               CASE WHEN lower(split_part(url, ':', 1)) <> 'https' THEN 'non-https url'
                    WHEN {host('url')} NOT IN (SELECT host FROM allowed) THEN 'host not on the allowlist' END AS url_reason
        FROM seeds""",
    "cleaned_pages": f"""
        SELECT s.*, m.page_id IS NOT NULL AND s.position % 5 <> 3 AS cached,
               m.markdown, {clean_markdown('m.markdown')} AS text
        FROM checked_urls s LEFT JOIN page_markdown m ON m.page_id = s.position""",
    "crawled": f"""
        SELECT position, url AS seed_url, topic, text, substr(sha256(text), 1, 16) AS content_hash,
               CASE WHEN position % 3 IN (0, 1) THEN 'Title ' || (position % 50)
                    ELSE regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$') END AS title,
               CASE WHEN position % 4 <> 0 THEN url WHEN position % 8 = 0 THEN url || '?via=cache' ELSE url END AS url,
               {host('url')} AS source,
               coalesce(url_reason,
                        CASE WHEN NOT cached THEN 'not cached'
                             WHEN position % 11 = 5 THEN 'unsuccessful payload'
                             WHEN coalesce(markdown, '') = '' THEN 'no markdown'
                             WHEN {word_count('text')} < 80 THEN 'too little prose after cleaning' END) AS reason
        FROM cleaned_pages""",
    "docs": f"""
        SELECT url, title, source, topic, text, '{V.RETRIEVED_AT}' AS retrieved_at, content_hash
        FROM crawled WHERE reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY position) = 1""",
    "all_docs": f"""
        SELECT s.url, regexp_extract(regexp_replace(s.url, '/+$', ''), '[^/]*$') AS title, {host('s.url')} AS source,
               coalesce(s.topic, 'general') AS topic, {clean_markdown('m.markdown')} AS text,
               '{V.RETRIEVED_AT}' AS retrieved_at, substr(sha256({clean_markdown('m.markdown')}), 1, 16) AS content_hash
        FROM seeds s JOIN page_markdown m ON m.page_id = s.position
        QUALIFY row_number() OVER (PARTITION BY substr(sha256({clean_markdown('m.markdown')}), 1, 16) ORDER BY s.position) = 1""",
    "paragraphs": f"""
        SELECT content_hash, p, {word_count('p')} AS n, CAST(i AS INT) AS i
        FROM (SELECT content_hash, unnest(ps) AS p, generate_subscripts(ps, 1) AS i
              FROM (SELECT content_hash,
                           list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {strip('x')}),
                                       lambda x: x <> '') AS ps
                    FROM all_docs))""",
    "packing": f"""
        SELECT content_hash, 0 AS i, CAST([] AS VARCHAR[]) AS buf, 0 AS idx, CAST(NULL AS VARCHAR) AS out FROM all_docs
        UNION ALL
        SELECT s.content_hash, s.i + 1,
               CASE WHEN full_buf
                    THEN [array_to_string({words("array_to_string(buf, ' ')")}[-40:], ' '), p]
                    ELSE list_append(buf, p) END,
               idx + CAST(full_buf AS INT),
               CASE WHEN full_buf THEN array_to_string(buf, chr(10) || chr(10)) END
        FROM (SELECT k.content_hash, k.i, k.buf, k.idx, g.p,
                     len(k.buf) > 0 AND {word_count("array_to_string(k.buf, ' ')")} + g.n > 220 AS full_buf
              FROM packing k JOIN paragraphs g ON g.content_hash = k.content_hash AND g.i = k.i + 1) s""",
    "chunks": """
        SELECT content_hash, out AS text, idx - 1 AS chunk_index FROM packing WHERE out IS NOT NULL
        UNION ALL
        SELECT content_hash, array_to_string(buf, chr(10) || chr(10)), idx
        FROM packing QUALIFY i = max(i) OVER (PARTITION BY content_hash) AND len(buf) > 0""",
    "centroids": """
        SELECT label AS query_id, list(x ORDER BY i) AS q
        FROM (SELECT label, i, avg(embedding[i]) AS x
              FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i) GROUP BY label""",
    "similarities": """
        SELECT c.query_id, e.vec_id AS doc_id, e.label AS topic,
               list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.q) AS cosine,
               -list_distance(CAST(e.embedding AS DOUBLE[]), c.q) AS euclidean
        FROM embeddings e, centroids c""",
    "questions": """
        SELECT conv_id, turn, role,
               CASE WHEN (conv_id + turn) % 5 = 1 THEN 'Who wrote this? ' || text
                    WHEN (conv_id + turn) % 5 = 2 THEN 'how did the mood of the communities change in spring?'
                    WHEN (conv_id + turn) % 5 = 3 THEN '  ' ELSE text END AS question
        FROM conversations""",
}


def compose(body: str) -> str:
    """``body`` preceded by the views it needs, in dependency order."""
    needed: list[str] = []

    def visit(sql: str, own: str | None = None) -> None:
        for name, definition in CTES.items():
            if name != own and name not in needed and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", sql):
                visit(definition, name)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in needed)
    return f"WITH RECURSIVE {ctes}\n{body.strip()}"
