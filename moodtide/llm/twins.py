"""DuckDB SQL for the operators on vectors and for importance resampling."""

from __future__ import annotations

from moodtide.llm import importance, one_bit, urls, vector_codes


def nearest_twin() -> str:
    """Every query against every vector."""
    return f"""
        WITH good AS (
            SELECT DISTINCT vec_id, embedding, embedding::DOUBLE[] AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x) AS score
            FROM good q JOIN good c ON q.vec_id <> c.vec_id OR q.embedding <> c.embedding WHERE q.vec_id % 20 = 0),
        ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
            FROM scored)
        SELECT * FROM ranked WHERE rank <= {one_bit.K}"""


def codes_twin() -> str:
    """The rounds written out."""
    distance = "list_sum(list_transform(list_zip(part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(vector_codes.ROUNDS + 1):
        steps.append(f"""a{r} AS (
            SELECT p, part, any_value(n) AS n, min({{'d': {distance}, 'k': k}}) AS best
            FROM leaves JOIN c{r} USING (p) GROUP BY p, part)""")
        if r < vector_codes.ROUNDS:
            steps.append(f"""m{r} AS (
                SELECT p, best.k AS k, j, floor(sum(n * part[j]) / sum(n))::BIGINT AS x
                FROM a{r}, (SELECT unnest(range(1, max(width) + 1)) AS j FROM kept) GROUP BY ALL),
            c{r + 1} AS (
                SELECT p, k, coalesce(moved, entry) AS entry
                FROM c{r} LEFT JOIN (SELECT p, k, list(x ORDER BY j) AS moved FROM m{r} GROUP BY p, k) USING (p, k))""")
    last = vector_codes.ROUNDS
    return f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, len(embedding) // {vector_codes.PARTS} AS width,
                   list_transform(embedding, lambda x: floor({int(vector_codes.SCALE)} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (
            SELECT r, p, v[p * width + 1 : (p + 1) * width] AS part FROM kept, range({vector_codes.PARTS}) s(p)),
        leaves AS (SELECT p, part, count(*) AS n FROM parts GROUP BY p, part),
        c0 AS (SELECT p, r - 1 AS k, part AS entry FROM parts WHERE r <= {vector_codes.ENTRIES}),
        {", ".join(steps)},
        books AS (
            SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{last}),
        coded AS (
            SELECT r, string_agg(lower(lpad(to_hex(best.k), 2, '0')), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
            FROM parts JOIN a{last} USING (p, part) GROUP BY r)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (r), books"""


def resample_twin() -> str:
    """CRC-32 by a table that SQL makes; features are hashed once each."""

    def grams(table: str, key: str) -> str:
        pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
        triples = "list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])"
        low = f"translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}')"
        return f"""
            SELECT {key}, len(w) AS n_words, list_concat(w, {pairs}, {triples}) AS grams
            FROM (SELECT {key}, regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table})"""

    bits = "list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    bytes_of = "list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)"
    crc = f"list_reduce(list_prepend(4294967295::BIGINT, {bytes_of}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))"
    k = importance.BUCKETS
    return f"""
        WITH d AS ({grams("(SELECT row_number() OVER () AS r, doc_id, text FROM documents)", "r, doc_id")}),
        b AS ({grams("benchmark", "item_id")}),
        steps AS (SELECT list({bits} ORDER BY i) AS t FROM range(256) x(i)),
        ours AS (SELECT r, unnest(grams) AS f FROM d),
        theirs AS (SELECT unnest(grams) AS f FROM b),
        hashed AS (
            SELECT f, xor({crc}, 4294967295) % {k} AS bucket
            FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM ours UNION SELECT f FROM theirs)), steps),
        s AS (SELECT bucket, count(*) AS s FROM ours JOIN hashed USING (f) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM theirs JOIN hashed USING (f) GROUP BY bucket),
        sums AS (SELECT (SELECT count(*) FROM ours) + {k}::DOUBLE AS s_all, (SELECT count(*) FROM theirs) + {k}::DOUBLE AS t_all),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * s_all / ((coalesce(s, 0) + 1)::DOUBLE * t_all)))::BIGINT AS gain
            FROM s FULL JOIN t USING (bucket), sums),
        weights AS (
            SELECT r, sum(gain) AS weight FROM ours JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY r),
        scored AS (
            SELECT d.doc_id, n_words, len(grams) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   ('0x' || substr(sha256('{importance.SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
            FROM d LEFT JOIN weights USING (r)),
        final AS (
            SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
        ranks AS (
            SELECT *, row_number() OVER (PARTITION BY n_words >= {importance.MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
                   {importance.PERCENT} * count(*) OVER (PARTITION BY n_words >= {importance.MIN_WORDS}) // 100 AS draw
            FROM final)
        SELECT doc_id, n_words, n_features, weight, score,
               CASE WHEN n_words >= {importance.MIN_WORDS} AND place <= draw THEN place END AS rank
        FROM ranks"""
