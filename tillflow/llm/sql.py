"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

import re
import string

from tillflow.llm.license_rules import rules
from tillflow.llm.licenses import SURE
from tillflow.llm.vafile import CENTROIDS, ROUNDS, SCALE, SEED, SIZE

BASE32 = string.ascii_uppercase + "234567"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_scan() -> str:
    """Every rule over every text; words stand two blanks apart, so that matches share none."""
    table = ", ".join(
        f"({r.number}, {quoted(r.label)}, {r.priority}, "
        f"{quoted(' (' + re.sub(r'(?<!\[\^) ', '  ', r.expression) + ') ')}, {str(r.base).lower()})"
        for r in rules()
    )
    sure = " ".join(f"WHEN {priority} THEN {value}" for priority, value in SURE.items())
    return f"""
        WITH rules(rule, label, priority, expression, base) AS (VALUES {table}),
        worded AS (
            SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM documents
        ), marked AS (
            SELECT n, rule, label, priority, base,
                string_split(trim(regexp_replace(' ' || array_to_string(w, '  ') || ' ', expression,
                    ' ' || chr(1) || '\\1' || chr(2) || ' ', 'g'), ' '), '  ') AS parts
            FROM worded, rules
            WHERE regexp_matches(' ' || array_to_string(w, '  ') || ' ', expression)
        ), places AS (
            SELECT n, rule, label, priority, base,
                list_filter(range(len(parts)), lambda i: starts_with(parts[i + 1], chr(1))) AS a,
                list_filter(range(len(parts)), lambda i: ends_with(parts[i + 1], chr(2))) AS b
            FROM marked
        ), found AS (
            SELECT n, rule, label, priority, base, unnest(a) AS a, unnest(b) AS b FROM places
        ), judged AS (
            SELECT f.*, NOT EXISTS (
                SELECT 1 FROM found g WHERE g.n = f.n AND g.a <= f.a AND g.b >= f.b
                    AND (g.priority > f.priority OR (g.priority = f.priority
                        AND (g.b - g.a > f.b - f.a OR g.rule < f.rule)))) AS kept
            FROM found f
        ), seen AS (
            SELECT n, count(*) FILTER (base) AS n_base, min(a) FILTER (base) AS first_word,
                max(a) FILTER (base) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR kept) AS labels,
                max(CASE priority {sure} END) FILTER (kept) AS score
            FROM judged GROUP BY n
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
            first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
            coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
            coalesce(score, 0)::DOUBLE AS score
        FROM worded LEFT JOIN seen USING (n)
    """


def centroid_rounds() -> str:
    """The rounds written out one after the other."""
    parts = [
        f"""kept AS (
            SELECT row_number() OVER () AS n, vec_id,
                list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = {SIZE}
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        f"cells AS (SELECT n, unnest(range({SIZE})) AS j, unnest(v) AS x FROM kept)",
        f"""starts AS (
            SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR), v) - 1 AS k, n
            FROM kept WHERE vec_id IS NOT NULL QUALIFY k < {CENTROIDS}
        )""",
        "c0 AS MATERIALIZED (SELECT k, j, x AS m FROM starts JOIN cells USING (n))",
    ]
    for r in range(ROUNDS + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
                SELECT n, k, d FROM (
                    SELECT n, k, sum((x - m) * (x - m))::BIGINT AS d FROM cells JOIN c{r} USING (j) GROUP BY n, k
                ) QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, k) = 1
            )"""
        )
        if r < ROUNDS:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
                    SELECT c.k, c.j, coalesce(t.m, c.m) AS m FROM c{r} c LEFT JOIN (
                        SELECT k, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
                        FROM a{r} JOIN cells USING (n) GROUP BY k, j
                    ) t ON t.k = c.k AND t.j = c.j
                )"""
            )
    return f"""
        WITH {", ".join(parts)},
        marks AS (SELECT k, sha256(string_agg(m::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k)
        SELECT vec_id, k::INT AS cluster, d AS distance,
            (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM a{ROUNDS} JOIN kept USING (n) JOIN marks USING (k)
    """


SQL: dict[str, str] = {
    "op12_license_scan": license_scan(),
    "op13_va_file": centroid_rounds(),
    # Base 32 of a SHA-1: every five hexadecimal digits are four characters.
    "op2_warc_chunks": f"""
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
                max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
            FROM pages
        )
        SELECT page_id, payload_bytes,
            list_aggregate(list_transform(range(32), lambda i: substr('{BASE32}', 1 + (
                (('0x' || substr(hex, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT, 1)),
                'string_agg', '') AS payload_digest,
            CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
        FROM payloads
    """,
    "op7_jaccard_join": f"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            END) AS shingle
            FROM worded
        ), sizes AS (
            SELECT doc_id, count(shingle) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
        ), shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
            FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
            GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * both_have >= 75 * (x.n + y.n - both_have)
        ), reach AS (
            SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        )
        SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(min(b), doc_id)) AS component_id
        FROM sizes LEFT JOIN reach ON a = doc_id GROUP BY doc_id, n
    """,
    "op10_exact_dedup": f"""
        WITH normal AS (
            SELECT doc_id, translate(coalesce(text, ''),
                '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t
            FROM documents
        )
        SELECT doc_id,
            max(doc_id) OVER same AS keep_id,
            count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept,
            sha256(t) AS text_sha256
        FROM normal
        WINDOW same AS (PARTITION BY t)
    """,
}
