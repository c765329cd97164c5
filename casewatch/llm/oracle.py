"""DuckDB SQL for the queries that SQL can express, built from the same rule tables."""

from __future__ import annotations

import string

from casewatch.llm.centroids import CENTROIDS, ROUNDS, SCALE, SEED, WIDTH
from casewatch.llm.common import SPACE_CLASS
from casewatch.llm.quality_rules import LANGUAGES, MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, SYMBOLS
from casewatch.llm.url_filters import PATTERN_RULES, SITE_RULES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _failing() -> str:
    limits = [f"{r.measure} < {r.low}" for r in RULES if r.low is not None]
    limits += [f"{r.measure} > {r.high}" for r in RULES if r.high is not None]
    return " OR ".join(f"coalesce({limit}, false)" for limit in limits)


def quality_rules_sql() -> str:
    stop, languages = (", ".join(map(_text, sorted(set(x)))) for x in (STOP_WORDS, LANGUAGES))
    return rf"""
    WITH texts AS (
        SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
               lang IS NULL OR lower(lang) IN ({languages}) AS listed,
               regexp_extract_all(coalesce(text, ''), '[^{SPACE_CLASS}]+') AS ws,
               [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^{SPACE_CLASS}]')] AS ls
        FROM documents
    ), windows AS (
        SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS n
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM texts)
    ), repeats AS (
        SELECT rid, count(DISTINCT spot) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS spot FROM windows WHERE n > 1)
        GROUP BY rid
    ), counted AS (
        SELECT doc_id, listed, len(ws) AS n_words, coalesce(list_sum([length(w) FOR w IN ws]), 0)::BIGINT AS word_chars,
               len(regexp_extract_all(t, '[{SYMBOLS}]')) AS n_symbols,
               len(ls) AS n_lines, len(ls) - list_unique(ls)::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
               len([w FOR w IN ws IF list_contains([{stop}], lower(w))]) AS n_stop_words
        FROM texts LEFT JOIN repeats USING (rid)
    ), ratios AS (
        SELECT *, CASE WHEN listed THEN word_chars / nullif(n_words, 0) END AS chars_per_word, n_symbols / nullif(n_words, 0) AS symbols_per_word,
               CASE WHEN listed THEN n_stop_words / nullif(n_words, 0) END AS stop_word_ratio, n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio,
               n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
        FROM counted
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT ({_failing()}) AS kept
    FROM ratios
    """


def url_filters_sql() -> str:
    rules = ", ".join(f"({_text(r.action)}, {_text(r.site)})" for r in SITE_RULES)
    blocked = " OR ".join(f"regexp_matches(url, {_text(r.pattern)})" for r in PATTERN_RULES)
    return f"""
    WITH rules AS (
        SELECT action, site, site[:instr(site, '/') - 1] AS rule_host, site[instr(site, '/'):] AS rule_path
        FROM (VALUES {rules}) AS v(action, site)
    ), places AS (
        SELECT row_number() OVER () AS rid, page_id, url,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                         '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), best AS (
        SELECT rid, arg_max(site, length(site)) AS rule, arg_max(action, length(site)) AS action
        FROM places JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY rid
    )
    SELECT page_id, host, path, rule,
           coalesce(action, CASE WHEN coalesce({blocked}, false) THEN 'block' ELSE 'allow' END) AS verdict
    FROM places LEFT JOIN best USING (rid)
    """


def warc_sql() -> str:
    alphabet = string.ascii_uppercase + "234567"
    fives = ", ".join(f"('0x' || digest[{5 * k + 1}:{5 * k + 5}])::BIGINT" for k in range(8))
    letters = " || ".join(f"'{alphabet}'[((v >> {s}) & 31) + 1]" for s in (15, 10, 5, 0))
    return f"""
    WITH payloads AS (
        SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
    ), ranked AS (
        SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM payloads
    )
    SELECT page_id, octet_length(encode(html)) AS payload_bytes,
           list_aggregate([{letters} FOR v IN [{fives}]], 'string_agg', '') AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
    FROM ranked
    """


def _crc32_rows() -> str:
    """The remainder of each byte for the reversed polynomial of CRC-32, as an SQL list."""
    rows = list(range(256))
    for _ in range(8):
        rows = [(r >> 1) ^ (0xEDB88320 if r & 1 else 0) for r in rows]
    return "[" + ", ".join(map(str, rows)) + "]::BIGINT[]"


def prefix_trie_sql() -> str:
    step = f"xor(a >> 8, ({_crc32_rows()})[(xor(a, b) & 255) + 1])"
    letters = "list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')])"
    return f"""
    WITH turns AS MATERIALIZED (
        SELECT conv_id, chars, item, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item[:32]) AS spot
        FROM (
            SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
                   sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item
            FROM conversations WHERE conv_id IS NOT NULL
        )
    ), convs AS MATERIALIZED (
        SELECT conv_id, conv_id - conv_id % 100 AS base,
               xor(list_reduce({letters}, lambda a, b: {step}), 4294967295) % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)
    ), rebuilt AS (
        SELECT c.conv_id, 0 AS part, b.spot, b.item, b.chars FROM convs c JOIN turns b ON b.conv_id = c.base AND b.spot <= c.h
        UNION ALL SELECT t.conv_id, 1, t.spot, t.item, t.chars FROM turns t JOIN convs c USING (conv_id) WHERE t.spot > c.h
    ), paths AS MATERIALIZED (
        SELECT conv_id, list(item) OVER w AS path, row_number() OVER w AS depth, chars,
               count(*) OVER (PARTITION BY conv_id) AS len
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, spot)
        UNION ALL
        SELECT conv_id, []::VARCHAR[], 0, 0, (SELECT count(*) FROM rebuilt r WHERE r.conv_id = c.conv_id) FROM convs c
    ), nodes AS MATERIALIZED (
        SELECT path, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(chars) AS chars,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len), '')) AS ends_sha256
        FROM paths GROUP BY path
    ), children AS (
        SELECT path[:-2] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
    ), counted AS MATERIALIZED (
        SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (path)
    ), sums AS (
        SELECT path[:up] AS path, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves,
               sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
        FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY 1
    )
    SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
    FROM counted c JOIN sums USING (path) LEFT JOIN nodes p ON c.depth > 0 AND p.path = c.path[:-2]
    """


def centroids_sql() -> str:
    """All rounds written out; numbers are exact, as sums stay below 2^53 on the tables compared."""
    nearest = """
        SELECT rid, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
            SELECT rid, cluster, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(v.q, c.q)])::BIGINT AS d
            FROM vectors v, {0} c) GROUP BY rid"""
    rounds = []
    for k in range(ROUNDS):
        rounds.append(f"near{k} AS MATERIALIZED ({nearest.format(f'centroids{k}')})")
        rounds.append(f"""centroids{k + 1} AS MATERIALIZED (
        SELECT cluster, coalesce(m.q, c.q) AS q FROM centroids{k} c LEFT JOIN (
            SELECT cluster, list(floor(total / n)::BIGINT ORDER BY place) AS q FROM (
                SELECT cluster, place, sum(x) AS total, count(*) AS n
                FROM (SELECT rid, unnest(q) AS x, generate_subscripts(q, 1) AS place FROM vectors) JOIN near{k} USING (rid)
                GROUP BY cluster, place) GROUP BY cluster) m USING (cluster))""")
    steps = ",\n    ".join(rounds)
    return f"""
    WITH vectors AS MATERIALIZED (
        SELECT vec_id, row_number() OVER () AS rid, [floor({SCALE} * x)::BIGINT FOR x IN values] AS q
        FROM (SELECT vec_id, embedding::DOUBLE[] AS values FROM embeddings)
        WHERE len(values) = {WIDTH} AND list_bool_and([coalesce(isfinite(x), false) FOR x IN values])
    ), centroids0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, q) - 1 AS cluster, q
        FROM vectors QUALIFY cluster < {CENTROIDS}
    ), {steps},
    final AS MATERIALIZED ({nearest.format(f"centroids{ROUNDS}")})
    SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
           sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
    FROM final JOIN vectors USING (rid) JOIN centroids{ROUNDS} c USING (cluster)
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op4_quality_rules": quality_rules_sql(),
        "op5_url_filters": url_filters_sql(),
        "op8_warc": warc_sql(),
        "op11_prefix_trie": prefix_trie_sql(),
        "op13_centroid_clustering": centroids_sql(),
    }
