"""SQL for DuckDB with the same rows, for the queries of this package that SQL can express.

None for the others: learned models (4, 8), spans that a validator and context decide (2), permutations
(5), byte-level tokens (7) and HTML (10) are held against brute force in tests/llm.
"""

from __future__ import annotations

_RULES = "(VALUES ('allow','com','/'),('block','example.com','/en/'),('allow','www.example.com','/en/'),('block','net','/es/'),('block','net','/fr/'))"


def _clustering(k: int = 40, rounds: int = 5) -> str:
    """All vectors against all centroids in each round, one after the other."""
    steps = [
        """kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v,
                sha256('2:' || vec_id) AS h
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM kept ORDER BY h LIMIT {k})""",
    ]
    for turn in range(rounds + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (
            SELECT vec_id, any_value(p.v) AS v, min({{'d': list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c}}) AS best
            FROM kept p, c{turn} c GROUP BY vec_id)""")
        if turn < rounds:
            steps.append(f"""c{turn + 1} AS MATERIALIZED (
                SELECT old.c, coalesce(new.v, old.v) AS v FROM c{turn} old LEFT JOIN (
                    SELECT c, list((s - (s % n + n) % n) // n ORDER BY i) AS v FROM (
                        SELECT c, i, sum(x) AS s, count(*) AS n FROM (
                            SELECT best.c AS c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{turn}) GROUP BY c, i) GROUP BY c) new USING (c))""")
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
            sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(list_transform(c{rounds}.v, lambda x: x::VARCHAR), ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = best.c"""


SQL = {
    "op1_url_filters": rf"""
        WITH parts AS (
            SELECT row_number() OVER () AS r, page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages),
        rules AS (SELECT * FROM {_RULES} AS t(verdict, rule_host, rule_path)),
        best AS (
            SELECT r, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                max_by(verdict, length(rule_host || rule_path)) AS verdict
            FROM parts JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY r)
        SELECT page_id, host, path, rule,
            coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[^a-z0-9])(casino|cheap|pills|porn|spam|viagra|xxx)($|[^a-z0-9])')
                THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts LEFT JOIN best USING (r)""",
    "op3_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
                ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM words),
        each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
            FROM each x JOIN each y ON x.g = y.g AND x.doc_id < y.doc_id
                AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM shared WHERE 100 * c >= 80 * (na + nb - c)
            UNION ALL SELECT b, a FROM shared WHERE 100 * c >= 80 * (na + nb - c)),
        reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)""",
    "op6_quality_rules": r"""
        WITH words AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM documents),
        each AS (
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
        again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM each) WHERE c > 1),
        inside AS (
            SELECT doc_id, count(DISTINCT i + shift) AS n FROM again, (VALUES (0), (1), (2)) AS s(shift) GROUP BY doc_id),
        m AS (
            SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
                length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
                len(regexp_extract_all(t, '!!( |\n)')) AS n_shouted, len(list_filter(w, lambda x: x = '|')) AS n_bars
            FROM words LEFT JOIN inside USING (doc_id)),
        f AS (
            SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
                + 4 * (100 * n_symbols > 10 * word_chars)::BIGINT
                + 8 * (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)::BIGINT
                + 16 * (word_chars > 20 * n_words)::BIGINT + 32 * (word_chars < 2 * n_words)::BIGINT
                + 64 * (100 * n_upper > 40 * word_chars)::BIGINT + 128 * (100 * n_shouted > 30 * n_words)::BIGINT
                + 256 * (100 * n_bars > 15 * n_words)::BIGINT AS failed_bits FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            failed_bits & 3 != 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM f""",
    "op9_exact_dedup": r"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
            doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM n""",
    "op11_phrases": r"""
        WITH pieces AS MATERIALIZED (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
        counts AS MATERIALIZED (
            SELECT lang, p, count(*) AS f FROM (SELECT lang, w[i:i + m - 1] AS p
                FROM starts, (VALUES (1), (2), (3), (4)) AS t(m) WHERE i + m - 1 <= len(w)) GROUP BY lang, p HAVING count(*) >= 30),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
        cuts AS (SELECT lang, p, f AS a, k, p[:k] AS x, p[k + 1:] AS y FROM (
            SELECT *, unnest(range(1, len(p))) AS k FROM counts WHERE len(p) > 1)),
        lowest AS (
            SELECT cuts.lang AS lang, cuts.p AS p, a,
                min({'score': (2000000::HUGEINT * a) // (u.f + v.f), 'k': k, 'l': u.f, 'r': v.f}) AS cut
            FROM cuts JOIN counts u ON u.lang = cuts.lang AND u.p = x JOIN counts v ON v.lang = cuts.lang AND v.p = y GROUP BY ALL),
        inside AS (
            SELECT lang, p[i:i + m - 1] AS p, max(f) AS most
            FROM (SELECT *, unnest(range(1, len(p) - m + 2)) AS i FROM counts, (VALUES (2), (3)) AS t(m) WHERE len(p) > m) GROUP BY ALL),
        kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, p) WHERE most IS NULL OR 100 * most < 80 * a),
        ranked AS (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, array_to_string(p, ' ')) AS rank,
                array_to_string(p, ' ') AS phrase, a, cut.l AS l, cut.r AS r, cut.score::BIGINT AS score FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
    "op12_clustering": _clustering(),
    "op13_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        shown AS (
            SELECT *, regexp_replace(regexp_replace(role || chr(0) || text, '<(\\*)(/?s>)', '<\\\1\2', 'g'),
                '\[(\\*)(/?(?:INST|ROLE|SYS)\]|(?:IMAGE|AUDIO|DOCUMENT) [0-9]+\])', '[\\\1\2', 'g') AS q FROM turns)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
            (3 + sum(length(q) - 1 + 13 + 4))::BIGINT AS formatted_chars
        FROM shown GROUP BY conv_id""",
}
