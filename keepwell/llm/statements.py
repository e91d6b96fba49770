"""DuckDB statements of the operators that SQL can express on whole tables."""

from __future__ import annotations

LLM_SQL: dict[str, str] = {
    "op1_threshold_topk": r"""
        WITH fine AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM fine q JOIN fine c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op3_chat_formatting": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), turns AS (
            SELECT *, row_number() OVER w AS i, coalesce(lag(role) OVER w <> role, true) AS opens
            FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), sized AS (
            -- a backslash stands behind every "<", "[" and "|" of a text or role
            SELECT *, length(text) + length(regexp_replace(text, '[^<\[|]', '', 'g')) AS body,
                   CASE WHEN opens THEN CASE WHEN i = 1 THEN 3 ELSE 4 END + 2 + 3 + length(role)
                                        + length(regexp_replace(role, '[^<\[|]', '', 'g'))
                        ELSE 5 END AS head
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(head + body) + 4 AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op6_ngram_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT DISTINCT r, w[i : i + 4] AS g
            FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
        ), sizes AS (
            SELECT r, count(*) AS n FROM sets GROUP BY r
        ), common AS (
            SELECT a.r AS a, b.r AS b, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.r < b.r GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
            WHERE 100 * c >= 80 * (x.n + y.n - c)
        ), edges AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached AS (
            SELECT r AS a, r AS b FROM d UNION SELECT reached.a, edges.b FROM reached JOIN edges ON edges.a = reached.b
        ), least AS (
            SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN d ON d.r = reached.b GROUP BY a
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN sizes USING (r) JOIN least USING (r)
    """,
    "op10_quality_rules": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), repeated AS (
            SELECT r, count(DISTINCT p) AS n FROM (
                SELECT r, unnest(range(i, i + 8)) AS p FROM (
                    SELECT r, unnest(places) AS i FROM (
                        SELECT r, list(i) AS places
                        FROM (SELECT r, i, w[i : i + 7] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8))
                        GROUP BY r, g HAVING count(*) > 1)))
            GROUP BY r
        ), lines AS (
            SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
        ), measured AS (
            SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
                   len(l) AS n_lines
            FROM d JOIN lines USING (r) LEFT JOIN repeated USING (r)
        ), judged AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
        ), features AS (
            SELECT r, lang, source, unnest([
                {'feature': 'symbol_ratio', 'width': 3.0e0, 'least': 0.03e0, 'low': false, 'v': n_symbols / greatest(n_words, 1)},
                {'feature': 'dup_line_ratio', 'width': 3.0e0, 'least': 0.2e0, 'low': false, 'v': n_dup_lines / greatest(n_lines, 1)},
                {'feature': 'repeat_ratio', 'width': 3.0e0, 'least': 0.1e0, 'low': false, 'v': n_repeat_words / greatest(n_words, 1)},
                {'feature': 'word_length', 'width': 8.0e0, 'least': 0.3e0, 'low': true, 'v': word_chars / greatest(n_words, 1)}
            ], recursive := true)
            FROM judged WHERE NOT base_failed
        ), binned AS (
            SELECT *, CASE WHEN v < 1e-6 THEN -10000 ELSE CAST(ceil(ln(v) / ln(1.02020202020202e0)) AS INTEGER) END AS bin FROM features
        ), scopes AS (
            SELECT 'own' AS scope, lang, source, feature, bin, count(*) AS n FROM binned GROUP BY ALL
            UNION ALL SELECT 'lang', lang, NULL, feature, bin, count(*) FROM binned GROUP BY ALL
            UNION ALL SELECT 'all', NULL, NULL, feature, bin, count(*) FROM binned GROUP BY ALL
        ), running AS (
            SELECT *, sum(n) OVER (PARTITION BY scope, lang, source, feature ORDER BY bin) AS upto,
                   sum(n) OVER (PARTITION BY scope, lang, source, feature) AS total FROM scopes
        ), bins AS (
            SELECT scope, lang, source, feature, max(total) AS total,
                   min(bin) FILTER (upto >= 0.25e0 * total) AS low, min(bin) FILTER (upto >= 0.75e0 * total) AS high
            FROM running GROUP BY ALL
        ), quartiles AS (
            SELECT scope, lang, source, feature, total,
                   CASE WHEN low = -10000 THEN 0.0e0 ELSE 2 * pow(1.02020202020202e0, low) / (1.02020202020202e0 + 1) END AS low,
                   CASE WHEN high = -10000 THEN 0.0e0 ELSE 2 * pow(1.02020202020202e0, high) / (1.02020202020202e0 + 1) END AS high
            FROM bins
        ), checked AS (
            SELECT b.r, v, width, least, b.low AS two_sided,
                   CASE WHEN o.total >= 50 THEN o.low WHEN l.total >= 50 THEN l.low ELSE a.low END AS q1,
                   CASE WHEN o.total >= 50 THEN o.high WHEN l.total >= 50 THEN l.high ELSE a.high END AS q3
            FROM binned b
            JOIN quartiles o ON o.scope = 'own' AND o.feature = b.feature AND o.lang IS NOT DISTINCT FROM b.lang
                            AND o.source IS NOT DISTINCT FROM b.source
            JOIN quartiles l ON l.scope = 'lang' AND l.feature = b.feature AND l.lang IS NOT DISTINCT FROM b.lang
            JOIN quartiles a ON a.scope = 'all' AND a.feature = b.feature
        ), verdicts AS (
            SELECT r, bool_and(v <= q3 + width * greatest(q3 - q1, least)
                               AND v >= CASE WHEN two_sided THEN q1 - width * greatest(q3 - q1, least) ELSE -1 END) AS fits
            FROM checked GROUP BY r
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND coalesce(fits, true) AS kept
        FROM judged LEFT JOIN verdicts USING (r)
    """,
    "op12_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, m, w[i : i + m - 1] AS g
            FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
                  FROM (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0))
        ), phrases AS (
            SELECT row_number() OVER () AS phrase, m, g FROM (SELECT DISTINCT m, g FROM windows)
        ), grams AS (
            SELECT r, m, i, w[i : i + m - 1] AS g
            FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
                  FROM d, (SELECT DISTINCT m FROM phrases) WHERE len(w) >= m)
        ), found AS (
            SELECT r, i, m, phrase FROM grams JOIN phrases USING (m, g)
        ), hits AS (
            SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM found) GROUP BY r
        ), named AS (
            SELECT r, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
            FROM (SELECT DISTINCT r, phrase FROM found) JOIN phrases USING (phrase) JOIN windows USING (m, g) GROUP BY r
        ), words AS (
            SELECT r, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d
        ), terms AS (
            SELECT phrase, m, unnest(g) AS t, unnest(range(0, m)) AS k FROM phrases
        ), rare AS (
            -- each phrase's rarest word proposes starts; the others are looked up from there
            SELECT phrase, m, arg_min(k, n) AS k, arg_min(t, n) AS t
            FROM (SELECT phrase, m, k, terms.t, coalesce(n, 0) AS n FROM terms
                  LEFT JOIN (SELECT t, count(*) AS n FROM words GROUP BY t) c ON c.t = terms.t)
            GROUP BY phrase, m
        ), starts AS (
            SELECT DISTINCT r, phrase, m, p - k + e AS s
            FROM words JOIN rare ON words.t = rare.t, (SELECT unnest(range(-2, 3)) AS e)
        ), near AS (
            SELECT r, phrase FROM (
                SELECT starts.r, starts.phrase, s, starts.m
                FROM starts JOIN terms ON terms.phrase = starts.phrase
                JOIN words ON words.r = starts.r AND words.t = terms.t AND words.p - s - terms.k BETWEEN -2 AND 2
                GROUP BY starts.r, starts.phrase, s, starts.m HAVING count(DISTINCT terms.k) = starts.m)
        ), near_items AS (
            SELECT r, count(DISTINCT item_id) AS n_near_items
            FROM (SELECT DISTINCT r, phrase FROM near) JOIN phrases USING (phrase) JOIN windows USING (m, g) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
               coalesce(n_near_items, 0) AS n_near_items
        FROM d LEFT JOIN hits USING (r) LEFT JOIN named USING (r) LEFT JOIN near_items USING (r)
    """,
}
