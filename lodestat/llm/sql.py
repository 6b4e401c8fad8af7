"""DuckDB SQL for the queries that SQL can express."""

ORACLES = {
    "op6_contamination": r"""
        WITH L AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
             B AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
             S AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM B WHERE len(w) > 0),
             W AS (SELECT item_id, least(13, len(w)) AS n, array_to_string(w[s:s + 12], ' ') AS t FROM S),
             K AS (SELECT DISTINCT n FROM W),
             D AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM L, K WHERE len(w) >= n),
             M AS (SELECT DISTINCT doc_id, s, n, item_id FROM (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM D) JOIN W USING (n, t)),
             H AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM M) GROUP BY doc_id),
             I AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
                   FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM M) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM L LEFT JOIN H USING (doc_id) LEFT JOIN I USING (doc_id)""",
    "op7_exact_duplicates": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)""",
    "op8_chat_format": r"""
        WITH r AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
                   UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
             e AS (SELECT *, length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '<', '\<')) AS n FROM r),
             g AS (SELECT conv_id, count(*) AS n_turns,
                          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
                          coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                          CAST(sum(n + length(role) + 4 + 1 + 8) AS BIGINT) AS formatted_chars
                   FROM e GROUP BY conv_id)
        SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
        FROM g""",
    "op12_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                          list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
             l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
             m AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
                          [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                           regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f
                   FROM t LEFT JOIN l USING (doc_id)),
             c AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (bad) AS b FROM m GROUP BY part, f),
             x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
             o AS (SELECT [ascii(p.x) - 64, ascii(q.x) - 64, ascii(r.x) - 64, ascii(s.x) - 64, ascii(u.x) - 64] AS o, p.x || q.x || r.x || s.x || u.x AS filter_order
                   FROM x p, x q, x r, x s, x u WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
             k AS (SELECT *, unnest(range(1, 6)) AS step FROM o),
             y AS (SELECT part, filter_order, step, o[step] AS letter, n, g, b, f[o[step]] AS fails,
                          list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])) AS gone, len(list_filter(f, lambda v: v)) = 1 AS alone
                   FROM c, k),
             s AS (SELECT part, filter_order, step, letter, CAST(sum(n) FILTER (NOT coalesce(gone, false) AND NOT fails) AS BIGINT) AS kept,
                          CAST(sum(n) FILTER (fails AND NOT coalesce(gone, false)) AS BIGINT) AS removed,
                          CAST(sum(n) FILTER (fails AND gone) AS BIGINT) AS redundant, CAST(sum(n) FILTER (fails AND alone) AS BIGINT) AS unique_fails,
                          CAST(sum(g) FILTER (fails AND NOT coalesce(gone, false)) AS BIGINT) AS good_lost,
                          CAST(sum(b) FILTER (fails AND NOT coalesce(gone, false)) AS BIGINT) AS toxic_lost FROM y GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
               coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
               coalesce(toxic_lost, 0) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM s""",
    "op13_importance_resampling": r"""
        WITH z AS (SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                               lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS z FROM range(256) r(i)),
             d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
             b AS (SELECT unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS w FROM benchmark),
             a AS (SELECT doc_id, unnest(w) AS w FROM d),
             v AS (SELECT w, list_transform(range(0, octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)) AS y
                   FROM (SELECT w FROM a UNION SELECT w FROM b)),
             h AS (SELECT w, xor(list_reduce(list_concat([4294967295], y), lambda c, x: xor(c >> 8, z[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295) % 10000 AS k FROM v, z),
             s AS (SELECT k, count(*) AS n FROM a JOIN h USING (w) GROUP BY k),
             t AS (SELECT k, count(*) AS n FROM b JOIN h USING (w) GROUP BY k),
             g AS (SELECT k, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM a) + 10000.0::DOUBLE)
                          / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM b) + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (k)),
             q AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM a JOIN h USING (w) JOIN g USING (k) GROUP BY doc_id),
             e AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                          coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                     / 4294967296::DOUBLE))) AS BIGINT) AS score
                   FROM d LEFT JOIN q USING (doc_id)),
             r AS (SELECT *, n_features >= 20 AS fit, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                          count(*) FILTER (n_features >= 20) OVER () AS n FROM e)
        SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 10 * n // 100 THEN place END AS rank FROM r""",
}
