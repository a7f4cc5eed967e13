"""The same results in DuckDB SQL, for the operators that SQL can express on whole tables."""

from tarmac.llm.secrets import ASSIGN

ORACLE_SQL = {
    "op4_block_naming_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY body)""",
    "op7_adaptive_quality": r"""
        WITH t AS (
            SELECT doc_id, lang, source, coalesce(text, '') AS body,
                list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        numbered AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t),
        windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM numbered),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
            SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY doc_id),
        m AS (
            SELECT t.doc_id, lang, source, len(w) AS n_words,
                length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                coalesce(covered.n, 0) AS n_repeat_words
            FROM t LEFT JOIN covered USING (doc_id)),
        rates AS (
            SELECT doc_id, lang, source, 'symbol' AS rate, n_symbols * 1000 // nullif(word_chars, 0) AS v FROM m UNION ALL
            SELECT doc_id, lang, source, 'repeat', n_repeat_words * 1000 // nullif(n_words, 0) FROM m UNION ALL
            SELECT doc_id, lang, source, 'line', n_dup_lines * 1000 // nullif(n_lines, 0) FROM m UNION ALL
            SELECT doc_id, lang, source, 'length', word_chars * 100 // nullif(n_words, 0) FROM m),
        b AS (
            SELECT *, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket
            FROM rates WHERE v IS NOT NULL),
        q AS (
            SELECT lang, source, rate, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3
            FROM b GROUP BY ALL),
        q2 AS (
            SELECT lang, rate, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3
            FROM b GROUP BY ALL),
        q3 AS (SELECT rate, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM b GROUP BY ALL),
        chosen AS (
            SELECT q.lang, q.source, q.rate,
                CASE WHEN q.n >= 200 THEN q.q1 WHEN q2.n >= 200 THEN q2.q1 ELSE q3.q1 END AS q1,
                CASE WHEN q.n >= 200 THEN q.q3 WHEN q2.n >= 200 THEN q2.q3 ELSE q3.q3 END AS q3
            FROM q LEFT JOIN q2 ON q.lang IS NOT DISTINCT FROM q2.lang AND q.rate = q2.rate JOIN q3 ON q.rate = q3.rate),
        outside AS (
            SELECT doc_id, bool_or(
                v > c.q3 + 3 * greatest(c.q3 - c.q1, CASE c.rate WHEN 'symbol' THEN 30 WHEN 'repeat' THEN 100 WHEN 'line' THEN 150 ELSE 60 END)
                OR c.rate = 'length' AND v < c.q1 - 3 * greatest(c.q3 - c.q1, 60)) AS bad
            FROM b JOIN chosen c ON b.lang IS NOT DISTINCT FROM c.lang AND b.source IS NOT DISTINCT FROM c.source
                AND b.rate = c.rate
            GROUP BY doc_id)
        SELECT m.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
            n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT coalesce(bad, false) AS kept
        FROM m LEFT JOIN outside USING (doc_id)""",
    "op9_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        e AS (
            SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS opens,
                length(replace(replace(replace(replace(replace(text, '\', '\\'), '[INST]', '[\INST]'),
                    '[/INST]', '[\/INST]'), '<s>', '<\s>'), '</s>', '<\/s>')) AS text_chars,
                length(replace(replace(replace(replace(replace(role, '\', '\\'), '[INST]', '[\INST]'),
                    '[/INST]', '[\/INST]'), '<s>', '<\s>'), '</s>', '<\/s>')) AS role_chars
            FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(text_chars + CASE WHEN opens THEN 17 + role_chars ELSE 3 END)::BIGINT AS formatted_chars,
            (count(*) FILTER (opens))::INTEGER AS n_blocks
        FROM e GROUP BY conv_id""",
    "op6_markov_secrets": r"""
        WITH RECURSIVE kinds(kind, rank, pattern) AS (VALUES
            ('assign', 0, '%s'), ('access', 1, 'AKIA[A-Z0-9]{16,}'), ('hex', 2, '[0-9a-f]{24,}'),
            ('markov', 3, '[A-Za-z0-9+/_=-]{16,}')),
        t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        cut AS (
            SELECT doc_id, kind, rank, string_split_regex(body, pattern) AS parts, regexp_extract_all(body, pattern) AS found,
                CASE kind WHEN 'assign' THEN regexp_extract_all(body, '%s', 1) ELSE regexp_extract_all(body, pattern) END AS vals
            FROM t, kinds WHERE regexp_matches(body, pattern)),
        numbered AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM cut),
        steps AS (SELECT doc_id, kind, rank, i, length(parts[i]) + length(found[i]) AS step, length(found[i]) AS n,
            vals[i] AS value FROM numbered),
        spans AS (
            SELECT doc_id, kind, rank, value, sum(step) OVER (PARTITION BY doc_id, kind ORDER BY i) - n AS s,
                sum(step) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e
            FROM steps),
        base AS (SELECT * FROM spans WHERE kind <> 'markov' AND (kind <> 'assign' OR length(value) >= 6)),
        -- ordinary words: maximal runs of the alphabet between the spans of the fixed patterns
        alone AS (
            SELECT doc_id, s, e FROM (
                SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                FROM base) WHERE before IS NULL OR s > before),
        runs AS (
            SELECT b.doc_id, a.s, max(b.e) AS e
            FROM base b ASOF JOIN alone a ON b.doc_id = a.doc_id AND b.s >= a.s GROUP BY b.doc_id, a.s),
        gaps AS (
            SELECT doc_id, coalesce(lag(e) OVER w, 0) AS f, s AS u FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY s)
            UNION ALL SELECT doc_id, max(e), NULL FROM runs GROUP BY doc_id),
        pieces AS (
            SELECT t.doc_id, substr(body, f::BIGINT + 1, coalesce(u, length(body))::BIGINT - f::BIGINT) AS piece
            FROM gaps JOIN t USING (doc_id)
            UNION ALL SELECT doc_id, body FROM t WHERE doc_id NOT IN (SELECT doc_id FROM runs)),
        samples AS (
            SELECT value, true AS random FROM base UNION ALL
            SELECT unnest(regexp_extract_all(piece, '[A-Za-z0-9+/_=-]{4,}')), false FROM pieces),
        grouped AS (SELECT value, random, count(*) AS n FROM samples GROUP BY ALL),
        pairs AS (
            SELECT random, n, CASE WHEN i = 1 THEN 0 ELSE ascii(substr(value, i - 1, 1)) END AS a, ascii(substr(value, i, 1)) AS b
            FROM (SELECT *, unnest(range(1, length(value) + 1)) AS i FROM grouped)),
        counts AS (SELECT random, a, b, sum(n) AS n FROM pairs GROUP BY ALL),
        totals AS (SELECT random, a, sum(n) AS n FROM counts GROUP BY ALL),
        judged AS (
            SELECT * FROM spans c WHERE kind = 'markov'
                AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.s < c.e AND c.s < b.e)),
        steps2 AS (
            SELECT doc_id, s, e, CASE WHEN i = 1 THEN 0 ELSE ascii(substr(value, i - 1, 1)) END AS a,
                ascii(substr(value, i, 1)) AS b
            FROM (SELECT *, unnest(range(1, length(value) + 1)) AS i FROM judged)),
        scored AS (
            SELECT doc_id, s, e, sum(floor(1000 * (
                ln((coalesce(c1.n, 0) + 1)::DOUBLE / (coalesce(t1.n, 0) + 67)::DOUBLE)
                - ln((coalesce(c0.n, 0) + 1)::DOUBLE / (coalesce(t0.n, 0) + 67)::DOUBLE)) + 0.5)) AS ratio
            FROM steps2 p
            LEFT JOIN counts c1 ON c1.random AND c1.a = p.a AND c1.b = p.b LEFT JOIN totals t1 ON t1.random AND t1.a = p.a
            LEFT JOIN counts c0 ON NOT c0.random AND c0.a = p.a AND c0.b = p.b
            LEFT JOIN totals t0 ON NOT t0.random AND t0.a = p.a
            GROUP BY doc_id, s, e),
        every AS (
            SELECT doc_id, kind, rank, s, e FROM base UNION ALL
            SELECT doc_id, 'markov', 3, s, e FROM scored WHERE ratio >= 12000)
        SELECT t.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
            count(*) FILTER (kind = 'hex') AS n_hex,
            sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'markov'), ''))
                AS base_sha256,
            coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank), '') AS spans
        FROM t LEFT JOIN every USING (doc_id) GROUP BY t.doc_id""".replace("%s", ASSIGN.replace("'", "''")),
    "op12_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM w, (VALUES (1), (2), (3)) sizes(k)),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
        cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM cand),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
                (1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
        weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inner_parts AS (
            SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
            FROM cand WHERE k = 3),
        covered AS (SELECT lang, phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
        ranked AS (
            SELECT v.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM weakest v LEFT JOIN covered USING (lang, phrase)
            WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_nra_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sizes),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, corpus),
        impact AS (
            SELECT tf.doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len))) AS impact
            FROM tf JOIN w USING (term) JOIN sizes USING (doc_id), corpus),
        asked AS (
            SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        scored AS (
            SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impact USING (term)
            GROUP BY item_id, doc_id HAVING sum(impact) > 0)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
        FROM scored QUALIFY rank <= 20""",
}
