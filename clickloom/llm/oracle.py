"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from clickloom.llm.common import LOWER, UPPER

_WORDS = (
    f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

# Runs that are long enough to count, each as the rule's own pattern would find it.
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_RULES = (("assign", 0, _ASSIGN, 2, 8), ("access", 1, "AKIA[A-Z0-9]{12,}", 0, 16), ("hex", 2, "[0-9a-f]{32,}", 0, 32))
_MATCHES = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, {least} AS least, regexp_split_to_array(t, '{pattern}') AS parts,
        regexp_extract_all(t, '{pattern}') AS whole, regexp_extract_all(t, '{pattern}', {group}) AS part FROM d"""
    for kind, rank, pattern, group, least in _RULES
)

ORACLES: dict[str, str] = {
    "op3_preferences": """
        WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        ans AS (
            SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS j, count(*) OVER (PARTITION BY conv_id) AS n
            FROM t WHERE role = 'assistant' AND turn IS NOT NULL
        ),
        pair AS (
            SELECT l.conv_id, l.turn, l.text AS mine, a.turn AS leaves,
                coalesce(lead(l.text) OVER (ORDER BY l.conv_id), first_value(l.text) OVER (ORDER BY l.conv_id)) AS other
            FROM ans l JOIN ans a ON a.conv_id = l.conv_id AND a.j = ((l.conv_id % l.n) + l.n) % l.n WHERE l.j = l.n - 1
        ),
        side AS (
            SELECT 'a' AS side, t.conv_id, t.turn, t.role, t.text FROM t JOIN pair USING (conv_id) WHERE t.turn < pair.turn
            UNION ALL SELECT 'b', t.conv_id, t.turn, t.role, t.text FROM t JOIN pair USING (conv_id) WHERE t.turn < pair.leaves
            UNION ALL SELECT 'a', conv_id, turn, 'assistant', mine FROM pair
            UNION ALL SELECT 'b', conv_id, leaves, 'assistant', other FROM pair
        ),
        num AS (
            SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS r,
                row_number() OVER (PARTITION BY side, conv_id ORDER BY turn, role, text) AS i
            FROM side
        ),
        same AS (
            SELECT a.conv_id, coalesce(min(a.i) FILTER (b.i IS NULL OR a.role <> b.role OR a.text <> b.text) - 1, count(*)) AS n_shared
            FROM (SELECT * FROM num WHERE side = 'a') a LEFT JOIN (SELECT * FROM num WHERE side = 'b') b USING (conv_id, i) GROUP BY a.conv_id
        ),
        placed AS (
            SELECT *, sum(length(r)) OVER (PARTITION BY side, conv_id, i > n_shared ORDER BY i) AS stop FROM num JOIN same USING (conv_id)
        )
        SELECT conv_id, CAST(n_shared AS INTEGER) AS n_shared,
            coalesce(string_agg(r, '' ORDER BY i) FILTER (side = 'a' AND i <= n_shared), '') AS prompt,
            coalesce(string_agg(r, '' ORDER BY i) FILTER (side = 'a' AND i > n_shared), '') AS chosen,
            coalesce(string_agg(r, '' ORDER BY i) FILTER (side = 'b' AND i > n_shared), '') AS rejected,
            coalesce(string_agg((stop - length(r) + 14) || ':' || (stop - 1), ',' ORDER BY i) FILTER (side = 'a' AND i > n_shared AND role = 'assistant'), '') AS chosen_mask,
            coalesce(string_agg((stop - length(r) + 14) || ':' || (stop - 1), ',' ORDER BY i) FILTER (side = 'b' AND i > n_shared AND role = 'assistant'), '') AS rejected_mask
        FROM placed GROUP BY conv_id, n_shared
    """,
    "op4_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
        win AS (
            SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
            FROM b, unnest(range(1, len(w) - n + 2)) t(s)
        ),
        dw AS (
            SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
            FROM d, (SELECT DISTINCT n FROM win) k, unnest(range(1, len(w) - n + 2)) t(s)
        ),
        hit AS (SELECT doc_id, s, n, item_id FROM dw JOIN win USING (n, g)),
        pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) u(p) GROUP BY doc_id),
        ids AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
    """,
    "op5_secrets": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        m AS ({_MATCHES}),
        n AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM m),
        s AS (
            SELECT doc_id, kind, rank, whole[i] AS match,
                list_sum(list_transform(parts[1:i], lambda q: length(q)))
                    + coalesce(list_sum(list_transform(whole[1:i - 1], lambda q: length(q))), 0) AS start
            FROM n WHERE length(part[i]) >= least
        ),
        j AS (
            SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
                string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(match) AS BIGINT), ',' ORDER BY start, rank) AS spans
            FROM s GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
            sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents LEFT JOIN j USING (doc_id)
    """,
    "op8_embeddings": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
        ),
        reach AS (SELECT a AS n, a AS m FROM link UNION SELECT reach.n, link.b FROM reach JOIN link ON link.a = reach.m),
        root AS (SELECT n, min(m) AS root FROM reach GROUP BY n),
        deg AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
        FROM embeddings LEFT JOIN deg ON a = vec_id LEFT JOIN root ON n = vec_id
    """,
    "op11_phrases": rf"""
        WITH piece AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
            FROM (
                SELECT coalesce(lang, 'und') AS lang,
                    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents
            )
        ),
        start AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece),
        gram AS (
            SELECT lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, k FROM start, range(1, 6) t(k) WHERE i + k - 1 <= len(w)
        ),
        total AS (SELECT lang, count(*) AS n FROM start GROUP BY lang),
        f AS (SELECT lang, phrase, k, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100),
        kept AS (
            SELECT * FROM f c WHERE k > 1 AND NOT EXISTS (
                SELECT 1 FROM f o WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.f >= 100 * c.f AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')
            )
        ),
        cut AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM kept),
        scored AS (
            SELECT cut.lang, cut.phrase, a, l.f AS l, r.f AS r, n, c,
                (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
            FROM cut JOIN total ON total.lang = cut.lang
                JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(list_slice(w, 1, c), ' ')
                JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(list_slice(w, c + 1, len(w)), ' ')
        ),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM weakest QUALIFY rank <= 2000
    """,
    "op12_prefix_trie": """
        WITH own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        conv AS (
            SELECT conv_id AS c, conv_id - conv_id % 5 AS base,
                xor(4294967295, list_reduce(
                    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
                    lambda crc, byte: list_reduce(
                        range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, byte)
                    ),
                    4294967295
                )) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM own)
        ),
        rows AS (
            SELECT c, 0 AS part, place, role, text FROM conv JOIN own ON own.conv_id = conv.base WHERE place <= h
            UNION ALL SELECT c, 1, place, role, text FROM conv JOIN own ON own.conv_id = conv.c WHERE place > h
        ),
        path AS (
            SELECT conv.c, coalesce(list({'role': role, 'text': text} ORDER BY part, place) FILTER (part IS NOT NULL), []) AS turns
            FROM conv LEFT JOIN rows ON rows.c = conv.c GROUP BY conv.c
        ),
        member AS (SELECT c, d, turns[:d] AS prefix, turns, d = len(turns) AS ended FROM path, range(0, 4000) t(d) WHERE d <= len(turns)),
        node AS (
            SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs,
                (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(any_value(prefix[d].text))) END AS spared,
                sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
            FROM member GROUP BY prefix, d
        ),
        child AS (SELECT prefix[:d - 1] AS prefix, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
        down AS (SELECT node.prefix[:u] AS prefix, spared, child.prefix IS NULL AS leaf FROM node LEFT JOIN child ON child.prefix = node.prefix, range(0, 4000) t(u) WHERE u <= d),
        total AS (SELECT prefix, sum(spared) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM down GROUP BY prefix)
        SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
            n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
        FROM node JOIN total ON total.prefix = node.prefix LEFT JOIN child ON child.prefix = node.prefix
            LEFT JOIN node up ON up.prefix = node.prefix[:node.d - 1] AND up.d = node.d - 1
    """,
    "op13_mixing": r"""
        WITH doc AS (SELECT source, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
        src AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS most,
                (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM doc GROUP BY source
        ),
        -- Sources in the order in which they reach their limit; the first that does not reach it sets the share of all behind it.
        level AS (
            SELECT *, sum(most) OVER () // 3 - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS spare, row_number() OVER o AS i
            FROM src WINDOW o AS (ORDER BY most * 6 // weight, source NULLS LAST)
        ),
        free AS (SELECT * FROM level WHERE rest * weight <= most * spare ORDER BY i LIMIT 1),
        goal AS (
            SELECT level.source, level.source_size,
                CASE WHEN level.i < free.i THEN CAST(level.most AS DOUBLE) ELSE CAST(free.rest * level.weight AS DOUBLE) / CAST(free.spare AS DOUBLE) END AS target,
                CASE WHEN level.i < free.i THEN level.most ELSE free.rest * level.weight // free.spare END AS budget
            FROM level, free
        ),
        named AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id, size) - 1 AS copy FROM doc),
        placed AS (
            SELECT *, sum(size) OVER (
                PARTITION BY source ORDER BY md5(coalesce('=' || doc_id, 'null') || ':' || size || ':' || copy), doc_id, size, copy
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
            ) - size AS before
            FROM named
        )
        SELECT doc_id, size, source_size, target,
            CAST(CASE WHEN source_size = 0 THEN 0 ELSE
                budget // source_size * size + least(greatest(budget - budget // source_size * source_size - before, 0), size) END AS BIGINT) AS taken
        FROM placed JOIN goal ON goal.source IS NOT DISTINCT FROM placed.source
    """,
}
