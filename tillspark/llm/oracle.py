"""SQL for the corpus queries whose results SQL can state, over the same tables."""

from __future__ import annotations

from tillspark.llm import host_reputation

#: The url rules of the query.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

_WORDS = "'[^\\x20\\x09-\\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES)
_BETWEEN = "sum((n - 1) * p * (1 - p))"
_BEYOND = "(sum(n * (bad / n - p) ** 2) - sum(p * (1 - p)))"
_WEAKEST, _STRONGEST = host_reputation.WEAKEST, host_reputation.STRONGEST
_STRENGTH = f"""CASE WHEN coalesce({_BETWEEN}, 0) = 0 OR {_BEYOND} <= 0 THEN {_STRONGEST}
             ELSE least({_STRONGEST}, greatest({_WEAKEST}, {_BETWEEN} / {_BEYOND} - 1)) END"""

#: The checksum of a conversation's number in decimal, bit by bit, before its last step.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                      lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(0, 8) AS BIGINT[])), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))"""

ORACLE_SQL = {
    "op2_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h,
                     max(page_id) OVER (PARTITION BY sha1(payload)) AS last FROM p),
        b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111',
                     '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', h[i])]), '') AS bits FROM d)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
                   1 + CAST(list_sum(list_transform(range(1, 6), lambda j: CAST(bits[5 * k + j] AS INTEGER) * (1 << (5 - j)))) AS BIGINT)]), '') AS payload_digest,
               CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
        FROM b
    """,
    "op5_host_reputation": f"""
        WITH pages_ AS (SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                               coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
        known AS (SELECT doc_id AS id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
        h AS (SELECT host, string_split(host, '.')[-1] AS suffix, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
                     CAST(coalesce(sum(n), 0) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad
              FROM pages_ LEFT JOIN known ON page_id = id GROUP BY host),
        o AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS p FROM h),
        s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(o.p) AS p FROM h, o GROUP BY suffix),
        s1 AS (SELECT *, (SELECT {_STRENGTH} FROM s0 WHERE n > 1) AS k FROM s0),
        s AS (SELECT suffix, (bad + k * p) / (n + k) AS p FROM s1),
        d0 AS (SELECT h.suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(s.p) AS p FROM h JOIN s ON h.suffix = s.suffix GROUP BY h.suffix, domain),
        d1 AS (SELECT *, (SELECT {_STRENGTH} FROM d0 WHERE n > 1) AS k FROM d0),
        d AS (SELECT domain, (bad + k * p) / (n + k) AS p FROM d1),
        h0 AS (SELECT h.host, h.n, h.bad, d.p FROM h JOIN d ON h.domain = d.domain),
        h1 AS (SELECT *, (SELECT {_STRENGTH} FROM h0 WHERE n > 1) AS k FROM h0),
        r AS (SELECT host, (bad + k * p) / (n + k) AS rate, n + k AS weight FROM h1),
        v AS (SELECT host, greatest(rate - {host_reputation.WIDTH} * sqrt(rate * (1 - rate) / (weight + 1)), 0) > {host_reputation.LIMIT} AS blocked FROM r),
        rules(rule, verdict) AS (VALUES {_RULES}),
        f AS (SELECT page_id, pages_.host, path, max(struct_pack(l := length(rule), rule := rule, verdict := verdict)) AS best
              FROM pages_ LEFT JOIN rules ON ('.' || pages_.host) LIKE ('%.' || string_split(rule, '/')[1])
                   AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY ALL)
        SELECT page_id, f.host, path, best.rule AS rule,
               coalesce(best.verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
        FROM f JOIN v ON f.host = v.host
    """,
    "op9_repeats": f"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS words FROM documents),
        s AS (SELECT doc_id, k, array_to_string(words[k : k + 19], ' ') AS t
              FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS k FROM w)),
        l AS (SELECT doc_id, k, row_number() OVER (PARTITION BY t ORDER BY doc_id, k) > 1 AS again FROM s),
        g AS (SELECT DISTINCT doc_id, k + j AS place FROM l, range(0, 20) r(j) WHERE again),
        x AS (SELECT doc_id, list(place) AS gone FROM g GROUP BY doc_id),
        e AS (SELECT w.doc_id, words, coalesce(gone, []) AS gone FROM w LEFT JOIN x ON w.doc_id = x.doc_id)
        SELECT doc_id, len(words) AS n_words, len(gone) AS n_removed,
               sha256(array_to_string(list_filter(words, lambda v, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256
        FROM e
    """,
    "op10_set_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER},
                                              {_WORDS}) AS words FROM documents),
        t AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                     ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda k: array_to_string(words[k : k + 2], ' '))) END AS s FROM w),
        c AS (SELECT s, min(doc_id) AS class FROM (SELECT doc_id, list_sort(s) AS s FROM t) GROUP BY s),
        m AS (SELECT t.doc_id, len(t.s) AS n_shingles, CASE WHEN len(t.s) = 0 THEN t.doc_id ELSE class END AS class
              FROM t JOIN c ON list_sort(t.s) = c.s),
        u AS (SELECT class, len(s) AS n, unnest(s) AS x FROM c WHERE len(s) > 0),
        p AS (SELECT a.class AS a, b.class AS b FROM u a JOIN u b ON a.x = b.x AND a.class < b.class
                   AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
              GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
        r AS (SELECT DISTINCT class AS a, class AS b FROM m UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
        k AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
        SELECT doc_id, n_shingles, component_id FROM m JOIN k ON m.class = k.a
    """,
    "op13_prefix_trie": f"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        s AS (SELECT conv_id, list({{'id': md5(length(role) || ':' || role || text), 'words': len(regexp_extract_all(text, {_WORDS}))}}
                                   ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id),
        h AS (SELECT *, CAST(xor({_CRC}, 4294967295) % 4 AS BIGINT) AS h FROM s),
        r AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1 : h.h], []), h.turns[h.h + 1 :]) AS path
              FROM h LEFT JOIN s b ON b.conv_id = h.conv_id - h.conv_id % 20),
        p AS (SELECT conv_id, d, len(path) = d AS ends, array_to_string(list_transform(path[1 : d], lambda x: x.id), '') AS node,
                     CASE WHEN d > 0 THEN path[d].words ELSE 0 END AS words
              FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM r)),
        n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                     sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
              FROM p GROUP BY node, d),
        c AS (SELECT left(node, 32 * (d - 1)) AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
        k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON n.node = c.node),
        a AS (SELECT left(node, 32 * up) AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
              FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM k) GROUP BY 1)
        SELECT k.conv_id, k.d AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves,
               CAST(a.saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
        FROM k JOIN a ON k.node = a.node LEFT JOIN n u ON k.d > 0 AND u.node = left(k.node, 32 * (k.d - 1))
    """,
}
