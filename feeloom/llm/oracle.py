"""DuckDB SQL for the queries that SQL can express. Written from the definitions, not from the Spark plans."""

from __future__ import annotations

ORACLE_SQL = {
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, t.i AS i, t.line AS line,
                   CAST(('0x' || substr(md5(t.line), 1, 7)) AS BIGINT) AS h
            FROM (SELECT doc_id, unnest(list_zip(range(len(string_split(text, chr(10)))), string_split(text, chr(10)))) AS z
                  FROM documents WHERE text IS NOT NULL), (SELECT 1)
                 CROSS JOIN LATERAL (SELECT z[1] AS i, z[2] AS line) t
        ), ends AS (
            SELECT *, i > 0 AND ((lag(h) OVER w) * 1000003 + h) % 2147483647 % 3 = 0 AS is_end
            FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)
        ), numbered AS (
            SELECT *, coalesce(sum(CAST(is_end AS BIGINT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
            FROM ends
        ), chunks AS (
            SELECT doc_id, place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk,
                   bool_or(trim(line, ' ') <> '') AS has_text
            FROM numbered GROUP BY doc_id, place
        ), gone AS (
            SELECT doc_id, place, n FROM (
                SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, place) AS nth
                FROM chunks WHERE n >= 2 AND has_text) WHERE nth > 1
        ), kept AS (
            SELECT c.doc_id, CAST(sum(c.n) AS BIGINT) AS n_lines, CAST(coalesce(sum(g.n), 0) AS BIGINT) AS n_removed_lines,
                   count(g.n) AS n_removed_chunks,
                   coalesce(string_agg(c.chunk, chr(10) ORDER BY c.place) FILTER (g.n IS NULL), '') AS kept
            FROM chunks c LEFT JOIN gone g USING (doc_id, place) GROUP BY c.doc_id
        )
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines,
               coalesce(n_removed_chunks, 0) AS n_removed_chunks, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept USING (doc_id)
    """,
    "op6_source_mix": r"""
        WITH sized AS (
            SELECT doc_id, source, source IS NULL AS no_source, coalesce(source, '') AS name,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS HUGEINT) AS size,
                   md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
            FROM documents
        ), sources AS (
            SELECT no_source, name, sum(size) AS total FROM sized GROUP BY ALL
        ), weighted AS (
            SELECT *, 3 * total AS cap,
                   CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY no_source, encode(name)) - 1) % 3] AS HUGEINT) AS weight
            FROM sources
        ), levels AS (
            SELECT sum(total) OVER () - coalesce(sum(cap) OVER w, 0) AS words, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS rest
            FROM weighted
            WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE), no_source, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), level AS (
            SELECT words, rest FROM levels ORDER BY CAST(words AS DOUBLE) / CAST(rest AS DOUBLE) DESC, rest DESC LIMIT 1
        ), planned AS (
            SELECT no_source, name, total,
                   CASE WHEN cap * rest <= weight * words THEN CAST(cap AS DOUBLE)
                        ELSE CAST(weight * words AS DOUBLE) / CAST(rest AS DOUBLE) END AS target, cap
            FROM weighted, level
        ), placed AS (
            SELECT s.*, total, target, least(CAST(floor(target + 0.5) AS HUGEINT), cap) AS budget,
                   coalesce(sum(size) OVER (PARTITION BY no_source, name ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM sized s JOIN planned USING (no_source, name)
        )
        SELECT doc_id, source, CAST(size AS BIGINT) AS size, CAST(total AS BIGINT) AS source_size, target,
               CAST(CASE WHEN total = 0 THEN 0
                         ELSE (budget // total) * size + greatest(0, least(size, budget % total - before)) END AS BIGINT) AS taken
        FROM placed
    """,
    "op10_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+'), []) AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
                                           ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END) AS s
            FROM words
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)
        ), both_ways AS (
            SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reach AS (
            SELECT a AS doc_id, a AS r FROM both_ways
            UNION
            SELECT t.b, r FROM reach JOIN both_ways t ON t.a = reach.doc_id
        )
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(min(r), w.doc_id) AS component_id
        FROM words w LEFT JOIN sizes USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY w.doc_id, n
    """,
    "op13_prefix_trie": r"""
        WITH own AS (
            SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                                      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), hashed AS (
            SELECT *, xor(list_reduce(
                       list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                       lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                                                     lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
                   4294967295) % 6 AS h
            FROM own
        ), rebuilt AS (
            SELECT x.c, list_concat(coalesce(b.turns[1:x.h], []), x.turns[x.h + 1:]) AS turns
            FROM hashed x LEFT JOIN own b ON b.c = x.c - x.c % 100
        ), paths AS (
            SELECT c, turns, CAST(unnest(range(len(turns) + 1)) AS BIGINT) AS d FROM rebuilt
        ), keyed AS (
            SELECT c, d, turns[1:d] AS p, turns[1:d - 1] AS q, len(turns) = d AS is_end, CASE WHEN d = 0 THEN 0 ELSE length(turns[d].t) END AS chars
            FROM paths
        ), nodes AS (
            SELECT d, CASE WHEN d = 0 THEN [] ELSE p END AS p, CASE WHEN d < 2 THEN [] ELSE q END AS q, min(c) AS conv_id, count(*) AS n,
                   (count(*) - 1) * max(chars) AS saved,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '')) AS ends
            FROM keyed GROUP BY ALL
        ), kids AS (
            SELECT q AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
        ), full_nodes AS (
            SELECT x.*, coalesce(k.n, 0) AS n_children FROM nodes x LEFT JOIN kids k ON k.d = x.d AND k.p = x.p
        ), above AS (
            SELECT CASE WHEN a = 0 THEN [] ELSE p[1:a] END AS p, a AS d, saved, n_children
            FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_nodes)
        ), totals AS (
            SELECT p, d, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM above GROUP BY ALL
        )
        SELECT x.conv_id, x.d AS depth, up.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children, CAST(t.leaves AS BIGINT) AS n_leaves,
               CAST(t.saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
        FROM full_nodes x JOIN totals t ON t.d = x.d AND t.p = x.p
        LEFT JOIN nodes up ON up.d = x.d - 1 AND up.p = x.q
    """,
}
