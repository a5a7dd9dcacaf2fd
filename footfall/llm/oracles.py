"""DuckDB SQL for the queries that SQL can express on whole tables."""



def _clusters_sql(k: int, rounds: int, seed: str) -> str:
    """Lloyd's rounds over integer components, one pair of CTEs a round."""
    parts = [f"""
        WITH kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), flat AS (
            SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept
        ), first AS (
            SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept
        ), c0 AS (
            SELECT f.c, p.i, p.x FROM first f JOIN flat p USING (vec_id) WHERE f.c < {k}
        )"""]
    for r in range(rounds + 1):
        parts.append(f""", a{r} AS (
            SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d
            FROM (SELECT f.vec_id, c.c, sum((f.x - c.x) * (f.x - c.x)) AS d
                  FROM flat f JOIN c{r} c USING (i) GROUP BY f.vec_id, c.c)
            GROUP BY vec_id
        )""")
        if r < rounds:
            parts.append(f""", m{r} AS (
            SELECT a.c, f.i, CAST(sum(f.x) AS BIGINT) AS s, count(*) AS n FROM a{r} a JOIN flat f USING (vec_id) GROUP BY a.c, f.i
        ), c{r + 1} AS (
            SELECT c.c, c.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x
            FROM c{r} c LEFT JOIN m{r} m ON m.c = c.c AND m.i = c.i
        )""")
    parts.append(f"""
        SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
               CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
        FROM a{rounds} a
        JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h
        USING (c)
    """)
    return "".join(parts)


ORACLES = {
    "op1_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), each AS (
            SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM split
        ), keyed AS (
            SELECT doc_id, pos, line,
                   translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM each
        ), often AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (o.key IS NULL), '')) AS kept_sha256
        FROM keyed k LEFT JOIN often o ON k.key = o.key
        GROUP BY doc_id
    """,
    "op4_benchmark_decontamination": r"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', item_id, text FROM benchmark
        ), split AS (
            SELECT kind, id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
            FROM texts
        ), windows AS (
            SELECT DISTINCT id AS item_id, least(13, len(words)) AS n,
                   array_to_string(words[s : s + least(13, len(words)) - 1], ' ') AS win
            FROM (SELECT id, words, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS s
                  FROM split WHERE kind = 'i' AND len(words) > 0)
        ), sizes AS (
            SELECT DISTINCT n FROM windows
        ), places AS (
            SELECT id AS doc_id, n, s, array_to_string(words[s : s + n - 1], ' ') AS win
            FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS s
                  FROM split, sizes WHERE kind = 'd' AND len(words) >= n)
        ), found AS (
            SELECT DISTINCT p.doc_id, p.s, p.n, w.item_id FROM places p JOIN windows w USING (n, win)
        ), hit AS (
            SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM found) GROUP BY doc_id
        ), listed AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
        )
        SELECT d.id AS doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM (SELECT id, words FROM split WHERE kind = 'd') d
        LEFT JOIN hit ON hit.doc_id = d.id LEFT JOIN listed ON listed.doc_id = d.id
    """,
    "op10_url_redirects": r"""
        WITH RECURSIVE page AS (
            SELECT page_id, url, coalesce(html, '') AS html,
                   coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '') AS raw_host,
                   coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
            FROM pages
        ), split AS (
            SELECT *, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM page
        ), rules(verdict, rhost, rpath) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                   ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), links AS (
            SELECT url AS a, unnest(list_concat(
                list_transform(regexp_extract_all(html, '(<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>)', 1, 'is'),
                               lambda t: regexp_extract(t, '\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'is')),
                list_transform(regexp_extract_all(html, '(<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>)', 1, 'is'),
                               lambda t: regexp_extract(t, '\burl\s*=\s*["'']?([^"''\s>]+)', 1, 'is')))) AS target
            FROM split
        ), pairs AS (
            SELECT a, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
                           WHEN starts_with(target, '//') THEN 'http:' || target
                           WHEN starts_with(target, '/') THEN regexp_extract(a, '^(.*?://[^/?#]*)', 1, 's') || target
                           ELSE rtrim(regexp_extract(a, '^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1, 's'), '/') || '/' || target
                      END AS b
            FROM links WHERE target <> ''
        ), forms AS (
            SELECT a AS url FROM pairs UNION SELECT b FROM pairs UNION SELECT url FROM pages
        ), parts AS (
            SELECT url, translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path,
                   regexp_extract(url, '^.*?://[^?#]*(\?[^#]*)', 1, 's') AS query
            FROM forms
        ), nodes AS (
            SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || query AS node FROM parts WHERE host <> ''
        ), fits AS (
            SELECT url, rhost || rpath AS rule, verdict,
                   row_number() OVER (PARTITION BY url ORDER BY length(rhost || rpath) DESC, verdict) AS nr
            FROM nodes JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
        ), own AS (
            SELECT url, rule, verdict FROM fits WHERE nr = 1
        ), edges AS (
            SELECT x.node AS u, y.node AS v FROM pairs JOIN nodes x ON x.url = a JOIN nodes y ON y.url = b
        ), near AS (
            SELECT u, v FROM edges UNION SELECT v, u FROM edges
        ), reach AS (
            SELECT u, v FROM near UNION SELECT reach.u, near.v FROM reach JOIN near ON reach.v = near.u
        ), alias AS (
            SELECT u AS node, max(verdict = 'allow') AS allowed
            FROM reach JOIN nodes n ON n.node = reach.v JOIN own USING (url) GROUP BY u
        )
        SELECT page_id, s.host, s.path, own.rule,
               coalesce(own.verdict, CASE WHEN allowed THEN 'allow' WHEN NOT allowed THEN 'block' END, 'allow') AS verdict
        FROM split s LEFT JOIN own ON own.url = s.url LEFT JOIN nodes n ON n.url = s.url LEFT JOIN alias ON alias.node = n.node
    """,
    # crc32 over the decimal id: each byte is followed by seven zeros, one bit step for each entry
    "op11_merkle_manifest": r"""
        WITH RECURSIVE framed AS (
            SELECT doc_id, source,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS others,
                   coalesce(strlen(text) || ':' || text, '-') AS same,
                   coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-') AS cut,
                   list_reduce(
                       list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
                           string_split(CAST(doc_id AS VARCHAR), ''),
                           lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
                       lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))) AS crc_flipped
            FROM documents
        ), leaves AS (
            SELECT doc_id, source, sha256(others || same) AS leaf,
                   -- the checksum is the flipped register: even where the register is odd
                   sha256(others || CASE WHEN crc_flipped % 2 = 1 THEN cut ELSE same END) AS held,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place,
                   count(*) OVER (PARTITION BY source) AS n
            FROM framed
        ), nodes AS (
            SELECT source, 0 AS level, place AS idx, leaf AS digest, n FROM leaves
            UNION ALL
            SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
            FROM nodes WHERE n > 1 GROUP BY source, level, idx // 3, n
        ), subroots AS (
            SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
                   count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ), tops AS (
            SELECT 0 AS level, place AS idx, subroot AS digest, n FROM subroots
            UNION ALL
            SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
            FROM tops WHERE n > 1 GROUP BY level, idx // 3, n
        ), powers AS (
            SELECT level, CAST(3 ** level AS BIGINT) AS width FROM range(40) t(level) WHERE level < 30
        ), below AS (
            SELECT l.doc_id, n.level, n.level AS step,
                   coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx < l.place // p.width), '')
                   || '|' || coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx > l.place // p.width), '') AS pair
            FROM leaves l JOIN powers p ON true
            JOIN nodes n ON n.level = p.level AND n.source IS NOT DISTINCT FROM l.source AND n.n > 1
                AND n.idx // 3 = l.place // p.width // 3
            GROUP BY l.doc_id, n.level
        ), above AS (
            SELECT s.source, 100 + t.level AS step,
                   coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx < s.place // p.width), '')
                   || '|' || coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx > s.place // p.width), '') AS pair
            FROM subroots s JOIN powers p ON true
            JOIN tops t ON t.level = p.level AND t.n > 1 AND t.idx // 3 = s.place // p.width // 3
            GROUP BY s.source, t.level
        ), paths AS (
            SELECT doc_id, list(pair ORDER BY step) AS path
            FROM (SELECT doc_id, step, pair FROM below
                  UNION ALL
                  SELECT l.doc_id, a.step, a.pair FROM leaves l JOIN above a ON a.source IS NOT DISTINCT FROM l.source)
            GROUP BY doc_id
        ), folded AS (
            SELECT l.doc_id, l.leaf, s.subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
                   sha256(array_to_string(list_transform(coalesce(p.path, []), lambda x: replace(x, '|', '')), ''))
                       AS proof_sha256,
                   list_reduce(list_concat([l.held], coalesce(p.path, [])),
                       lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
            FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
            LEFT JOIN paths p ON p.doc_id = l.doc_id
        )
        SELECT *, folded_root = root AS verified FROM folded
    """,
    "op13_walsh_clusters": _clusters_sql(k=40, rounds=5, seed="2"),
}
