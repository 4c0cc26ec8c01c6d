"""SQL for the corpus operators' results, where SQL can state them. The other results hang on token ids, ring places, learned
models or searches; ``tests/llm`` holds each of those queries against plain code."""

PREFIX_TRIE = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS nth
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    -- CRC-32 bit by bit over the bytes of the decimal id, which are ASCII
    SELECT conv_id, conv_id - conv_id % 20 AS head,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1),
                   lambda i: list_prepend(ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
               lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
           ), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), parts AS (
    SELECT ids.conv_id, 0 AS own, nth, role, text FROM ids JOIN turns ON turns.conv_id = head AND nth < h
    UNION ALL
    SELECT ids.conv_id, 1, nth, role, text FROM ids JOIN turns ON turns.conv_id = ids.conv_id AND nth >= h
), paths AS (
    SELECT ids.conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY own, nth) FILTER (own IS NOT NULL), []) AS path
    FROM ids LEFT JOIN parts ON parts.conv_id = ids.conv_id GROUP BY 1
), members AS (
    SELECT conv_id, d AS depth, path[1:d] AS node, len(path) = d AS ends
    FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM paths)
), nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
           CASE WHEN depth = 0 THEN 0
                ELSE (count(*) - 1) * len(regexp_extract_all(node[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
    FROM members GROUP BY node, depth
), counted AS (
    SELECT nodes.*, (SELECT count(*) FROM nodes s WHERE s.depth = nodes.depth + 1 AND s.node[1:nodes.depth] = nodes.node) AS n_children
    FROM nodes
), above AS (
    SELECT node[1:d] AS top, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, a.n_leaves,
       a.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN above a ON a.top = n.node LEFT JOIN counted p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""

LEXICAL_SEARCH = """
WITH folded AS (
    SELECT 'd' AS kind, row_number() OVER () AS row_id, doc_id AS id,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
    UNION ALL
    SELECT 'i', row_number() OVER (), item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), words AS (
    SELECT kind, row_id, id, unnest(regexp_extract_all(body, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM folded
), tf AS (
    SELECT row_id, id, term, count(*) AS tf FROM words WHERE kind = 'd' GROUP BY ALL
), lengths AS (
    SELECT row_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1
), totals AS (
    SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, n_docs
), scores AS (
    SELECT i.id AS item_id, tf.row_id, tf.id AS doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM (SELECT DISTINCT id, term FROM words WHERE kind = 'i') i
    JOIN tf ON tf.term = i.term JOIN weights ON weights.term = i.term JOIN lengths ON lengths.row_id = tf.row_id, totals
    GROUP BY ALL
)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""

_WORDS = "regexp_extract_all(coalesce({0}, ''), '[^\\x20\\x09-\\x0D]+')"

JACCARD_GROUPS = f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), shingles AS (
    SELECT row_id, unnest(CASE WHEN len(w) >= 4
        THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM docs
), sizes AS (
    SELECT row_id, count(*) AS n FROM shingles GROUP BY 1
), shared AS (
    SELECT a.row_id AS a, b.row_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.row_id <> b.row_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.row_id = a JOIN sizes y ON y.row_id = b WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
), reach AS (
    SELECT row_id AS a, row_id AS b FROM docs
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id
FROM docs d LEFT JOIN sizes s ON s.row_id = d.row_id
JOIN (SELECT reach.a, min(doc_id) AS component_id FROM reach JOIN docs ON docs.row_id = reach.b GROUP BY 1) r ON r.a = d.row_id
"""

REPEATED_WINDOWS = f"""
WITH docs AS (
    SELECT doc_id, {_WORDS.format('text')} AS w FROM documents
), places AS (
    SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM docs
), windows AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY array_to_string(w[pos:pos + 19], ' ') ORDER BY doc_id, pos) AS nth
    FROM places WHERE pos + 19 <= len(w)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM windows WHERE nth > 1
), kept AS (
    SELECT p.doc_id, string_agg(p.w[p.pos], ' ' ORDER BY p.pos) AS text FROM places p
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = p.doc_id AND g.pos = p.pos) GROUP BY 1
), lost AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN lost ON lost.doc_id = d.doc_id
"""

EXPECTED: dict[str, str] = {
    "op8_jaccard": JACCARD_GROUPS,
    "op10_substring": REPEATED_WINDOWS,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_lexical_search": LEXICAL_SEARCH,
}
