"""The same results in DuckDB SQL, for the operators that SQL can express."""

OP2_CHAT_FORMAT = r"""
WITH messages AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), measured AS (
    SELECT *,
        -- characters that escaping adds: backslashes, control strings, each # that two more follow
        length(text) - length(replace(text, '\', ''))
        + (length(text) - length(replace(text, '</turn>', ''))) // 7
        + (length(text) - length(replace(text, '<|', ''))) // 2
        + length(array_to_string(regexp_extract_all(text, '##(#+)', 1), '')) AS added
    FROM messages
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(4 + length(role) + 1 + length(text) + added + 8) AS BIGINT) AS formatted_chars,
    CAST(count(*) FILTER (role = 'assistant') AS BIGINT) AS n_loss_spans
FROM measured GROUP BY conv_id
"""

ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6_EXACT_DEDUP = f"""
WITH normal AS (SELECT doc_id, {ASCII_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY t)
"""


def mix_sql(documents: str = "documents", seed: str = "mix") -> str:
    """WITH clauses up to `mixed` (doc_id, source, size, source_size, target, copies)."""
    return rf"""
sized AS (
    SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM {documents}
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
        row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
), limits AS (
    SELECT *, source_size * 3.0::DOUBLE AS "limit", source_size * 3.0::DOUBLE / weight AS ratio,
        sum(source_size) OVER () * 1.0::DOUBLE AS budget
    FROM sources
), levels AS (
    SELECT *, (budget - coalesce(sum("limit") OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM limits
), targets AS (
    SELECT source, source_size, least("limit", weight * (SELECT max(level) FROM levels WHERE ratio >= level)) AS target
    FROM levels
), placed AS (
    SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
        row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) AS place,
        CAST('0x' || substr(md5('{seed}' || coalesce(s.source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS "offset"
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), mixed AS (
    SELECT *, least(CAST(floor(rate * place + "offset") - floor(rate * (place - 1) + "offset") AS BIGINT), 3) AS copies
    FROM placed
)"""


OP9_SOURCE_MIX = f"""
WITH {mix_sql()}
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(copies * size AS BIGINT) AS taken FROM mixed
"""


def crc32_sql(value: str) -> str:
    """crc32 of the decimal form of `value`, bit by bit."""
    codes = f"list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
    bits = "lambda r, u: xor(r >> 1, 3988292384 * (r & 1))"
    byte = f"lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], {bits}, xor(c, b))"
    return f"xor(4294967295::BIGINT, list_reduce({codes}, {byte}, 4294967295::BIGINT))"


OP11_PREFIX_TRIE = f"""
WITH ordered AS (
    SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
    SELECT conv_id, turns, conv_id - conv_id % 5 AS head_id, {crc32_sql("conv_id")} % 9 AS h FROM ordered
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(o.turns, [])[1 : h], c.turns[h + 1 :]) AS turns
    FROM heads c LEFT JOIN ordered o ON o.conv_id = head_id
), prefixes AS (
    SELECT conv_id, len(turns) AS n, d, turns[1 : d] AS prefix FROM rebuilt, LATERAL unnest(range(len(turns) + 1)) u(d)
), members AS MATERIALIZED (
    -- a node is its depth and its smallest member
    SELECT conv_id, n, d, min(conv_id) OVER (PARTITION BY d, prefix) AS node, prefix[d].text AS last_text FROM prefixes
), nodes AS MATERIALIZED (
    SELECT node, d, count(*) AS n_convs, (count(*) - 1) * coalesce(strlen(any_value(last_text)), 0) AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
    FROM members GROUP BY node, d
), above AS (
    SELECT t.node, t.d, m.node AS parent FROM nodes t JOIN members m ON m.conv_id = t.node AND m.d = t.d - 1
), children AS (
    SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM above GROUP BY ALL
), subtrees AS (
    SELECT m.node, m.d, count(*) FILTER (n_children IS NULL) AS n_leaves, sum(saved) AS saved_tokens
    FROM nodes t LEFT JOIN children USING (node, d) JOIN members m ON m.conv_id = t.node AND m.d <= t.d GROUP BY ALL
)
SELECT node AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM nodes LEFT JOIN above USING (node, d) LEFT JOIN children USING (node, d) JOIN subtrees USING (node, d)
"""

OP12_TILE_DEDUP = """
WITH RECURSIVE given AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings
), usable AS MATERIALIZED (
    SELECT * FROM given WHERE len(list_filter(vec, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(vec, lambda x: x <> 0)) > 0
), linked AS MATERIALIZED (
    SELECT a.row, b.row AS other FROM usable a JOIN usable b ON a.row <> b.row AND len(a.vec) = len(b.vec)
    WHERE list_dot_product(a.vec, b.vec) / (sqrt(list_dot_product(a.vec, a.vec)) * sqrt(list_dot_product(b.vec, b.vec))) >= 0.9
), reached AS (
    SELECT row, row AS other FROM given
    UNION SELECT r.row, l.other FROM reached r JOIN linked l ON l.row = r.other
), least AS (
    SELECT r.row, min(g.vec_id) AS component_id FROM reached r JOIN given g ON g.row = r.other GROUP BY r.row
), counts AS (
    SELECT row, count(*) AS n_links FROM linked GROUP BY row
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM given JOIN least USING (row) LEFT JOIN counts USING (row)
"""

OP13_PERIODIC_RUNS = rf"""
WITH given AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        coalesce({crc32_sql('doc_id')}, 1) AS h
    FROM documents
), chosen AS (
    SELECT row, doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS planted,
        CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a, 3 + (h // 10) % 8 AS times
    FROM given
), texts AS MATERIALIZED (
    SELECT row, doc_id, n, CASE WHEN planted
        THEN list_transform(range(n), lambda i: words[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // times) END + 1])
        ELSE words END AS words
    FROM chosen
), numbered AS MATERIALIZED (
    SELECT row, n, unnest(words) AS word, unnest(range(n)) AS i FROM texts
), agreeing AS (
    -- words that recur at a distance of which a run can hold four
    SELECT x.row, y.i - x.i AS period, x.i FROM numbered x JOIN numbered y ON x.row = y.row AND x.word = y.word AND y.i > x.i
        AND 4 * (y.i - x.i) <= x.n
), stretches AS (
    SELECT row, period, i, i - row_number() OVER (PARTITION BY row, period ORDER BY i) AS stretch FROM agreeing
), repeats AS (
    SELECT row, min(i) AS start, count(*) + period AS length, period FROM stretches GROUP BY row, period, stretch
), runs AS MATERIALIZED (
    SELECT row, start, length, min(period) AS period FROM repeats WHERE length >= greatest(6, 4 * period) GROUP BY row, start, length
), listed AS (
    SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY row
), best AS (
    SELECT * FROM runs r QUALIFY row_number() OVER (PARTITION BY row ORDER BY length / period DESC, start, period) = 1
), dropped AS (
    SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM numbered ANTI JOIN dropped USING (row, i) GROUP BY row
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
    CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (row) LEFT JOIN best USING (row) LEFT JOIN kept USING (row)
"""

ORACLES = {
    "op2_chat_format": OP2_CHAT_FORMAT,
    "op6_exact_dedup": OP6_EXACT_DEDUP,
    "op9_source_mix": OP9_SOURCE_MIX,
    "op11_prefix_trie": OP11_PREFIX_TRIE,
    "op12_tile_dedup": OP12_TILE_DEDUP,
    "op13_periodic_runs": OP13_PERIODIC_RUNS,
}
