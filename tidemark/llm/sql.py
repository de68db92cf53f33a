"""The registered queries that plain SQL can express, for an independent engine."""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
    FROM documents
), weighed AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM sized GROUP BY source
), ranked AS (
    SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weights,
           coalesce(sum(3 * source_size) OVER by_ratio, 0) AS cap_before,
           coalesce(sum(weight) OVER by_ratio, 0) AS weight_before
    FROM weighed
    WINDOW by_ratio AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
    SELECT *, 3 * source_size * (all_weights - weight_before) <= (total - cap_before) * weight AS stops FROM ranked
), targets AS (
    SELECT source, source_size,
           CASE WHEN stops THEN (3 * source_size)::DOUBLE
                ELSE (total - sum(CASE WHEN stops THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE * weight::DOUBLE
                     / (sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
    FROM marked
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS repeats FROM targets
), hashes AS (
    SELECT source, h, sum(size) AS at_hash, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
    FROM sized GROUP BY source, h
)
SELECT s.doc_id, s.size, b.source_size, b.target,
       (s.size * b.repeats + CASE
            WHEN x.upto <= floor(b.target)::BIGINT - b.repeats * b.source_size THEN s.size
            WHEN x.upto - x.at_hash <= floor(b.target)::BIGINT - b.repeats * b.source_size
            THEN floor(s.size * (floor(b.target)::BIGINT - b.repeats * b.source_size - x.upto + x.at_hash)
                       / greatest(x.at_hash, 1)::DOUBLE)
            ELSE 0 END)::BIGINT AS taken
FROM sized s
JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
JOIN hashes x ON s.source IS NOT DISTINCT FROM x.source AND s.h = x.h
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a
    JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_inner_product(a.v, b.v)
          / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.93
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), smallest AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, s.component_id, e.vec_id = s.component_id AS kept
FROM embeddings e JOIN smallest s ON e.vec_id = s.a LEFT JOIN counts c ON e.vec_id = c.a
"""

JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}\p{Mn}\p{Mc}]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a
    JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE shared.n >= 0.8::DOUBLE * (x.n + y.n - shared.n)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), smallest AS (SELECT a, min(b) AS class_id FROM reached GROUP BY a
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, s.class_id, coalesce(c.n, 0)::BIGINT AS n_links, d.doc_id = s.class_id AS kept
FROM documents d JOIN smallest s ON d.doc_id = s.a LEFT JOIN counts c ON d.doc_id = c.a
"""

#: The table of the CRC-32 with the reversed polynomial 0xEDB88320, and the CRC of doc_id as text.
_CRC_TABLE = """
crc_table AS (
    SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY n) AS t
    FROM range(256) r(n)
)"""

MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE}, checked AS (
    SELECT *, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
               lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1]))) % 7 = 0 AS tampered
    FROM documents, crc_table
), leaves AS (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
           sha256(head || n || tail) AS leaf,
           sha256(head || CASE WHEN tampered AND n_chars IS NOT NULL
                               THEN strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) ELSE n END || tail) AS given
    FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                 coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
                 coalesce(strlen(text) || ':' || text, '-') AS tail FROM checked)
), trees AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM leaves GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, [sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')) FOR i IN range((len(nodes) + 1) // 2)]
    FROM trees WHERE len(nodes) > 1
), subroots AS (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM trees WHERE len(nodes) = 1
), top AS (
    SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM subroots
    UNION ALL
    SELECT level + 1, [sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')) FOR i IN range((len(nodes) + 1) // 2)]
    FROM top WHERE len(nodes) > 1
), steps AS (
    SELECT l.lang, l.pos, t.level, CASE WHEN (l.pos >> t.level) & 1 = 1 THEN '<' ELSE '>' END
           || coalesce(t.nodes[xor(l.pos >> t.level, 1) + 1], '') AS step
    FROM leaves l JOIN trees t ON l.lang IS NOT DISTINCT FROM t.lang AND len(t.nodes) > 1
    UNION ALL
    SELECT l.lang, l.pos, 1000 + t.level, CASE WHEN (s.pos >> t.level) & 1 = 1 THEN '<' ELSE '>' END
           || coalesce(t.nodes[xor(s.pos >> t.level, 1) + 1], '')
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN top t ON len(t.nodes) > 1
), proofs AS (
    SELECT lang, pos, list(step ORDER BY level) AS steps FROM steps GROUP BY lang, pos
), folded AS (
    SELECT l.*, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
           sha256(coalesce(list_reduce(list_prepend('', coalesce(p.steps, [])), lambda a, x: a || x[2:]), '')) AS proof_sha256,
           list_reduce(list_prepend(l.given, coalesce(p.steps, [])),
                       lambda a, x: sha256(CASE WHEN x[1] = '<' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN proofs p ON l.lang IS NOT DISTINCT FROM p.lang AND l.pos = p.pos
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""



def _edited(way: str, letter: str, cost: str, message: str = "") -> str:
    """A way with one more edit; null where there is no way."""
    more = f" || chr(10) || {message}" if message else ""
    return f"CASE WHEN {way} IS NOT NULL THEN {{'c': {way}.c + {cost}, 'a': {way}.a || '{letter}', 't': {way}.t{more}}} END"


def _inserted(way: str, role: str) -> str:
    return _edited(way, "I", "3", f"'{role}:'")


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _row_step(state: int, after: tuple[int, ...], initial: str, role: str) -> str:
    """The cheapest way to a state after one more row: deleted, kept after some states, or with another role."""
    ways = [_edited(f"i{state}", "D", "4")]
    for before in after:
        kept = _edited(f"i{before}", "K", "extra", "role || ':' || text")
        ways.append(f"CASE WHEN NOT gone AND initial = '{initial}' THEN {kept} END")
        if role:
            turned = _edited(f"i{before}", "R", "3 + extra", f"'{role}:' || text")
            ways.append(f"CASE WHEN NOT gone THEN {turned} END")
    return f"{_least(*ways)} AS b{state}"


CONVERSATION_REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE}, coded AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(
                   string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                   lambda c: ord(c)::BIGINT)),
               lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1]))) % 20 AS code
    FROM conversations, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen, left(role, 1) AS initial,
           trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM damaged
), marked AS (
    SELECT *, body = '' AS blank, body <> '' AND seen AS dup, body = '' OR seen AS gone,
           CASE WHEN body <> '' AND NOT seen AND right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS extra,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM numbered
), totals AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (extra > 0) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), ways AS (
    SELECT DISTINCT conv_id, 0 AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS b0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS b1,
           NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS b2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS b3
    FROM conversations
    UNION ALL
    SELECT conv_id, i, {_row_step(0, (), "", "")}, {_row_step(1, (0,), "s", "")},
           {_row_step(2, (0, 1, 3), "u", "user")}, {_row_step(3, (2,), "a", "assistant")}
    FROM (
        SELECT conv_id, i, role, text, initial, gone, extra, b0 AS i0, b1 AS i1,
               {_least("once2", _inserted("once3", "user"))} AS i2, {_least("once3", _inserted("once2", "assistant"))} AS i3
        FROM (
            SELECT m.conv_id, m.i, role, text, initial, gone, extra, b0, b1,
                   {_least("b2", _inserted("b0", "user"), _inserted("b1", "user"), _inserted("b3", "user"))} AS once2,
                   {_least("b3", _inserted("b2", "assistant"))} AS once3
            FROM ways w JOIN marked m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = w.i + 1
        )
    )
), ended AS (
    SELECT w.conv_id, t.* EXCLUDE (conv_id), {_least("b0", "b3", _inserted("b2", "assistant"), "closed")} AS best
    FROM (SELECT *, {_edited("b1", "II", "6", "'user:' || chr(10) || 'assistant:'")} AS closed FROM ways) w
    LEFT JOIN totals t ON w.conv_id IS NOT DISTINCT FROM t.conv_id WHERE w.i = coalesce(t.n, 0)
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.c AS cost, best.a AS audit, sha256(best.t[2:]) AS repaired_sha256
FROM ended
"""

LINE_DEDUP = r"""
WITH numbered AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), split AS (
    SELECT r, doc_id, string_split(text, chr(10)) AS l FROM numbered
), lines AS (
    SELECT r, doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key
    HAVING count(DISTINCT doc_id) + max(doc_id IS NULL)::INT >= 2
), judged AS (
    SELECT k.*, x.key IS NOT NULL AND k.doc_id IS DISTINCT FROM x.keeper AS gone FROM keyed k LEFT JOIN repeated x USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""

ORACLE_SQL = {
    "op6_embedding_dedup": EMBEDDING_DEDUP,
    "op8_mixing": MIXING,
    "op9_jaccard_join": JACCARD_JOIN,
    "op11_merkle": MERKLE,
    "op12_conversation_repair": CONVERSATION_REPAIR,
    "op13_line_dedup": LINE_DEDUP,
}
