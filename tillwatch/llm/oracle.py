"""SQL counterparts of the registered queries whose rows SQL can tell."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: a fold over its bytes, eight shifts each."""
    byte = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, byte: {byte}))"


_VISIBLE = r"[^\x20\x09-\x0D]"


def _added(path: str, cost: str, edit: str, turn: str | None = None) -> str:
    """A path with one more edit. It is text that sorts as the rule wants: cost, audit, chr(1), and the repaired turns."""
    mark = f"instr({path}, chr(1))"
    said = f" || chr(10) || {turn}" if turn else ""
    number = f"lpad((left({path}, 8)::INTEGER + {cost})::VARCHAR, 8, '0')"
    return f"({number} || substr({path}, 9, {mark} - 9) || '{edit}' || substr({path}, {mark}){said})"


_NEXT_USER = "least(p.nothing, p.system, p.assistant)"
_KEPT = "r.fault NOT IN ('blank', 'duplicate')"
_MORE = "CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END"


def _turn_to(before: str, role: str) -> str:
    """Keep or rename a row as a ``role``; a null path stays null."""
    keep, rename = _added("q", _MORE, "K", "r.role || ':' || r.text"), _added("q", f"1 + {_MORE}", "R", f"'{role}:' || r.text")
    return f"(SELECT CASE WHEN {_KEPT} THEN CASE WHEN left(r.role, 1) = '{role[0]}' THEN {keep} ELSE {rename} END END FROM (SELECT {before} AS q))"


def _inserted(source: str) -> str:
    """Relaxes insertions: a user behind nothing, a system or an assistant, an assistant behind a user."""
    return f"""SELECT *, least(assistant1, {_added("user1", "5", "I", "'assistant:'")}) AS assistant FROM (
    SELECT *, least(user0, {_added("least(nothing, system, assistant0)", "5", "I", "'user:'")}) AS user1, assistant0 AS assistant1 FROM ({source}))"""


_REPAIR = f"""WITH RECURSIVE
texts AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS draw
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM texts, unnest(CASE WHEN draw = 3 THEN [1, 2] ELSE [1] END) WHERE draw <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS time_said
  FROM damaged
),
rows_ AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{_VISIBLE}') THEN 'blank' WHEN time_said > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[.!?]$') THEN 'truncated'
                 ELSE 'sound' END AS fault,
         left(lag(role) OVER w, 1) || left(role, 1) AS pair, lag(role) OVER w IS NOT NULL AS has_before
  FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY i)
),
convs AS (SELECT DISTINCT conv_id FROM conversations),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (has_before AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM rows_ GROUP BY conv_id
),
steps(conv_id, i, nothing, system, "user", assistant) AS (
  SELECT conv_id, 0::BIGINT, nothing, system, user1, assistant FROM (
    {_inserted("SELECT conv_id, '00000000' || chr(1) AS nothing, NULL::VARCHAR AS system, NULL::VARCHAR AS user0, NULL::VARCHAR AS assistant0 FROM convs")})
  UNION ALL
  SELECT conv_id, i, nothing, system, user1, assistant FROM (
    {_inserted(f'''SELECT p.conv_id, r.i, {_added("p.nothing", "2", "D")} AS nothing,
      least({_added("p.system", "2", "D")}, CASE WHEN {_KEPT} AND left(r.role, 1) = 's' THEN {_added("p.nothing", _MORE, "K", "r.role || ':' || r.text")} END) AS system,
      least({_added('p."user"', "2", "D")}, {_turn_to(_NEXT_USER, "user")}) AS user0,
      least({_added("p.assistant", "2", "D")}, {_turn_to('p."user"', "assistant")}) AS assistant0
      FROM steps p JOIN rows_ r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1''')})
),
best AS (
  SELECT s.conv_id, least(nothing, assistant) AS path FROM steps s LEFT JOIN facts f ON s.conv_id IS NOT DISTINCT FROM f.conv_id WHERE s.i = coalesce(f.n, 0)
)
SELECT best.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, left(path, 8)::BIGINT AS cost, substr(path, 9, instr(path, chr(1)) - 9) AS audit,
       sha256(substr(path, instr(path, chr(1)) + 2)) AS repaired_sha256
FROM best LEFT JOIN facts ON best.conv_id IS NOT DISTINCT FROM facts.conv_id"""

_TRIE = f"""WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
said AS (
  SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY place) AS turns,
         list(len(regexp_extract_all(text, '{_VISIBLE}+'))::BIGINT ORDER BY place) AS words
  FROM turns GROUP BY conv_id
),
rebuilt AS (
  SELECT c.conv_id, coalesce(b.turns[:c.h], []) || c.turns[c.h + 1:] AS turns, coalesce(b.words[:c.h], []) || c.words[c.h + 1:] AS words
  FROM (SELECT *, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM said) c LEFT JOIN said b ON b.conv_id = c.conv_id - c.conv_id % 20
),
starts AS (
  SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns, words FROM rebuilt
),
nodes AS (
  SELECT turns[:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(words[depth]), 0) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
  FROM starts GROUP BY turns[:depth], depth
),
children AS (SELECT prefix[:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)),
above AS (SELECT *, unnest(range(depth + 1)) AS upto FROM whole),
sums AS (
  SELECT prefix[:upto] AS prefix, sum((n_convs - 1) * words)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM above GROUP BY ALL
)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM whole w JOIN sums ON w.prefix = sums.prefix LEFT JOIN whole p ON w.depth > 0 AND p.prefix = w.prefix[:w.depth - 1]"""


_STATISTICS = f"""WITH texts AS (
  SELECT doc_id, row_number() OVER () AS place, coalesce(text, '') AS text FROM documents
),
said AS (
  SELECT doc_id, place, text, regexp_extract_all(text, '{_VISIBLE}+') AS words,
         list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '{_VISIBLE}')) AS lines
  FROM texts
),
spoken AS (SELECT place, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM said),
windows AS (
  SELECT place, i, [word, lead(word) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w] AS said
  FROM spoken WINDOW w AS (PARTITION BY place ORDER BY i) QUALIFY lead(word, 4) OVER w IS NOT NULL
),
twice AS (SELECT place, i FROM (SELECT place, i, count(*) OVER (PARTITION BY place, said) AS times FROM windows) WHERE times > 1),
repeated AS (
  SELECT place, sum(least(5, coalesce(later - i, 5)))::BIGINT AS n FROM (SELECT place, i, lead(i) OVER (PARTITION BY place ORDER BY i) AS later FROM twice) GROUP BY place
)
SELECT doc_id, len(words) AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
       (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
       len(words) < 10 OR 100 * coalesce(n, 0) > 20 * len(words) AS base_failed
FROM said LEFT JOIN repeated USING (place)"""

_VECTORS = """WITH RECURSIVE
vectors AS (SELECT vec_id, row_number() OVER () AS i, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT i, vec_id, list_transform(v, lambda x: x / list_max(list_transform(v, lambda y: abs(y)))) AS v FROM vectors
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.i, b.i AS j FROM usable a JOIN usable b ON a.i <> b.i
  WHERE CASE WHEN len(a.v) = len(b.v) THEN a.v = b.v OR list_cosine_similarity(a.v, b.v) >= 0.95 END
),
reached(i, j) AS (SELECT i, j FROM links UNION SELECT r.i, l.j FROM reached r JOIN links l ON l.i = r.j),
least_reached AS (SELECT r.i, min(vec_id) AS vec_id FROM reached r JOIN usable u ON u.i = r.j GROUP BY r.i),
counts AS (SELECT i, count(*) AS n FROM links GROUP BY i)
SELECT v.vec_id, coalesce(n, 0) AS n_links, coalesce(least(v.vec_id, m.vec_id), v.vec_id) AS component_id,
       coalesce(v.vec_id <= coalesce(m.vec_id, v.vec_id), false) AS kept
FROM vectors v LEFT JOIN counts USING (i) LEFT JOIN least_reached m USING (i)"""


def oracle_sql() -> dict[str, str]:
    return {"quality_base_statistics": _STATISTICS, "op5_hyperplane_embedding_dedup": _VECTORS, "op12_conversation_repair": _REPAIR, "op13_prefix_trie": _TRIE}
