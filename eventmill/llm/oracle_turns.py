"""The operators on conversations and vectors as DuckDB SQL, stated on their own."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    bit = "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {byte}), 4294967295)"


_DIGEST = "md5(strlen(r) || ':' || r || t)"


def _least(*of: str) -> str:
    return f"list_min([{', '.join(of)}])"


def _edit(state: str, cost: str, letter: str, line: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'x': {state}.x || {line}}}"


def _inserts(select: str) -> str:
    """After a row: a user's turn, then an assistant's, may be put in."""
    after_user = _least("u0", *(_edit(s, "3", "I", "chr(10) || 'user:'") for s in ("none_", "sys_", "a0")))
    return f"""SELECT conv_id, i, none_, sys_, u1 AS use_, {_least('a0', _edit('u1', '3', 'I', "chr(10) || 'assistant:'"))} AS ass_
    FROM (SELECT *, {after_user} AS u1 FROM ({select}))"""


_FAR = "{'c': 1000000000, 'a': '~', 'x': ''}"
_MORE = "(CASE WHEN cut THEN 3 ELSE 0 END)"


def _taken(state: str, role: str, to: str) -> tuple[str, ...]:
    """A row that follows ``state`` kept as one of ``role``, or, but for the system's, made one."""
    kept = f"CASE WHEN NOT gone AND l = '{role[0]}' THEN {_edit(state, _MORE, 'K', 'chr(10) || r || chr(58) || t')} ELSE {_FAR} END"
    made = f"CASE WHEN NOT gone THEN {_edit(state, '3 + ' + _MORE, 'R', f'chr(10) || {chr(39)}{role}:{chr(39)} || t')} ELSE {_FAR} END"
    return (kept,) if role == "system" else (kept, made)


_STEP = f"""
    SELECT s.conv_id, s.i + 1 AS i, {_edit('none_', '4', 'D')} AS none_,
           {_least(_edit('sys_', '4', 'D'), *_taken('none_', 'system', 'sys_'))} AS sys_,
           {_least(_edit('use_', '4', 'D'), *(x for s in ('none_', 'sys_', 'ass_') for x in _taken(s, 'user', 'use_')))} AS u0,
           {_least(_edit('ass_', '4', 'D'), *_taken('use_', 'assistant', 'ass_'))} AS a0
    FROM states AS s JOIN marked ON s.conv_id IS NOT DISTINCT FROM marked.conv_id AND marked.i = s.i + 1
"""

_OP11 = rf"""
WITH RECURSIVE rows_ AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
           {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE r END AS r,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS t,
           unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM rows_),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_DIGEST}) AS i,
           substr(r, 1, 1) AS l, regexp_extract(t, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS e
    FROM damaged),
marked AS (
    SELECT conv_id, turn, r, t, i, l, e = '' AS blank, e NOT IN ('.', '!', '?') AS cut,
           row_number() OVER (PARTITION BY conv_id, r, t ORDER BY i) > 1 AS again,
           lag(l) OVER (PARTITION BY conv_id ORDER BY i) || l AS two,
           blank OR again AS gone
    FROM placed),
states AS (
    {_inserts(f"SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 'x': ''}} AS none_, {_FAR} AS sys_, {_FAR} AS u0, {_FAR} AS a0 FROM conversations")}
    UNION ALL
    {_inserts(_STEP)}),
ends AS (SELECT conv_id, list_min([arg_max(none_, i), arg_max(ass_, i)]) AS best FROM states GROUP BY conv_id),
counts AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count_if(blank) AS blank,
           count_if(NOT blank AND again) AS duplicate, count_if(NOT gone AND cut) AS truncated,
           count_if(two NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id)
SELECT ends.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
       sha256(substr(best.x, 2)) AS repaired_sha256
FROM ends LEFT JOIN counts ON ends.conv_id IS NOT DISTINCT FROM counts.conv_id
"""

_OP12 = f"""
WITH rows_ AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_DIGEST}) AS i, r, t
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
ids AS (SELECT conv_id, conv_id - conv_id % 100 AS lender, {_crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM rows_)),
rebuilt AS (
    SELECT ids.conv_id, 0 AS part, i, r, t FROM ids JOIN rows_ ON rows_.conv_id = lender WHERE i <= h
    UNION ALL SELECT conv_id, 1, i, r, t FROM ids JOIN rows_ USING (conv_id) WHERE i > h),
numbered AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth, r, t FROM rebuilt),
paths AS (
    SELECT conv_id, depth, length(t) AS chars, md5(string_agg(strlen(r) || ':' || r || strlen(t) || ':' || t, '')
           OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM numbered
    UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
members AS (SELECT *, lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS last,
                   lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM paths),
nodes AS (
    SELECT node, any_value(up) AS up, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(chars) AS chars,
           bool_and(last) AS leaf, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends
    FROM members GROUP BY node),
below AS (SELECT DISTINCT a.node AS top, b.node FROM members AS a JOIN members AS b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (SELECT top, count_if(leaf) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM below JOIN nodes ON nodes.node = below.node GROUP BY top),
kids AS (SELECT up, count(*) AS n FROM nodes GROUP BY up)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, parents.conv_id AS parent_conv_id, CAST(nodes.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN sums ON top = nodes.node LEFT JOIN nodes AS parents ON parents.node = nodes.up LEFT JOIN kids ON kids.up = nodes.node
"""


_OP13 = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, row_number() OVER () AS n, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
    SELECT * FROM vectors
    WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.n AS a, b.n AS b FROM usable AS a JOIN usable AS b
    ON a.n <> b.n AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reached AS (
    SELECT n AS a, n AS b FROM vectors
    UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
least AS (SELECT a AS n, min(vec_id) AS component_id FROM reached JOIN vectors ON vectors.n = reached.b GROUP BY a),
counts AS (SELECT a AS n, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN least USING (n) LEFT JOIN counts USING (n)
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_structure_repair": _OP11, "op12_prefix_trie": _OP12, "op13_embedding_dedup": _OP13}
