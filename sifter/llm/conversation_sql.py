"""DuckDB SQL for the two queries on conversations."""

from __future__ import annotations

from .structure_repair import CLOSING, DELETE_COST, GONE, INSERT_COST, KEEP, KEEP_COST, NEXT, REROLE_COST, TRUNCATED_COST


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string."""
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bits}), 4294967295)"


TRIE = f"""
WITH t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS place FROM (
    SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, strlen(coalesce(text, '')) AS bytes,
           md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, count(*) AS n, {crc32('CAST(conv_id AS VARCHAR)')} % 9 AS h, conv_id - conv_id % 5 AS base FROM t GROUP BY conv_id
), e AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base
), r AS (
  SELECT t.conv_id, CASE WHEN e.conv_id = base THEN place ELSE taken + place - h END AS depth, digest, bytes
  FROM t JOIN e USING (conv_id) WHERE e.conv_id = base OR place > h
  UNION ALL
  SELECT e.conv_id, place, digest, bytes FROM e JOIN t ON t.conv_id = e.base AND place <= e.h WHERE e.conv_id <> e.base
), p AS (
  SELECT conv_id, depth, bytes, string_agg(digest, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth) AS k FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), own AS (SELECT conv_id, max(depth) AS length FROM p GROUP BY conv_id
), node AS (
  SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes,
         coalesce(string_agg(CASE WHEN depth = length THEN conv_id END, ',' ORDER BY conv_id), '') AS ends
  FROM p JOIN own USING (conv_id) GROUP BY depth, k
), kids AS (SELECT depth - 1 AS depth, substr(k, 1, len(k) - 32) AS k, count(*) AS kids FROM node WHERE depth > 0 GROUP BY ALL
), full_node AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kids USING (depth, k)
), sums AS (
  SELECT a.depth, a.k, sum((u.n - 1) * u.bytes) AS saved, count(*) FILTER (WHERE kids = 0) AS leaves
  FROM full_node u JOIN p a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.depth, a.k
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, f.n AS n_convs, f.kids AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_node f JOIN sums s USING (depth, k)
LEFT JOIN node q ON q.depth = f.depth - 1 AND q.k = substr(f.k, 1, len(f.k) - 32)
"""

#: Digits of a cost in a key; a key is cost and audit, so the least key is the cheapest, ASCII-least choice.
WIDE, NEVER = 9, 500_000_000


def _step(state: int) -> str:
    """The best key and repaired rest of a row and what follows it, in ``state``; d: the row, f0 to f3: what follows."""
    options, cost, edits, put, at = [], 0, "", "", state

    def option(allowed: str, price: str, edit: str, emitted: str, then: int) -> None:
        own = f"{cost} + {price} + CASE WHEN {allowed} THEN 0 ELSE {NEVER} END"
        total = f"lpad(CAST({own} + CAST(substr(f{then}.k, 1, {WIDE}) AS BIGINT) AS VARCHAR), {WIDE}, '0')"
        options.append(f"{{'k': {total} || '{edits + edit}' || substr(f{then}.k, {WIDE + 1}), 'r': '{put}' || {emitted} || f{then}.r}}")

    row = "':' || d.text"
    fault = f"(CASE WHEN d.truncated THEN {TRUNCATED_COST} ELSE 0 END)"
    for _ in range(3):
        option("true", str(DELETE_COST), "D", "''", at)
        for letter, ways in KEEP.items():
            if at in ways:
                option(f"d.letter = '{letter}'", f"{KEEP_COST} + {fault}", "K", f"chr(10) || d.role || {row}", ways[at])
        role, then = NEXT[at]
        option(f"d.letter <> '{GONE}'", f"{REROLE_COST} + {fault}", "R", f"chr(10) || '{role}' || {row}", then)
        cost, edits, put, at = cost + INSERT_COST, edits + "I", put + f"' || chr(10) || '{role}:", then
    return f"list_sort([{', '.join(options)}])[1]"


def _end(state: int) -> str:
    put, at = "''", state
    for _ in CLOSING[state]:
        role, at = NEXT[at]
        put += f" || chr(10) || '{role}:'"
    return f"{{'k': '{INSERT_COST * len(CLOSING[state]):0{WIDE}d}{CLOSING[state]}', 'r': {put}}}"


SPACE = r"[^\x20\x09-\x0D]"
REPAIR = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
         NOT regexp_matches(text, '{SPACE}') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
  FROM hurt
), marked AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), d AS MATERIALIZED (
  SELECT *, NOT blank AND NOT again AND cut AS truncated,
         CASE WHEN blank OR again THEN '{GONE}' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS letter
  FROM marked
), facts AS (
  SELECT o.conv_id, count(d.pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate,
         count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN d ON d.conv_id IS NOT DISTINCT FROM o.conv_id GROUP BY o.conv_id
), best AS (
  SELECT conv_id, n + 1 AS pos, {', '.join(f'{_end(s)} AS f{s}' for s in range(4))} FROM facts
  UNION ALL
  SELECT best.conv_id, d.pos, {', '.join(_step(s) for s in range(4))}
  FROM best JOIN d ON d.conv_id IS NOT DISTINCT FROM best.conv_id AND d.pos = best.pos - 1
)
SELECT f.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal,
       CAST(substr(f0.k, 1, {WIDE}) AS BIGINT) AS cost, substr(f0.k, {WIDE + 1}) AS audit, sha256(substr(f0.r, 2)) AS repaired_sha256
FROM facts f JOIN best ON best.conv_id IS NOT DISTINCT FROM f.conv_id AND best.pos = 1
"""
