"""SQL of operator 13: the same repair by dynamic programming, one row of a conversation a step."""

from __future__ import annotations


def _edited(s: str, cost: int | str, letter: str, turn: str) -> str:
    """A prefix (cost in nine digits, audit, chr(1), turns) after one more edit."""
    return (f"(lpad(CAST(CAST({s}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {s}[10:instr({s}, chr(1)) - 1] || '{letter}' || "
            f"{s}[instr({s}, chr(1)):] || {turn})")


def repair_sql() -> str:
    insert = lambda s, role: _edited(s, 3, "I", f"chr(10) || '{role}:'")
    delete = lambda s: _edited(s, 4, "D", "''")
    keep = lambda s, i: f"CASE WHEN i = '{i}' AND stays THEN {_edited(s, 'extra', 'K', 'turn')} END"
    reroled = lambda s, role: f"CASE WHEN stays THEN {_edited(s, '3 + extra', 'R', f'''chr(10) || '{role}:' || text''')} END"
    return rf"""
        WITH RECURSIVE x AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
        o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
                  list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' ||
                      coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                  lambda c, b: xor(c >> 8, x.crc[(xor(c, b) & 255) + 1]))) % 20 AS code FROM conversations, x),
        d AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
                  CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                  unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM o WHERE code <> 0),
        e AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM d),
        f AS (SELECT *, regexp_extract(text, '[^\x20\x09-\x0D][\x20\x09-\x0D]*$') AS tail,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), seen) AS pos FROM e),
        r AS (SELECT conv_id, turn, pos, role, text, role[1] AS i, CASE WHEN tail = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                  WHEN tail[1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  lag(role[1]) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM f),
        counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                  count(*) FILTER (fault = 'truncated') AS truncated,
                  count(*) FILTER (before IS NOT NULL AND (before || '>' || i) NOT IN ('s>u', 'u>a', 'a>u')) AS illegal, count(*) AS n
              FROM r GROUP BY conv_id),
        -- The best prefix per last role: none, system, user, assistant.
        p(conv_id, pos, s0, s1, s2, s3) AS (
            SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '000000000' || chr(1), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM r
            UNION ALL
            SELECT conv_id, pos, {delete('s0')}, least({delete('s1')}, {keep('s0', 's')}),
                least({delete('e2')}, {", ".join(f"{keep(s, 'u')}, {reroled(s, 'user')}" for s in ('s0', 's1', 'e3'))}),
                least({delete('e3')}, {keep('e2', 'a')}, {reroled('e2', 'assistant')})
            FROM (SELECT *, least(s3, {insert('e2', 'assistant')}) AS e3 FROM (
                SELECT p.conv_id, r.pos, s0, s1, s3, least(s2, {insert('s0', 'user')}, {insert('s1', 'user')}, {insert('s3', 'user')}) AS e2,
                    i, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra,
                    text, chr(10) || role || ':' || text AS turn
                FROM p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.pos = p.pos + 1))),
        best AS (SELECT c.conv_id, least(s0, s3, {insert('s2', 'assistant')}, {insert(insert('s1', 'user'), 'assistant')}) AS b
                 FROM p JOIN counts c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.pos = c.n)
        SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(b[1:9] AS BIGINT), 0) AS cost,
               coalesce(b[10:instr(b, chr(1)) - 1], '') AS audit, sha256(coalesce(b[instr(b, chr(1)) + 2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a
        LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON a.conv_id IS NOT DISTINCT FROM best.conv_id"""
