"""DuckDB SQL for the corpus queries that SQL can express and that need more than a few lines."""

from __future__ import annotations

from collections.abc import Sequence


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string: one step per byte, then eight per byte on single bits."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii(({text})[i]), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda c, b: CASE WHEN b >= 0 THEN xor(c, b::BIGINT) "
            "ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT)")


def _digest_sql(fields: Sequence[str]) -> str:
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f}::VARCHAR)) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"


def manifest_sql() -> str:
    """The manifest of ``documents``: levels by recursion, then one climb per leaf in its tree and one in the tree of subroots."""
    changed = f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    grown = "SELECT tree, level + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM {0} WHERE n > 1 GROUP BY tree, level, idx // 3"
    passed = """SELECT r, c.tree, c.level + 1, c.idx // 3,
      sha256(array_to_string(run[:c.idx % 3], '') || folded || array_to_string(run[c.idx % 3 + 2:], '')),
      proof || array_to_string(run[:c.idx % 3], '') || array_to_string(run[c.idx % 3 + 2:], '')
    FROM {0} c JOIN {1} k ON k.tree = c.tree AND k.level = c.level AND k.i = c.idx // 3"""
    runs = "SELECT tree, level, idx // 3 AS i, list(h ORDER BY idx) AS run FROM {0} WHERE n > 1 GROUP BY tree, level, idx // 3"
    return f"""
WITH RECURSIVE d AS (SELECT *, row_number() OVER () AS r, coalesce('=' || source, '') AS tree, {changed} AS changed FROM documents),
leaves AS (SELECT r, doc_id, tree, {_digest_sql(["doc_id", "source", "lang", "n_chars", "text"])} AS h,
  {_digest_sql(["doc_id", "source", "lang", "n_chars", "changed"])} AS found FROM d),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, r) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
lv(tree, level, idx, n, h) AS (SELECT tree, 0, idx, n, h FROM placed UNION ALL {grown.format("lv")}),
tops AS (SELECT tree, level, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM lv WHERE n = 1),
up(tree, level, idx, n, h) AS (SELECT 'top', 0, place, n, h FROM tops UNION ALL {grown.format("up")}),
runs AS ({runs.format("lv")}), up_runs AS ({runs.format("up")}),
climb(r, tree, level, idx, folded, proof) AS (SELECT r, tree, 0, idx, found, '' FROM placed UNION ALL {passed.format("climb", "runs")}),
over(r, tree, level, idx, folded, proof) AS (SELECT r, 'top', 0, place, folded, proof FROM climb JOIN tops USING (tree, level)
  UNION ALL {passed.format("over", "up_runs")}),
root AS (SELECT level, h AS root FROM up WHERE n = 1)
SELECT doc_id, placed.h AS leaf, tops.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed JOIN tops USING (tree) JOIN over USING (r) JOIN root ON root.level = over.level"""


def conversations_sql() -> str:
    """The repair of ``conversations``: per row and state of the pattern the least label, cost in nine digits and initials after it.

    Labels are compared as strings, so the cheapest edits come first and of these the least initials. The four
    columns are the states: nothing read, system, user, assistant.
    """
    code = crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    more = lambda label, cost, edit: f"(lpad((left({label}, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({label}, 10) || '{edit}')"
    kept = lambda label, state: f"CASE WHEN NOT gone AND initial = '{state}' THEN {more(label, 'extra', 'K')} END"
    changed = lambda label: f"CASE WHEN NOT gone THEN {more(label, '3 + extra', 'R')} END"
    inserted = lambda label: more(label, "3", "I")
    user = f"least(w.u, {inserted('w.s0')}, {inserted('w.s')}, {inserted('w.a')})"
    answered = f"least(l.a0, {inserted('l.u')})"
    return f"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {code} % 20 AS code FROM conversations),
e AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
  CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE code <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS i FROM e),
f AS (SELECT *, regexp_extract(text, '([^ \\t-\\r])[ \\t-\\r]*$', 1) AS final,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, left(role, 1) AS initial,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
g AS (SELECT *, CASE WHEN final = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM f),
rows AS (SELECT conv_id, i, role, text, initial, turn, before, fault, fault IN ('blank', 'duplicate') AS gone,
  CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM g),
convs AS (SELECT DISTINCT conv_id FROM conversations),
walk(conv_id, i, s0, s, u, a) AS (
  SELECT conv_id, 0, '000000000', NULL::VARCHAR, '000000003I', '000000006II' FROM convs
  UNION ALL
  SELECT conv_id, i, s0, s, u, {answered} FROM (SELECT conv_id, i, s0, s, {user} AS u, a AS a0 FROM (
    SELECT r.conv_id, r.i, {more('p.s0', 4, 'D')} AS s0, least({more('p.s', 4, 'D')}, {kept('p.s0', 's')}) AS s,
      least({more('p.u', 4, 'D')}, {kept('p.s0', 'u')}, {kept('p.s', 'u')}, {kept('p.a', 'u')}, {changed('p.s0')}, {changed('p.s')}, {changed('p.a')}) AS u,
      least({more('p.a', 4, 'D')}, {kept('p.u', 'a')}, {changed('p.u')}) AS a
    FROM walk p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1) w) l),
done AS (SELECT conv_id, least(s0, a) AS label FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
edits AS (SELECT conv_id, substr(label, 10) AS audit, unnest(range(1, length(label) - 8)) AS p FROM done),
each AS (SELECT conv_id, p, audit[p] AS edit, length(replace(left(audit, p), 'I', '')) AS i FROM edits),
said AS (SELECT e.*, r.role, r.text, r.initial, row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS place
  FROM each e LEFT JOIN rows r ON edit <> 'I' AND r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.i WHERE edit <> 'D'),
led AS (SELECT *, max(CASE WHEN place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS system FROM said),
texts AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
  || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS repaired FROM led GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, left(label, 9)::BIGINT AS cost, substr(label, 10) AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM convs c JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""
