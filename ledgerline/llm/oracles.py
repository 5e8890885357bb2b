"""SQL twins of the operators whose results SQL can say."""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b: {bits}), 4294967295)"


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR)::VARCHAR||':'||{x}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + "||".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


def _levels(name: str, leaves: str) -> str:
    """All nodes of the trees over `leaves` (tree, idx, h, cnt)."""
    return f"""{name} AS (SELECT tree, 0 AS level, idx, h, cnt FROM {leaves}
    UNION ALL SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(cnt) + 1) // 2
      FROM {name} WHERE cnt > 1 GROUP BY tree, level, idx // 2)"""


def _fold(name: str, start: str, nodes: str) -> str:
    """What leaves (key, tree, idx, h) and the siblings in `nodes` give, level by level."""
    return f"""{name} AS (SELECT key, tree, 0 AS level, idx, h FROM {start}
    UNION ALL SELECT f.key, f.tree, f.level + 1, f.idx // 2,
        sha256(CASE WHEN s.h IS NULL THEN f.h WHEN f.idx % 2 = 0 THEN f.h||s.h ELSE s.h||f.h END)
      FROM {name} f JOIN {nodes} n ON n.tree=f.tree AND n.level=f.level AND n.idx=f.idx AND n.cnt > 1
      LEFT JOIN {nodes} s ON s.tree=f.tree AND s.level=f.level AND s.idx=xor(f.idx, 1))"""


def _siblings(nodes: str) -> str:
    """Siblings of every leaf of `nodes`, one after the other."""
    return f"""(SELECT l.tree, l.idx, coalesce(string_agg(s.h, '' ORDER BY s.level), '') AS told
      FROM {nodes} l LEFT JOIN {nodes} s ON s.tree=l.tree AND s.idx=xor(l.idx >> s.level, 1) WHERE l.level=0 GROUP BY 1, 2)"""


MERKLE = f"""WITH RECURSIVE rows AS (SELECT *, {_leaf('n_chars')} AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf('(n_chars+1)')} END AS changed FROM documents),
  leaves AS (SELECT *, coalesce('='||lang, '') AS tree, leaf AS h, count(*) OVER (PARTITION BY lang) AS cnt,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM rows),
  {_levels('nodes', 'leaves')},
  roots AS (SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS cnt FROM nodes WHERE cnt=1),
  {_levels('tops', 'roots')},
  bad AS (SELECT row_number() OVER () AS key, doc_id, tree, idx, changed AS h FROM leaves WHERE changed IS NOT NULL),
  {_fold('low', 'bad', 'nodes')},
  bad_roots AS (SELECT key, '' AS tree, r.idx, f.h FROM low f JOIN nodes n ON n.tree=f.tree AND n.level=f.level AND n.idx=f.idx AND n.cnt=1
    JOIN roots r ON r.name=f.tree),
  {_fold('high', 'bad_roots', 'tops')},
  folded AS (SELECT b.tree, b.idx, f.h AS folded FROM high f JOIN tops n ON n.level=f.level AND n.idx=f.idx AND n.cnt=1 JOIN bad b ON b.key=f.key),
  whole AS (SELECT h AS root FROM tops WHERE cnt=1)
  SELECT l.doc_id, l.leaf, r.h AS subroot, root, sha256(p.told||t.told) AS proof_sha256, coalesce(folded, root) AS folded_root,
    coalesce(folded, root) = root AS verified
  FROM leaves l JOIN roots r ON r.name=l.tree JOIN whole ON true JOIN {_siblings('nodes')} p ON p.tree=l.tree AND p.idx=l.idx
    JOIN {_siblings('tops')} t ON t.idx=r.idx LEFT JOIN folded f ON f.tree=l.tree AND f.idx=l.idx"""


def _edit(state: int, kept: str) -> str:
    """The cheapest way (cost, edits) from a state before a row, without insertions in front."""
    to = (3, 3, 4, 3)[state]            # state behind the row that may come next, in places from 1
    more = "CASE WHEN fault='truncated' THEN 3 ELSE 0 END"
    forced = f"CASE WHEN free THEN {{'c': 3 + {more} + b[{to}].c, 'a': 'R'||b[{to}].a}} END"
    return f"list_sort([{{'c': 4 + b[{state + 1}].c, 'a': 'D'||b[{state + 1}].a}}, {forced}, {kept.format(more=more)}], 'ASC', 'NULLS LAST')[1]"


def _keep(initial: str, to: int) -> str:
    return f"WHEN free AND initial='{initial}' THEN {{{{'c': {{more}} + b[{to}].c, 'a': 'K'||b[{to}].a}}}}"


REPAIR = f"""WITH RECURSIVE marked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ')||':'||coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
  damaged AS (SELECT conv_id, turn, CASE WHEN k=4 THEN 'user' ELSE role END AS role,
      CASE WHEN k=1 THEN '' WHEN k=2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN k=3 THEN 2 ELSE 1 END)) AS copy
    FROM marked WHERE k<>0),
  seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
      regexp_extract(text, '(?s)([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS ends FROM damaged),
  faulty AS (SELECT *, CASE WHEN ends='' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN ends NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
      left(role, 1) AS initial, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, lag(left(role, 1)) OVER w AS before
    FROM seen WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth)),
  rows AS (SELECT *, coalesce(fault NOT IN ('blank', 'duplicate'), true) AS free FROM faulty),
  best AS (SELECT conv_id, n + 1 AS i, [{{'c': 0, 'a': ''}}, {{'c': 6, 'a': 'II'}}, {{'c': 3, 'a': 'I'}}, {{'c': 0, 'a': ''}}] AS b FROM rows WHERE i=1
    UNION ALL SELECT conv_id, i, [least(e[1], {{'c': 3 + u.c, 'a': 'I'||u.a}}), least(e[2], {{'c': 3 + u.c, 'a': 'I'||u.a}}), u, least(e[4], {{'c': 3 + e[3].c, 'a': 'I'||e[3].a}})]
    FROM (SELECT *, least(e[3], {{'c': 3 + e[4].c, 'a': 'I'||e[4].a}}) AS u FROM (
      SELECT r.conv_id, r.i, [{_edit(0, 'CASE ' + _keep('s', 2) + ' ' + _keep('u', 3) + ' END')}, {_edit(1, 'CASE ' + _keep('u', 3) + ' END')},
        {_edit(2, 'CASE ' + _keep('a', 4) + ' END')}, {_edit(3, 'CASE ' + _keep('u', 3) + ' END')}] AS e
      FROM best JOIN rows r ON r.conv_id IS NOT DISTINCT FROM best.conv_id AND r.i=best.i-1))),
  chosen AS (SELECT conv_id, b[1].c AS cost, b[1].a AS audit FROM best WHERE i=1),
  places AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM chosen),
  steps AS (SELECT conv_id, p, audit[p] AS edit, length(replace(audit[:p], 'I', '')) AS i, length(replace(audit[:p], 'D', '')) AS j FROM places),
  made AS (SELECT s.*, r.role, r.text, max(CASE WHEN s.j=1 AND edit='K' AND initial='s' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS led
    FROM steps s LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i=s.i AND s.edit<>'I'),
  lines AS (SELECT conv_id, string_agg(CASE WHEN edit='K' THEN role WHEN (j-led) % 2 = 1 THEN 'user' ELSE 'assistant' END||':'||coalesce(text, ''), chr(10) ORDER BY p)
      AS text FROM made WHERE edit<>'D' GROUP BY 1),
  counts AS (SELECT conv_id, coalesce(max(turn)-min(turn)+1-count(DISTINCT turn), 0) AS gaps, count(CASE WHEN fault='blank' THEN 1 END) AS blank,
      count(CASE WHEN fault='duplicate' THEN 1 END) AS duplicate, count(CASE WHEN fault='truncated' THEN 1 END) AS truncated,
      count(CASE WHEN i > 1 AND before||initial NOT IN ('su', 'ua', 'au') THEN 1 END) AS illegal FROM rows GROUP BY 1)
  SELECT x.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(l.text, '')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM x.conv_id
    LEFT JOIN chosen h ON h.conv_id IS NOT DISTINCT FROM x.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM x.conv_id"""
