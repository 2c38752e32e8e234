"""The same queries as SQL for an independent engine."""

from __future__ import annotations

SPACE = r"[\s\x{85}\x{a0}\x{2028}\x{2029}\x{3000}\x{feff}]"


def _key(c: str) -> str:
    return f"nullif(upper(regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')), '')"


def time_sql(c: str) -> str:
    s = f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"
    iso = rf"regexp_replace({s}, '([+-]\d{{2}})(\d{{2}})$', '\1:\2')"
    return (
        rf"CASE WHEN regexp_full_match({s}, '-?\d{{9,17}}') THEN make_timestamp(try_cast({s} AS BIGINT) * 1000) "
        rf"WHEN regexp_matches({s}, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}[ T]\d{{1,2}}:\d{{2}}') THEN "
        rf"(try_cast({iso} || CASE WHEN regexp_matches({iso}, '([zZ]|[+-]\d{{2}}:\d{{2}})$') THEN '' ELSE 'Z' END AS TIMESTAMPTZ) AT TIME ZONE 'UTC') END"
    )


LATEST = f"""
parsed AS (
  SELECT {_key('key')} AS key, {_key('parent_key')} AS parent, {_key('project_key')} AS project, load_id,
         loaded_at AT TIME ZONE 'UTC' AS loaded_at, {time_sql('updated')} AS updated
  FROM tickets),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY updated DESC NULLS LAST, load_id DESC) AS rn FROM parsed WHERE key IS NOT NULL)
  WHERE rn = 1)"""

P2 = f"""
WITH files AS (
  SELECT file_id, source, target, modified_at, content, lower(trim(source)) AS kind, lower(regexp_extract(path, '[^/]*$')) AS name
  FROM landed_files WHERE content IS NOT NULL AND json_valid(content)),
items AS (
  SELECT file_id, source, target, modified_at, kind,
    CASE WHEN json_type(content) = 'ARRAY' AND json_array_length(content) = 1 THEN json_extract(content, '$[0]') ELSE content::JSON END AS obj
  FROM files WHERE name NOT LIKE '\\_index%' ESCAPE '\\' AND name NOT LIKE '\\_stats%' ESCAPE '\\'),
entries AS (
  SELECT NULL::BIGINT AS file_id, source, target, NULL::TIMESTAMPTZ AS modified_at, kind,
    unnest(CASE WHEN json_type(content) = 'ARRAY' THEN json_extract_string(content, '$[*]') ELSE json_extract_string(content, '$.keys[*]') END) AS raw
  FROM files WHERE name LIKE '\\_index%' ESCAPE '\\'),
records AS (
  SELECT file_id, source, target, modified_at, kind, CASE WHEN kind = 'slack' THEN json_extract_string(obj, '$.ts') ELSE json_extract_string(obj, '$.key') END AS raw
  FROM items WHERE json_type(obj) = 'OBJECT'
  UNION ALL SELECT * FROM entries),
named AS (
  SELECT file_id, source, target, modified_at,
    CASE WHEN kind = 'slack' THEN coalesce(CAST(try_cast(raw AS DECIMAL(28,6)) AS VARCHAR), nullif(trim(raw), '')) ELSE {_key('raw')} END AS record_id
  FROM records)
SELECT source, target, record_id, coalesce(arg_max(file_id, (modified_at, file_id)) FILTER (file_id IS NOT NULL), -1) AS file_id
FROM named WHERE record_id IS NOT NULL GROUP BY source, target, record_id HAVING count(file_id) <> 1
""".replace("\\\\", "\\")

SUCCESS = f"""
saves AS (
  SELECT save_id, {_key("split_part(job_id, '/', 2)")} AS project, {time_sql('started_at')} AS started, {time_sql('updated_at')} AS saved,
    lower(trim(phases['tickets'].status)) AS status, {time_sql("phases['tickets'].cursor")} AS cursor_at, phases['tickets'].completed_ids AS ids
  FROM checkpoints WHERE lower(trim(split_part(job_id, '/', 1))) = 'jira'),
success AS (
  SELECT project, cursor_at, saved FROM (
    SELECT *, row_number() OVER (PARTITION BY project ORDER BY saved DESC, save_id DESC) AS rn
    FROM saves WHERE status = 'completed' AND cursor_at IS NOT NULL AND saved IS NOT NULL)
  WHERE rn = 1),
listed AS (
  SELECT s.project, s.started, s.saved, unnest(s.ids) AS id FROM saves s JOIN success ok ON s.project = ok.project AND s.saved > ok.saved),
first_listed AS (
  SELECT project, started, {_key('id')} AS key, min(saved) AS seen FROM listed GROUP BY 1, 2, 3),
taken AS (SELECT project, key, max(seen) AS seen FROM first_listed WHERE key IS NOT NULL GROUP BY 1, 2)"""

DUE = """s.saved IS NULL OR l.updated IS NULL
   OR ((l.updated > s.cursor_at OR coalesce(l.loaded_at > s.saved, false)) AND NOT coalesce(t.seen >= greatest(l.updated, l.loaded_at), false))"""

P4 = f"""
WITH {LATEST}, {SUCCESS}
SELECT l.key AS key FROM latest l LEFT JOIN success s USING (project) LEFT JOIN taken t ON t.project = l.project AND t.key = l.key
WHERE {DUE}
"""

P4_RUNS = f"""
WITH {LATEST.split("latest AS")[0].rstrip().rstrip(",")},
bounds AS (SELECT min(load_id) + (max(load_id) - min(load_id)) * n // 3 AS high, min(load_id) - 1 + CASE n WHEN 1 THEN 0 ELSE 1 + (max(load_id) - min(load_id)) * (n - 1) // 3 END AS low, n
  FROM tickets, (SELECT unnest([1, 2, 3]) AS n) GROUP BY n),
seen AS (SELECT b.n AS run, p.*, p.load_id > b.low AS is_new FROM parsed p JOIN bounds b ON p.load_id <= b.high WHERE p.key IS NOT NULL),
state AS (SELECT *, row_number() OVER (PARTITION BY run, key ORDER BY updated DESC NULLS LAST, load_id DESC) AS rn, bool_or(is_new) OVER (PARTITION BY run, key) AS touched FROM seen),
{SUCCESS}
SELECT CAST(l.run AS INTEGER) AS run, l.key AS key
FROM (SELECT * FROM state WHERE rn = 1 AND touched) l LEFT JOIN success s USING (project) LEFT JOIN taken t ON t.project = l.project AND t.key = l.key
WHERE {DUE}
"""

P6 = """
WITH RECURSIVE documents_of AS (
  SELECT load_id, CASE WHEN json_type(d) = 'VARCHAR' THEN CASE WHEN json_valid(d ->> '$') THEN (d ->> '$')::JSON END ELSE d END AS doc
  FROM (SELECT load_id, CASE WHEN json_valid(description_adf) THEN description_adf::JSON END AS d FROM tickets)),
tree AS (
  SELECT load_id, []::INTEGER[] AS label, doc AS node FROM documents_of WHERE json_type(doc) = 'OBJECT'
  UNION ALL
  SELECT load_id, list_append(label, i::INTEGER), json_extract(node, '$.content[' || i || ']')
  FROM (SELECT load_id, label, node, unnest(range(json_array_length(node, '$.content')::BIGINT)) AS i FROM tree WHERE json_type(node, '$.content') = 'ARRAY')
  WHERE json_type(node, '$.content[' || i || ']') = 'OBJECT'),
placed AS (SELECT load_id, label, CAST(row_number() OVER (PARTITION BY load_id ORDER BY label) - 1 AS INTEGER) AS pos FROM tree),
elements AS (
  SELECT load_id, 'comment' AS child, i AS pos, c IS NULL AS gone, c.id AS id, [x.id FOR x IN comments] AS ids
  FROM (SELECT load_id, comments, unnest(comments) AS c, generate_subscripts(comments, 1) - 1 AS i FROM tickets)
  UNION ALL
  SELECT load_id, 'attachment', i, a IS NULL, a.id, [x.id FOR x IN attachments]
  FROM (SELECT load_id, attachments, unnest(attachments) AS a, generate_subscripts(attachments, 1) - 1 AS i FROM tickets)
  UNION ALL
  SELECT load_id, 'changelog', i, c IS NULL, NULL, NULL FROM (SELECT load_id, unnest(changelog) AS c, generate_subscripts(changelog, 1) - 1 AS i FROM tickets))
SELECT load_id, child, CAST(pos AS INTEGER) AS pos, -1 AS parent_pos FROM elements
WHERE NOT gone AND (coalesce(trim(id), '') = '' OR list_position(ids, id) = pos + 1)
UNION ALL
SELECT c.load_id, 'adf_node', c.pos, coalesce(p.pos, -1)
FROM placed c LEFT JOIN placed p ON p.load_id = c.load_id AND len(c.label) > 0 AND p.label = c.label[:-2]
"""

P7_WALK = f"""
WITH RECURSIVE {LATEST},
edges AS (SELECT l.key, p.key AS parent FROM latest l LEFT JOIN latest p ON l.parent = p.key),
walk AS (
  SELECT key AS start, key AS here, [key] AS way, false AS closed, 0 AS back FROM edges
  UNION ALL
  SELECT w.start, e.parent, list_append(w.way, e.parent), list_contains(w.way, e.parent), list_position(w.way, e.parent) - 1
  FROM walk w JOIN edges e ON e.key = w.here WHERE NOT w.closed AND e.parent IS NOT NULL),
ends AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY len(way) DESC) AS rn FROM walk) WHERE rn = 1),
paths AS (SELECT start AS key, list_reverse(CASE WHEN closed THEN way[:back + 1] ELSE way END) AS path, closed, back FROM ends)"""

P7 = f"""{P7_WALK}
SELECT start AS key,
  CASE WHEN closed THEN list_min(way[back + 1:]) ELSE here END AS root_key,
  CAST(CASE WHEN closed THEN back ELSE len(way) - 1 END AS INTEGER) AS depth,
  CASE WHEN NOT closed THEN 0 WHEN back = 0 THEN 1 ELSE 2 END AS in_cycle
FROM ends
"""

P7_PATHS = f"""{P7_WALK}
SELECT key, array_to_string(path, ' > ') AS path, CASE WHEN NOT closed THEN 0 WHEN back = 0 THEN 1 ELSE 2 END AS in_cycle FROM paths
"""

P7_DESCENDANTS = f"""{P7_WALK}
SELECT path[i] AS ancestor, key AS descendant, CAST(len(path) - i AS INTEGER) AS distance
FROM (SELECT key, path, unnest(range(1, len(path) + 1)) AS i FROM paths)
"""

ORACLES = {"p2_found": P2, "p4_found": P4, "p4_runs": P4_RUNS, "p6_found": P6, "p7_found": P7, "p7_paths": P7_PATHS, "p7_descendants": P7_DESCENDANTS}
