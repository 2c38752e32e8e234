"""Queries of the general operators over the exported tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.functions import hashing, recognizers, text
from fathomgrid.functions.keys import flexible_time, latest_by, normal_key
from fathomgrid.operators import catalog, identity, masking, nested, sampling, shaping, stats, validation
from fathomgrid.plans.corpus_sql import LATEST, time_sql
from fathomgrid.sources import landed, sinks
from fathomgrid.sources.tables import table
from fathomgrid.streaming import resume

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(q: Query) -> Query:
        QUERIES[name] = q
        if sql:
            ORACLES[name] = sql
        return q

    return keep


ALL_PEOPLE = "(SELECT *, 'github' AS src FROM people_github UNION ALL SELECT *, 'slack' FROM people_slack UNION ALL SELECT *, 'jira' FROM people_jira)"


def people(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [table(spark, d, f"people_{t}").withColumn("src", F.lit(t)) for t in ("github", "slack", "jira")])


# scans and keys


@query("ref_s2_entities", "SELECT DISTINCT split_part(path, '/', 2) AS entity FROM landed_files")
def entities(spark, d):
    return landed.entities(table(spark, d, "landed_files"), "path", 2)


@query("ref_s3_bounded_list", "SELECT path FROM (SELECT path FROM landed_files WHERE starts_with(path, 'slack/') ORDER BY path LIMIT 500) WHERE path LIKE '%.json'")
def bounded_list(spark, d):
    return landed.bounded_keys(table(spark, d, "landed_files"), "path", "slack/", 500, ".json").select("path")


@query("ref_s8_names_from_addresses", """
SELECT email, CASE WHEN len(p) >= 2 THEN upper(p[1][1]) || lower(p[1][2:]) ELSE '' END AS first_name, CASE WHEN len(p) >= 2 THEN upper(p[-1][1]) || lower(p[-1][2:]) ELSE '' END AS last_name,
  trim(CASE WHEN len(p) >= 2 THEN upper(p[1][1]) || lower(p[1][2:]) ELSE '' END || ' ' || CASE WHEN len(p) >= 2 THEN upper(p[-1][1]) || lower(p[-1][2:]) ELSE '' END) AS name
FROM (SELECT email, regexp_split_to_array(split_part(email, '@', 1), '[._]') AS p FROM ALLP WHERE email <> '')""".replace("ALLP", ALL_PEOPLE))
def names_from_addresses(spark, d):
    return landed.users_from_addresses(people(spark, d).where("email <> ''"), "email")


@query("ref_s22_days", "SELECT strftime(x, '%Y%m%d') AS day FROM unnest(generate_series(DATE '2026-02-19', DATE '2026-03-04', INTERVAL 1 DAY)) t(x)")
def last_days(spark, d):
    return landed.days(spark, "2026-03-04", 14)


@query("ref_f1_should_process", r"""
SELECT path, NOT starts_with(path, '_checkpoints/') AND NOT starts_with(path, '_manifest/') AND regexp_extract(path, '[^/]*$') NOT IN ('_index.json', '_stats.json') AND regexp_matches(lower(path), '\.(json|eml|docx|xlsx|pptx)$') AS wanted FROM landed_files""")
def should_process(spark, d):
    return table(spark, d, "landed_files").select("path", landed.should_process(F.col("path")).alias("wanted"))


@query("ref_f3_document_kinds", r"""
SELECT load_id, a.filename AS filename, regexp_matches(lower(a.filename), '\.(docx|xlsx|pptx)$') AS office, regexp_matches(lower(a.filename), '\.(png|jpg|jpeg|gif|bmp|tiff|tif|webp)$') AS image
FROM (SELECT load_id, unnest(attachments) AS a FROM tickets) WHERE a.filename IS NOT NULL""")
def document_kinds(spark, d):
    names = table(spark, d, "tickets").select("load_id", F.explode("attachments.filename").alias("filename")).where("filename is not null")
    return names.select("load_id", "filename", landed.is_office(F.col("filename")).alias("office"), landed.is_image(F.col("filename")).alias("image"))


@query("ref_f4_skipped_files", r"""
SELECT load_id, a.filename AS filename, regexp_matches(lower(a.filename), '\.(mp4|mov|avi|wmv|flv|mkv|webm|apk|ipa|ico|heic)$') AS skipped, a.mime_type LIKE 'image/%' OR a.mime_type LIKE 'video/%' AS media
FROM (SELECT load_id, unnest(attachments) AS a FROM tickets) WHERE a.filename IS NOT NULL AND a.mime_type IS NOT NULL""")
def skipped_files(spark, d):
    files = table(spark, d, "tickets").select("load_id", F.explode("attachments").alias("a")).select("load_id", "a.filename", "a.mime_type").where("filename is not null and mime_type is not null")
    return files.select("load_id", "filename", landed.is_skipped_file(F.col("filename"), F.lit(None).cast("string")).alias("skipped"), landed.is_skipped_drive(F.col("mime_type")).alias("media"))


# sinks


@query("ref_k3_json_lines", f"SELECT rec_id, email, name, sources FROM {ALL_PEOPLE}")
def json_lines(spark, d):
    path = storage.scratch(spark, "lines")
    rows = people(spark, d).select("rec_id", "email", "name", "sources")
    sinks.write_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("ref_k6_parquet_copy", "SELECT event_id, user_id, event_type, value FROM events")
def parquet_copy(spark, d):
    path = storage.scratch(spark, "copy")
    sinks.write_parquet(table(spark, d, "events").select("event_id", "user_id", "event_type", "value"), path, "none")
    return spark.read.parquet(path)


@query("ref_k10_status_table", """
SELECT save_id, rtrim(rpad(split_part(job_id, '/', 1), 10, ' ') || ' ' || rpad(coalesce(regexp_extract(job_id, '/(.*)', 1), ''), 14, ' ') || ' ' || rpad(coalesce(status, '—'), 12, ' ')) AS line FROM checkpoints""")
def status_table(spark, d):
    line = sinks.fixed_width([(F.split_part("job_id", F.lit("/"), F.lit(1)), 10), (F.regexp_extract("job_id", "/(.*)", 1), 14), (F.col("status"), 12)])
    return table(spark, d, "checkpoints").select("save_id", line.alias("line"))


# projections


@query("ref_p1_language_share", """
SELECT source, lang, amount, round(amount * 1.0::DOUBLE / CASE WHEN total = 0 THEN 1 ELSE total END * 100, 2) AS percentage FROM (
  SELECT source, lower(coalesce(lang, '?')) AS lang, sum(n_chars)::BIGINT AS amount, sum(sum(n_chars)) OVER (PARTITION BY source) AS total FROM documents GROUP BY 1, 2)""")
def language_share(spark, d):
    docs = table(spark, d, "documents").withColumn("lang", F.lower(F.coalesce("lang", F.lit("?"))))
    return shaping.shares(docs, ["source"], "lang", F.col("n_chars"))


@query("ref_p4_embed_children", """
SELECT o_orderkey, coalesce(n, 0)::INTEGER AS lines, coalesce(q, 0.0) AS quantity, first_part FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q, arg_min(l_partkey, (l_linenumber, l_partkey)) AS first_part FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def embed_children(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    full = shaping.embed(table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey", "lines", "l_linenumber")
    total = F.aggregate("lines", F.lit(0.0), lambda a, x: a + x["l_quantity"])
    return full.select("o_orderkey", F.size("lines").alias("lines"), total.alias("quantity"), F.get("lines", F.lit(0))["l_partkey"].alias("first_part"))


@query("ref_p7_custom_fields", "SELECT load_id, e.key AS field, e.value AS value FROM (SELECT load_id, unnest(map_entries(custom_fields)) AS e FROM tickets)")
def custom_fields(spark, d):
    return shaping.custom_fields(table(spark, d, "tickets"), "load_id", "custom_fields")


@query("ref_p8_changelog", """
SELECT load_id, (i - 1)::INTEGER AS pos, c.date AS date, c.author AS author, c.field AS field, c."from" AS old, c."to" AS new
FROM (SELECT load_id, unnest(changelog) AS c, generate_subscripts(changelog, 1) AS i FROM tickets) WHERE c IS NOT NULL""")
def changelog(spark, d):
    flat = nested.flatten(table(spark, d, "tickets").select("load_id", "changelog"), "load_id")["changelog"]
    return flat.select(F.col("_id").alias("load_id"), F.element_at("_label", -1).alias("pos"), "date", "author", "field", F.col("from").alias("old"), F.col("to").alias("new"))


@query("ref_p9_document_text", """
WITH RECURSIVE documents_of AS (
  SELECT load_id, CASE WHEN json_type(d) = 'VARCHAR' THEN CASE WHEN json_valid(d ->> '$') THEN (d ->> '$')::JSON END ELSE d END AS doc
  FROM (SELECT load_id, CASE WHEN json_valid(description_adf) THEN description_adf::JSON END AS d FROM tickets)),
tree AS (
  SELECT load_id, []::INTEGER[] AS label, doc AS node FROM documents_of WHERE json_type(doc) = 'OBJECT'
  UNION ALL
  SELECT load_id, list_append(label, i::INTEGER), json_extract(node, '$.content[' || i || ']')
  FROM (SELECT load_id, label, node, unnest(range(json_array_length(node, '$.content')::BIGINT)) AS i FROM tree WHERE json_type(node, '$.content') = 'ARRAY')
  WHERE json_type(node, '$.content[' || i || ']') = 'OBJECT'),
said AS (SELECT load_id, label, CASE node ->> '$.type' WHEN 'text' THEN node ->> '$.text' WHEN 'mention' THEN coalesce(nullif(node ->> '$.attrs.text', ''), node ->> '$.attrs.id') WHEN 'hardBreak' THEN chr(10) END AS said FROM tree)
SELECT t.load_id, CASE WHEN s.load_id IS NULL THEN NULL ELSE coalesce(s.text, '') END AS text FROM tickets t LEFT JOIN (SELECT load_id, string_agg(said, '' ORDER BY label) AS text FROM said GROUP BY 1) s USING (load_id)""")
def document_text(spark, d):
    """Plain text of descriptions."""
    return table(spark, d, "tickets").select("load_id", shaping.document_text(F.col("description_adf")).alias("text"))


@query("ref_p10_thread_replies", """
WITH m AS (SELECT file_id, target, content ->> '$.ts' AS ts, content ->> '$.thread_ts' AS thread_ts, content ->> '$.parent_user_id' AS parent_user_id, content ->> '$.text' AS body
  FROM landed_files WHERE source = 'slack' AND contains(path, '/messages/') AND CASE WHEN json_valid(content) THEN json_type(content) = 'OBJECT' ELSE false END)
SELECT p.file_id, p.target, p.ts, count(*)::INTEGER AS replies, list(r.file_id ORDER BY r.ts, r.file_id) AS reply_files, list(r.body ORDER BY r.ts, r.file_id) AS reply_texts
FROM m p JOIN m r ON r.target = p.target AND r.thread_ts = p.ts AND (r.ts IS NULL OR r.ts <> r.thread_ts OR coalesce(r.parent_user_id, '') <> '') GROUP BY ALL""")
def thread_replies(spark, d):
    full = shaping.thread_replies(landed.messages(table(spark, d, "landed_files")), "target")
    return full.select("file_id", "target", "ts", F.size("_replies").alias("replies"), F.col("_replies.file_id").alias("reply_files"), F.col("_replies.text").alias("reply_texts"))


@query("ref_p17_status_rows", """
SELECT save_id, split_part(job_id, '/', 1) AS exporter, CASE WHEN instr(job_id, '/') = 0 THEN '—' WHEN starts_with(job_id, 'github/') THEN replace(regexp_extract(job_id, '/(.*)', 1), '__', '/') ELSE regexp_extract(job_id, '/(.*)', 1) END AS target, coalesce(status, 'unknown') AS status FROM checkpoints""")
def status_rows(spark, d):
    c = table(spark, d, "checkpoints")
    keyed = shaping.status_rows(c.withColumn("phases", F.col("save_id")))
    return keyed.select(F.col("phases").alias("save_id"), "exporter", "target", "status")


@query("ref_p18_rewritten_keys", "SELECT file_id, replace(replace(path, 'HARBOR', 'NORTH'), 'HARB', 'NRTH') AS key FROM landed_files")
def rewritten_keys(spark, d):
    return table(spark, d, "landed_files").select("file_id", text.literal_chain(F.col("path"), [("HARBOR", "NORTH"), ("HARB", "NRTH")]).alias("key"))


@query("ref_p19_masked_strings", """
SELECT rec_id, replace(email, 'harborworks', 'acme') AS email, replace(name, 'harborworks', 'acme') AS name, [replace(s, 'harborworks', 'acme') FOR s IN sources] AS sources FROM ALLP""".replace("ALLP", ALL_PEOPLE))
def masked_strings(spark, d):
    rows = people(spark, d).select("rec_id", "email", "name", "sources")
    return masking.mask_columns(rows, {}, lambda c: F.replace(c, F.lit("harborworks"), F.lit("acme")))


@query("ref_p20_organisation_names", f"SELECT rec_id, replace(replace(replace(email, 'harborworks', 'acme'), 'Harborworks', 'Acme'), 'HARBORWORKS', 'ACME') AS email FROM {ALL_PEOPLE} WHERE email <> ''")
def organisation_names(spark, d):
    return people(spark, d).where("email <> ''").select("rec_id", text.literal_chain(F.col("email"), text.cased("harborworks", "acme")).alias("email"))


# detection in text


def texts(spark, d):
    """All free texts of tickets: load_id, field, pos (-1 outside comments), text."""
    one = lambda n, pos, c: F.struct(F.lit(n).alias("field"), pos.alias("pos"), c.alias("text"))
    own = F.array(*[one(n, F.lit(-1), F.col(n)) for n in ("summary", "description_text")])
    said = F.transform("comments", lambda c, i: one("body_text", i, c["body_text"]))
    return table(spark, d, "tickets").select("load_id", F.explode(F.concat(own, F.coalesce(said, F.slice(own, 1, 0)))).alias("t")).select("load_id", "t.*").where("text is not null")


TEXTS = """(SELECT load_id, 'summary' AS field, -1 AS pos, summary AS text FROM tickets WHERE summary IS NOT NULL UNION ALL SELECT load_id, 'description_text', -1, description_text FROM tickets WHERE description_text IS NOT NULL
UNION ALL SELECT load_id, 'body_text', (i - 1)::INTEGER, c.body_text FROM (SELECT load_id, unnest(comments) AS c, generate_subscripts(comments, 1) AS i FROM tickets) WHERE c.body_text IS NOT NULL)"""


def _recognised(kind: str):
    def run(spark, d):
        return texts(spark, d).select("load_id", "field", "pos", F.explode(recognizers.matches(F.col("text"), kind)).alias("found"))

    return run


for _kind in ("EMAIL_ADDRESS", "IP_ADDRESS", "US_SSN", "IN_AADHAAR"):
    query(f"ref_t1_{_kind.lower()}", f"SELECT load_id, field, pos, unnest(regexp_extract_all(text, '(?i){recognizers.BY_KIND[_kind].regex}')) AS found FROM {TEXTS}")(_recognised(_kind))


def _places_sql(p: recognizers.Pattern) -> str:
    """Places of a pattern's matches in the texts: between matches stands what splitting leaves. Digits around a telephone number are matched with it, as this engine looks neither back nor ahead."""
    phone = p.kind == "PHONE_NUMBER"
    pattern = r"(^|[^0-9])(\+?91[\s-]?[6-9]\d{9})($|[^0-9])" if phone else p.regex
    found = lambda group: f"regexp_extract_all(text, '(?i){pattern}', {group})"
    return f"""SELECT load_id, field, pos, '{p.kind}' AS kind, {p.score}::DOUBLE AS score, (list_sum([length(x) FOR x IN s[1:i]]) + coalesce(list_sum([length(x) FOR x IN w[1:i - 1]]), 0) + {"length(g[i])" if phone else 0})::INTEGER AS s, length(b[i])::INTEGER AS n
FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM (SELECT load_id, field, pos, regexp_split_to_array(text, '(?i){pattern}') AS s, {found(0)} AS w, {found(2 if phone else 0)} AS b, {found(1) if phone else "NULL"} AS g FROM texts))"""


@query("ref_t4_spans", f"""
WITH RECURSIVE texts AS {TEXTS}, x AS ({" UNION ALL ".join(_places_sql(p) for p in recognizers.PATTERNS if p.score >= 0.5)}),
o AS (SELECT *, s + n AS e, row_number() OVER (PARTITION BY load_id, field, pos ORDER BY s, n DESC, score DESC) AS rn FROM x WHERE n >= 3),
walk AS (
  SELECT load_id, field, pos, rn, kind, s, e, score FROM o WHERE rn = 1
  UNION ALL
  SELECT o.load_id, o.field, o.pos, o.rn, o.kind, o.s, o.e, o.score FROM walk w JOIN o ON o.load_id = w.load_id AND o.field = w.field AND o.pos = w.pos
    AND o.rn = (SELECT min(q.rn) FROM o q WHERE q.load_id = w.load_id AND q.field = w.field AND q.pos = w.pos AND q.rn > w.rn AND q.s >= w.e))
SELECT load_id, field, pos, kind, s AS start, e AS "end", score FROM walk""")
def spans(spark, d):
    """Resolved spans of all recognizers in the texts."""
    return texts(spark, d).select("load_id", "field", "pos", F.explode(recognizers.spans(F.col("text"))).alias("s")).select("load_id", "field", "pos", "s.*")


@query("ref_t6_domain_replace", f"SELECT load_id, field, pos, md5(replace(replace(text, 'harborworks.example', 'acme.test'), 'Harborworks.example', 'Acme.test')) AS digest FROM {TEXTS}")
def domain_replace(spark, d):
    masked = text.literal_chain(F.col("text"), [("harborworks.example", "acme.test"), ("Harborworks.example", "Acme.test")])
    return texts(spark, d).select("load_id", "field", "pos", F.md5(masked).alias("digest"))


@query("ref_t11_css_strip", r"""
SELECT load_id, pos, length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<style[^>]*>.*?</style>', '', 'g'), '(?s)<script[^>]*>.*?</script>', '', 'g'), '\sstyle="[^"]*"', '', 'g'), '\sstyle=''[^'']*''', '', 'g'), '\sclass="[^"]*"', '', 'g'))::INTEGER AS n
FROM (SELECT load_id, (i - 1)::INTEGER AS pos, c.rendered_body AS html FROM (SELECT load_id, unnest(comments) AS c, generate_subscripts(comments, 1) AS i FROM tickets) WHERE c.rendered_body IS NOT NULL)""")
def css_strip(spark, d):
    html = table(spark, d, "tickets").select("load_id", F.posexplode("comments.rendered_body").alias("pos", "html")).where("html is not null")
    return html.select("load_id", "pos", F.length(text.chain(F.col("html"), text.STYLE_CHAIN)).alias("n"))


LEAK_VALUES = f"""
SELECT DISTINCT 'email' AS kind, lower(email) AS value FROM {ALL_PEOPLE} WHERE length(email) >= 5
UNION SELECT DISTINCT 'name', lower(name) FROM {ALL_PEOPLE} WHERE length(name) >= 8 AND contains(name, ' ')"""


def _entries(spark, d):
    one = lambda k, c: F.struct(F.lit(k).alias("entity_type"), F.col(c).alias("real_value"))
    kinds = F.array(one("EMAIL_ADDRESS", "email"), one("PERSON", "name"), one("GITHUB_LOGIN", "github_login"), one("SLACK_USER_ID", "slack_user_id"), one("JIRA_ACCOUNT_ID", "jira_account_id"))
    return people(spark, d).select(F.col("rec_id").alias("id"), F.lit("roster_import").alias("source"), F.explode(kinds).alias("e")).select("id", "source", "e.*").where("real_value <> ''")


@query("ref_f8_leak_values", LEAK_VALUES)
def leak_values(spark, d):
    return validation.leak_values(_entries(spark, d))


@query("ref_t15_leaks", f"""
SELECT t.load_id, t.field, t.pos, v.kind, v.value FROM {TEXTS} t JOIN ({LEAK_VALUES}) v ON contains(lower(t.text), v.value)
WHERE v.kind = 'email' OR regexp_matches(' ' || lower(t.text) || ' ', '[^\\p{{L}}\\p{{N}}]' || regexp_escape(v.value) || '[^\\p{{L}}\\p{{N}}]')""".replace("\\\\", "\\"))
def leaks(spark, d):
    rows = texts(spark, d).select(F.concat_ws(":", "load_id", "field", "pos").alias("key"), "text")
    found = validation.leaks(rows, "key", "text", validation.leak_values(_entries(spark, d)))
    part = lambda n: F.split_part("key", F.lit(":"), F.lit(n))
    return found.select(part(1).cast("long").alias("load_id"), part(2).alias("field"), part(3).cast("int").alias("pos"), "kind", "value")


@query("ref_t16_unreadable", "SELECT doc_id, regexp_full_match(trim(coalesce(text, '')), '(?i)[0-9a-f]{20,}') AS unreadable FROM documents")
def unreadable(spark, d):
    return table(spark, d, "documents").select("doc_id", validation.unreadable(F.coalesce("text", F.lit(""))).alias("unreadable"))


@query("ref_t17_broken_json", "SELECT file_id FROM landed_files WHERE content IS NULL OR NOT json_valid(content)")
def broken_json(spark, d):
    return validation.broken_json(table(spark, d, "landed_files"), "file_id", "content")


@query("ref_t18_leaking_keys", "SELECT path FROM landed_files WHERE contains(lower(path), 'harb') OR contains(lower(path), 'c0web')")
def leaking_keys(spark, d):
    return validation.leaking_keys(table(spark, d, "landed_files"), "path", ["Harb", "C0WEB"])


# joins


@query("ref_j1_identity_lookup", f"""
SELECT t.load_id AS load_id, CASE WHEN t.assignee_email IS NULL THEN NULL ELSE coalesce(p.masked, 'unknown') END AS masked FROM tickets t LEFT JOIN (
  SELECT lower(email) AS k, min('user-' || substr(sha256('pii-store:' || lower(email)), 1, 10)) AS masked FROM {ALL_PEOPLE} WHERE email <> '' GROUP BY 1) p ON p.k = lower(t.assignee_email)""")
def identity_lookup(spark, d):
    entries = people(spark, d).where("email <> ''").select(F.lit("EMAIL_ADDRESS").alias("entity_type"), F.col("email").alias("real_value"), hashing.login(F.lower("email"), hashing.STORE_SALT).alias("masked_value"))
    return identity.lookup(table(spark, d, "tickets").select("load_id", "assignee_email"), entries, "EMAIL_ADDRESS", F.col("assignee_email"), F.lit("unknown"), "masked").select("load_id", "masked")


@query("ref_j2_get_or_create", """
WITH seen AS (SELECT 'JIRA_ACCOUNT_ID' AS kind, reporter_account_id AS v FROM tickets UNION ALL SELECT 'EMAIL_ADDRESS', assignee_email FROM tickets UNION ALL SELECT 'PHONE_NUMBER', load_id::VARCHAR FROM tickets),
old AS (SELECT 'JIRA_ACCOUNT_ID' AS kind, lower(jira_account_id) AS k FROM people_jira UNION ALL SELECT 'EMAIL_ADDRESS', lower(email) FROM people_slack),
fresh AS (SELECT kind, min(v) AS v FROM seen WHERE v <> '' AND NOT EXISTS (SELECT 1 FROM old WHERE old.kind = seen.kind AND old.k = lower(seen.v)) GROUP BY kind, lower(v))
SELECT kind AS entity_type, v AS real_value, CASE kind WHEN 'JIRA_ACCOUNT_ID' THEN 'mask-' || substr(sha256('pii-store:' || v), 1, 8) WHEN 'PHONE_NUMBER' THEN '[PHONE-' || substr(sha256('pii-store:' || v), 1, 6) || ']' ELSE '[EMAIL_ADDRESS-' || substr(sha256('pii-store:' || v), 1, 8) || ']' END AS masked_value FROM fresh""")
def get_or_create(spark, d):
    one = lambda k, c: F.struct(F.lit(k).alias("entity_type"), F.col(c).cast("string").alias("real_value"))
    known = table(spark, d, "people_jira").select(one("JIRA_ACCOUNT_ID", "jira_account_id").alias("e")).unionByName(table(spark, d, "people_slack").select(one("EMAIL_ADDRESS", "email").alias("e")))
    seen = table(spark, d, "tickets").select(F.explode(F.array(one("JIRA_ACCOUNT_ID", "reporter_account_id"), one("EMAIL_ADDRESS", "assignee_email"), one("PHONE_NUMBER", "load_id"))).alias("e")).select("e.*")
    return identity.get_or_create(known.select("e.*").withColumn("masked_value", F.lit("x")), seen)


PERSON_SQL = f"""
WITH recs AS (SELECT rec_id, lower(coalesce(email, '')) AS mail, coalesce(name, '') AS name, coalesce(github_login, '') AS login FROM {ALL_PEOPLE}),
persons AS (SELECT mail, arg_min(name, rec_id) FILTER (name <> '') AS name, min(rec_id) AS first_id FROM recs WHERE mail <> '' GROUP BY mail),
by_name AS (SELECT lower(name) AS k, arg_max(mail, first_id) AS m FROM persons WHERE name IS NOT NULL GROUP BY 1),
locals AS (SELECT DISTINCT unnest([split_part(mail, '@', 1), replace(replace(split_part(mail, '@', 1), '.', ''), '_', '')]) AS k, mail, first_id FROM persons WHERE contains(mail, '@')),
by_local AS (SELECT k, arg_max(mail, first_id) AS m FROM locals GROUP BY k),
resolved AS (
  SELECT r.rec_id, CASE WHEN r.mail <> '' THEN r.mail ELSE coalesce(n.m, l.m, j.m, '_orphan_' || r.rec_id) END AS person
  FROM recs r LEFT JOIN by_name n ON r.name <> '' AND n.k = lower(r.name) LEFT JOIN by_local l ON r.login <> '' AND l.k = lower(r.login) LEFT JOIN by_local j ON r.name <> '' AND j.k = replace(lower(r.name), ' ', ''))"""


@query("ref_j4_resolved_persons", PERSON_SQL + " SELECT rec_id, person FROM resolved")
def resolved_persons(spark, d):
    return identity.resolve_persons(people(spark, d), "rec_id").select("rec_id", "person")


@query("ref_j5_merged_persons", PERSON_SQL + f"""
SELECT r.person AS person, coalesce(arg_min(a.name, a.rec_id) FILTER (a.name <> ''), '') AS name, coalesce(arg_min(a.github_login, a.rec_id) FILTER (a.github_login <> ''), '') AS github_login, count(*) AS records, coalesce(any_value(s.sources), []) AS sources
FROM resolved r JOIN {ALL_PEOPLE} a USING (rec_id) LEFT JOIN (
  SELECT person, list(s ORDER BY o, s) AS sources FROM (SELECT person, s, min(rec_id) AS o FROM (SELECT r.person, r.rec_id, unnest(a.sources) AS s FROM resolved r JOIN {ALL_PEOPLE} a USING (rec_id)) WHERE s IS NOT NULL GROUP BY 1, 2) GROUP BY 1) s ON s.person = r.person GROUP BY 1""")
def merged_persons(spark, d):
    return identity.merge_persons(people(spark, d), "rec_id").select("person", "name", "github_login", "records", "sources")


@query("ref_j6_incremental_roster", """
WITH old AS (SELECT lower(email) AS email, min('user-' || lpad(rec_id::VARCHAR, 4, '0')) AS id FROM people_jira WHERE email <> '' GROUP BY 1),
fresh AS (SELECT DISTINCT lower(email) AS email FROM people_slack WHERE email <> '' AND lower(email) NOT IN (SELECT email FROM old))
SELECT id, email FROM old UNION ALL
SELECT 'user-' || lpad((row_number() OVER (ORDER BY email) + (SELECT max(rec_id) FROM people_jira WHERE email <> ''))::VARCHAR, greatest(4, length((row_number() OVER (ORDER BY email) + (SELECT max(rec_id) FROM people_jira WHERE email <> ''))::VARCHAR))::INTEGER, '0'), email FROM fresh""")
def incremental_roster(spark, d):
    existing = table(spark, d, "people_jira").where("email <> ''").select(F.format_string("user-%04d", "rec_id").alias("id"), "email")
    return identity.incremental_roster(existing, table(spark, d, "people_slack").select("email"))


@query("ref_j7_resume", f"""
WITH {LATEST}, done AS (SELECT DISTINCT nullif(upper(regexp_replace(k, '^\\s+|\\s+$', '', 'g')), '') AS key FROM (SELECT unnest(phases['tickets'].completed_ids) AS k FROM checkpoints))
SELECT key FROM latest WHERE key NOT IN (SELECT key FROM done WHERE key IS NOT NULL)""".replace("\\\\", "\\"))
def resumed(spark, d):
    keys = table(spark, d, "tickets").select(normal_key(F.col("key")).alias("key")).where("key is not null").distinct()
    return resume.remaining(keys, "key", resume.completed_items(table(spark, d, "checkpoints"), "tickets"))


@query("ref_j8_index_keys", """
WITH entries AS (SELECT regexp_replace(path, '/[^/]*$', '') AS base, unnest(CASE WHEN source = 'jira' THEN json_extract_string(content, '$.keys[*]') ELSE json_extract_string(content, '$[*]') END) AS name FROM landed_files
  WHERE lower(source) IN ('jira', 'slack') AND path LIKE '%/\\_index.json' ESCAPE '\\' AND CASE WHEN json_valid(content) THEN json_type(content) = CASE WHEN source = 'jira' THEN 'OBJECT' ELSE 'ARRAY' END ELSE false END)
SELECT DISTINCT base || '/' || name || '.json' AS key, (base || '/' || name || '.json') IN (SELECT path FROM landed_files) AS exists FROM entries WHERE trim(name) <> ''""".replace("\\\\", "\\"))
def index_keys(spark, d):
    files = table(spark, d, "landed_files")
    indexes = files.where(F.col("path").endswith("/_index.json")).select("source", F.regexp_replace("path", "/[^/]*$", "").alias("base"), "content")
    return landed.existing(landed.index_keys(indexes), files.select(F.col("path").alias("key")))


@query("ref_j12_masked_addresses", f"""
SELECT rec_id, CASE WHEN email = '' OR email IS NULL THEN email WHEN contains(email, '@') THEN substr(sha256('pii-mask-fallback-v1:' || regexp_replace(email, '@[^@]*$', '')), 1, 8) || '@' || coalesce(m.masked, regexp_extract(email, '@([^@]*)$', 1)) ELSE substr(sha256('pii-mask-fallback-v1:' || email), 1, 12) END AS masked
FROM {ALL_PEOPLE} LEFT JOIN (SELECT * FROM (VALUES ('harborworks.example', 'acme.test'), ('mailnest.test', 'box.test')) v(real, masked)) m ON m.real = lower(regexp_extract(email, '@([^@]*)$', 1))""")
def masked_addresses(spark, d):
    domains = spark.createDataFrame([("harborworks.example", "acme.test"), ("mailnest.test", "box.test")], "real_domain string, masked_domain string")
    return identity.map_addresses(people(spark, d).select("rec_id", "email"), "email", domains, "masked").select("rec_id", "masked")


# aggregations


@query("ref_a2_count_maps", "SELECT project_key, CASE WHEN coalesce(issue_type, '') = '' THEN 'Unknown' ELSE issue_type END AS value, count(*) AS n FROM tickets GROUP BY 1, 2")
def count_maps(spark, d):
    return stats.histogram(table(spark, d, "tickets"), F.col("issue_type"), ["project_key"])


@query("ref_a3_change_sizes", """
SELECT project_key AS target, count(*) AS total, count(*) FILTER (m) AS merged, count(*) FILTER (NOT m AND resolution IS NULL) AS open, count(*) FILTER (NOT m AND resolution IS NOT NULL) AS closed,
  sum(coalesce(len([1 FOR x IN changelog IF x IS NOT NULL]), 0))::BIGINT AS total_reviews, sum(coalesce(len([1 FOR x IN attachments IF x IS NOT NULL]), 0))::BIGINT AS total_review_comments, sum(coalesce(len([1 FOR x IN comments IF x IS NOT NULL]), 0))::BIGINT AS total_comments,
  sum(coalesce(attachments[1].size, 0))::BIGINT AS total_additions, sum(coalesce(attachments[2].size, 0))::BIGINT AS total_deletions, sum(coalesce(len(attachments), 0))::BIGINT AS total_changed_files
FROM (SELECT *, coalesce(resolved::VARCHAR, '') <> '' AS m FROM tickets) GROUP BY 1""")
def change_sizes(spark, d):
    size = lambda i: F.get("attachments", F.lit(i))["size"]
    t = table(spark, d, "tickets").select(
        F.col("project_key").alias("target"), F.col("resolved").cast("string").alias("merged_at"), F.when(F.col("resolution").isNull(), "open").otherwise("closed").alias("state"),
        F.col("changelog").alias("reviews"), F.col("attachments").alias("review_comments"), "comments", size(0).alias("additions"), size(1).alias("deletions"), F.when(F.col("attachments").isNotNull(), F.size("attachments")).alias("changed_files"),
    )
    return stats.change_stats(t, "target")


@query("ref_a4_commit_stats", "SELECT event_type AS target, count(*) AS total, count(DISTINCT user_id) AS unique_authors, min(event_id) AS first_at, max(event_id) AS last_at FROM events GROUP BY 1")
def commit_stats(spark, d):
    return stats.commit_stats(table(spark, d, "events").withColumnRenamed("event_type", "target"), "target", F.col("user_id"), F.col("event_id"))


@query("ref_a5_ticket_stats", """
SELECT project_key, count(*) AS total_tickets, sum(nc)::BIGINT AS total_comments, count(*) FILTER (nc > 0) AS tickets_with_comments, sum(na)::BIGINT AS total_attachments, sum(sz)::BIGINT AS total_attachment_size_bytes, sum(nl)::BIGINT AS total_changelog_entries FROM (
  SELECT project_key, coalesce(len([1 FOR x IN comments IF x IS NOT NULL]), 0) AS nc, coalesce(len([1 FOR x IN attachments IF x IS NOT NULL]), 0) AS na, coalesce(list_sum([coalesce(x.size, 0) FOR x IN attachments]), 0) AS sz, coalesce(len([1 FOR x IN changelog IF x IS NOT NULL]), 0) AS nl FROM tickets) GROUP BY 1""")
def ticket_stats(spark, d):
    return stats.ticket_stats(table(spark, d, "tickets"), "project_key")


@query("ref_a6_file_endings", r"""
SELECT project_key, CASE WHEN contains(f, '.') THEN lower('.' || regexp_extract(f, '[^.]*$')) ELSE '.unknown' END AS value, count(*) AS n FROM (
  SELECT project_key, unnest([x.filename FOR x IN attachments]) AS f FROM tickets) WHERE f IS NOT NULL GROUP BY 1, 2""")
def file_endings(spark, d):
    names = table(spark, d, "tickets").select("project_key", F.explode("attachments.filename").alias("f")).where("f is not null")
    return stats.file_endings(names, "f", ["project_key"])


@query("ref_a12_summary", """
SELECT 'jira' AS exporter, unnest(['targets', 'total', 'comments']) AS measure, unnest([count(*), sum(n)::BIGINT, sum(c)::BIGINT]) AS value FROM (SELECT project_key, count(*) AS n, sum(coalesce(len([1 FOR x IN comments IF x IS NOT NULL]), 0)) AS c FROM tickets GROUP BY 1)
UNION ALL SELECT 'slack', unnest(['targets', 'total']), unnest([count(*), sum(n)::BIGINT]) FROM (SELECT target, count(*) AS n FROM landed_files WHERE source = 'slack' GROUP BY 1)
UNION ALL SELECT 'github', unnest(['targets', 'total']), unnest([count(*), sum(n)::BIGINT]) FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""")
def summary(spark, d):
    jira = stats.ticket_stats(table(spark, d, "tickets"), "project_key").select(F.col("total_tickets").alias("total"), F.col("total_comments").alias("comments"))
    slack = table(spark, d, "landed_files").where("source = 'slack'").groupBy("target").agg(F.count(F.lit(1)).alias("total"))
    github = stats.commit_stats(table(spark, d, "events"), "event_type", F.col("user_id"), F.col("event_id"))
    return catalog.summary({"jira": jira, "slack": slack, "github": github}, {"jira": ["total", "comments"], "slack": ["total"], "github": ["total"], "google_workspace": ["total"]})


@query("ref_a13_manifest", """
SELECT source AS masker, count(*) AS total, count(*) FILTER (s = 'ok') AS masked, count(*) FILTER (s = 'skipped') AS skipped, count(*) FILTER (s = 'error') AS failed FROM (
  SELECT source, CASE WHEN path LIKE '%/\\_%' ESCAPE '\\' THEN 'skipped' WHEN content IS NULL OR content = '' THEN 'error' ELSE 'ok' END AS s FROM landed_files) GROUP BY ROLLUP (source)""".replace("\\\\", "\\"))
def manifest(spark, d):
    status = F.when(F.contains("path", F.lit("/_")), "skipped").when(F.col("content").isNull() | (F.col("content") == ""), "error").otherwise("ok (1 row)")
    return stats.manifest(table(spark, d, "landed_files").select(F.col("source").alias("masker"), status.alias("status")))


@query("ref_a14_report", "SELECT c AS \"check\", n AS findings, f AS files, n = 0 AS passed FROM (SELECT 'broken' AS c, count(*) AS n, count(DISTINCT path) AS f FROM landed_files WHERE content IS NULL OR content = '' UNION ALL SELECT 'keys', 0, 0)")
def leak_report(spark, d):
    found = table(spark, d, "landed_files").where("content is null or content = ''").select(F.lit("broken").alias("check"), F.col("path").alias("file"), F.lit("").alias("value"))
    return validation.report(found, ["broken", "keys"]).drop("examples")


@query("ref_a15_store_stats", f"SELECT unnest(['EMAIL_ADDRESS', 'GITHUB_LOGIN']) AS entity_type, unnest([count(DISTINCT lower(email)) FILTER (email <> ''), count(DISTINCT lower(github_login)) FILTER (github_login <> '')]) AS n FROM {ALL_PEOPLE}")
def store_stats(spark, d):
    return identity.entry_counts(_entries(spark, d).where("entity_type in ('EMAIL_ADDRESS', 'GITHUB_LOGIN')"))


@query("ref_a16_phase_summary", """
SELECT save_id, CASE WHEN phases IS NULL OR cardinality(phases) = 0 THEN 'no phases' WHEN done = total THEN total || '/' || total || ' complete' ELSE done || '/' || total || ' (' || now || ')' END AS line FROM (
  SELECT save_id, phases, cardinality(phases) AS total, len([k FOR k IN map_keys(phases) IF phases[k].status = 'completed']) AS done, list_sort([k FOR k IN map_keys(phases) IF coalesce(phases[k].status, '') <> 'completed'])[1] AS now FROM checkpoints)""")
def phase_summary(spark, d):
    return table(spark, d, "checkpoints").select("save_id", shaping.phase_summary(F.col("phases")).alias("line"))


@query("ref_a17_group_order", "SELECT row_number() OVER (ORDER BY total DESC)::INTEGER AS place, o_orderstatus, total FROM (SELECT o_orderstatus, sum(o_totalprice) AS total FROM orders GROUP BY 1)")
def group_order(spark, d):
    return catalog.ranked(table(spark, d, "orders"), "o_orderstatus", F.col("o_totalprice"))


@query("ref_a18_union_totals", "SELECT 'tickets' AS part, count(*) AS n FROM tickets UNION ALL SELECT 'files', count(*) FROM landed_files UNION ALL SELECT 'documents', count(*) FROM documents")
def union_totals(spark, d):
    return catalog.totals({"tickets": table(spark, d, "tickets"), "files": table(spark, d, "landed_files"), "documents": table(spark, d, "documents")})


@query("ref_a19_custom_field_names", "SELECT DISTINCT k AS name FROM (SELECT unnest(map_keys(custom_fields)) AS k FROM tickets)")
def custom_field_names(spark, d):
    return shaping.custom_fields(table(spark, d, "tickets"), "load_id", "custom_fields").select(F.col("field").alias("name")).distinct()


@query("ref_a21_timing", "SELECT event_type, count(*) AS runs, round(avg(value), 6) AS mean_s, round(stddev_samp(value), 6) AS stdev_s, round(1.0 / avg(value), 6) AS per_second FROM events GROUP BY 1")
def timing(spark, d):
    return stats.timing(table(spark, d, "events"), "event_type", "value")


# order, limits, samples, sets


@query("ref_o1_top", "SELECT arg_max(user_id, (n, user_id)) AS user_id, max(n) AS n FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)")
def top(spark, d):
    counts = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max(F.struct("n", "user_id")).alias("t")).select("t.user_id", "t.n")


@query("ref_o3_per_target_limit", "SELECT project_key, load_id FROM (SELECT project_key, load_id, row_number() OVER (PARTITION BY project_key ORDER BY load_id DESC) AS r FROM tickets) WHERE r <= 5")
def per_target_limit(spark, d):
    return sampling.first_per_group(table(spark, d, "tickets").select("project_key", "load_id"), ["project_key"], [F.col("load_id").desc()], 5)


@query("ref_o5_stratified_sample", """
WITH chosen AS (SELECT DISTINCT source FROM documents QUALIFY row_number() OVER (ORDER BY md5('42:' || source)) <= 1000),
t AS (SELECT source FROM (SELECT DISTINCT source FROM documents) ORDER BY md5('42:' || source) LIMIT 10)
SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || source || ':' || doc_id)) AS r FROM documents WHERE source IN (SELECT source FROM t)) WHERE r <= 4""")
def stratified_sample(spark, d):
    return sampling.stratified(table(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", 10, 4)


@query("ref_o5_target_shares", "SELECT source, n, CASE source WHEN 'jira' THEN greatest(3, n // 100) WHEN 'slack' THEN greatest(10, n // 30) ELSE least(n, 5) END AS targets FROM (SELECT source, count(DISTINCT target) AS n FROM landed_files GROUP BY 1)")
def target_shares(spark, d):
    """How many targets of each source a sample takes, given how many there are."""
    counts = table(spark, d, "landed_files").groupBy("source").agg(F.count_distinct("target").alias("n")).collect()
    return spark.createDataFrame([(r.source, r.n, sampling.target_share(r.source, r.n)) for r in counts], "source string, n long, targets long")


@query("ref_o8_message_order", r"SELECT file_id, coalesce(try_cast(regexp_extract(path, '(\d{10}\.\d{6})') AS DOUBLE), 0) AS at FROM landed_files")
def message_order(spark, d):
    return table(spark, d, "landed_files").select("file_id", sampling.numeric_ts(F.regexp_extract("path", r"(\d{10}\.\d{6})", 1)).alias("at"))


@query("ref_u1_file_types", """
SELECT 'jira' AS exporter, project_key AS target, 'attachments' AS category, m AS file_type, count(*) AS count FROM (SELECT project_key, unnest([x.mime_type FOR x IN attachments]) AS m FROM tickets) WHERE m <> '' GROUP BY 2, 4
UNION ALL SELECT 'slack', target, 'files', CASE WHEN contains(name, '.') THEN lower('.' || regexp_extract(name, '[^.]*$')) ELSE '.unknown' END, count(*) FROM (SELECT target, regexp_extract(path, '[^/]*$') AS name FROM landed_files WHERE source = 'slack') GROUP BY 2, 4""")
def file_types(spark, d):
    mimes = table(spark, d, "tickets").select(F.col("project_key").alias("target"), F.explode("attachments.mime_type").alias("m")).where("m <> ''")
    jira = stats.count_map(mimes, F.col("m"), ["target"], "by_mime_type").select("target", F.struct("by_mime_type").alias("attachments"))
    names = table(spark, d, "landed_files").where("source = 'slack'").select("target", F.substring_index("path", "/", -1).alias("name"))
    slack = stats.count_map(names, text.extension(F.col("name")), ["target"], "by_extension").select("target", F.struct("by_extension").alias("files"))
    return catalog.file_types({"jira": jira, "slack": slack})


@query("ref_u5_completed_union", f"""
SELECT DISTINCT upper(trim(k)) AS key FROM (SELECT unnest(p['tickets'].completed_ids) AS k FROM (SELECT phases AS p FROM checkpoints) UNION ALL SELECT key FROM tickets) WHERE trim(k) <> ''""".replace("upper(trim(k))", "nullif(upper(regexp_replace(k, '^\\s+|\\s+$', '', 'g')), '')").replace("WHERE trim(k) <> ''", "WHERE regexp_replace(k, '\\s', '', 'g') <> ''"))
def completed_union(spark, d):
    done = resume.completed_items(table(spark, d, "checkpoints"), "tickets").select("key")
    return resume.union_ids(done, table(spark, d, "tickets").select(normal_key(F.col("key")).alias("key")).where("key is not null"))


# scalar functions


@query("ref_x1_file_names", r"""
WITH s AS (SELECT load_id, f, regexp_replace(regexp_replace(f, '[/\\?#\x00-\x1f\x7f]', '_', 'g'), '^[. ]+|[. ]+$', '', 'g') AS n FROM (SELECT load_id, unnest([x.filename FOR x IN attachments]) AS f FROM tickets) WHERE f IS NOT NULL)
SELECT load_id, f AS filename, CASE WHEN n = '' THEN 'unnamed' ELSE n END AS safe FROM s""")
def file_names(spark, d):
    names = table(spark, d, "tickets").select("load_id", F.explode("attachments.filename").alias("filename")).where("filename is not null")
    return names.select("load_id", "filename", text.file_name(F.col("filename")).alias("safe"))


@query("ref_x2_slugs", "SELECT save_id, replace(replace(job_id, '/', '__'), '@', '_at_') AS slug FROM checkpoints")
def slugs(spark, d):
    return table(spark, d, "checkpoints").select("save_id", text.slug(F.col("job_id")).alias("slug"))


def _hash_sql(salt: str, value: str, n: int) -> str:
    return f"substr(sha256('{salt}' || {value}), 1, {n})"


@query("ref_x4_store_hash", f"SELECT c_custkey, {_hash_sql('pii-store:', 'c_name', 8)} AS hash FROM customer")
def store_hash(spark, d):
    return table(spark, d, "customer").select("c_custkey", hashing.salted(F.col("c_name"), hashing.STORE_SALT, 8).alias("hash"))


@query("ref_x6_hashed_people", f"""
SELECT s_suppkey, 'user-' || {_hash_sql(hashing.GITHUB_SALT, 's_name', 10)} AS login, 'User ' || {_hash_sql(hashing.JIRA_SALT, 's_name', 8)} AS name, 'acct-' || {_hash_sql(hashing.CONFLUENCE_SALT, 's_name', 16)} AS account, {_hash_sql(hashing.JIRA_SALT, 's_name', 24)} AS text FROM supplier""")
def hashed_people(spark, d):
    c = F.col("s_name")
    return table(spark, d, "supplier").select("s_suppkey", hashing.login(c).alias("login"), hashing.person(c, hashing.JIRA_SALT).alias("name"), hashing.account(c, hashing.CONFLUENCE_SALT).alias("account"), hashing.text(c, hashing.JIRA_SALT).alias("text"))


@query("ref_x10_stand_ins", """
SELECT o_orderkey, '[PHONE-' || substr(h, 1, 6) || ']' AS phone, '10.0.' || ('0x' || substr(h, 1, 2))::INTEGER || '.' || ('0x' || substr(h, 3, 2))::INTEGER AS ip, 'ZZZZZ' || upper(substr(h, 1, 4)) || 'Z' AS pan,
  substr(t, 1, 4) || ' ' || substr(t, 5, 4) || ' ' || substr(t, 9, 4) AS aadhaar, (('0x' || substr(h, 1, 4))::INTEGER % 180 - 90) || '.0000,' || (('0x' || substr(h, 5, 4))::INTEGER % 360 - 180) || '.0000' AS geo
FROM (SELECT o_orderkey, h, translate(substr(h, 1, 12), 'abcdef', '012345') AS t FROM (SELECT o_orderkey, sha256('pii-store:' || o_orderkey::VARCHAR) AS h FROM orders))""")
def stand_ins(spark, d):
    v = F.col("o_orderkey").cast("string")
    kinds = {"phone": "PHONE_NUMBER", "ip": "IP_ADDRESS", "pan": "IN_PAN", "aadhaar": "IN_AADHAAR", "geo": "GEO_COORDINATE"}
    return table(spark, d, "orders").select("o_orderkey", *[hashing.stand_in(k, v).alias(n) for n, k in kinds.items()])


@query("ref_x12_url_chain", r"""
SELECT event_id, regexp_replace(regexp_replace(regexp_replace(u, '/doctor/[a-zA-Z0-9_-]+', '/doctor/redacted', 'g'), '/consult/[^/?#]+', '/consult/redacted', 'g'), 'practice_id=[0-9]+', 'practice_id=0', 'g') AS url
FROM (SELECT event_id, 'https://x.test/doctor/' || event_type || '-' || user_id || '/consult/q' || event_id || '?practice_id=' || user_id AS u FROM events)""")
def url_chain(spark, d):
    u = F.concat(F.lit("https://x.test/doctor/"), "event_type", F.lit("-"), F.col("user_id").cast("string"), F.lit("/consult/q"), F.col("event_id").cast("string"), F.lit("?practice_id="), F.col("user_id").cast("string"))
    return table(spark, d, "events").select("event_id", text.chain(u, text.URL_CHAIN).alias("url"))


@query("ref_x15_event_parameters", """
SELECT event_id, e.k AS key, CASE WHEN e.k IN ('gclid', 'transaction_id') THEN md5('key:' || coalesce(e.v, '')) WHEN e.k = 'term' THEN CASE WHEN e.v IS NULL THEN NULL ELSE '(redacted)' END ELSE regexp_replace(e.v, '/doctor/[a-zA-Z0-9_-]+', '/doctor/redacted', 'g') END AS value
FROM (SELECT event_id, unnest([{'k': 'gclid', 'v': event_type}, {'k': 'term', 'v': props}, {'k': 'page', 'v': '/doctor/' || event_type}]) AS e FROM events)""")
def event_parameters(spark, d):
    one = lambda k, v: F.struct(F.lit(k).alias("key"), F.struct(v.alias("string_value"), F.lit(None).cast("long").alias("int_value")).alias("value"))
    events = table(spark, d, "events").select("event_id", F.array(one("gclid", F.col("event_type")), one("term", F.col("props")), one("page", F.concat(F.lit("/doctor/"), "event_type"))).alias("event_params"))
    return masking.mask_events(events, keyed="key:").select("event_id", F.explode("event_params").alias("p")).select("event_id", "p.key", F.col("p.value.string_value").alias("value"))


@query("ref_x13_redacted_places", "SELECT c_custkey, CASE WHEN n_name IS NULL THEN NULL ELSE '(redacted)' END AS city, r_name AS country FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def redacted_places(spark, d):
    geo = F.struct(F.col("n_name").alias("city"), F.col("r_name").alias("country")).alias("geo")
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left").select("c_custkey", geo)
    return masking.mask_events(rows).select("c_custkey", "geo.city", "geo.country")


@query("ref_x17_human_bytes", """
SELECT file_id, CASE WHEN size_bytes < 1024 THEN printf('%.1f B', size_bytes / 1.0) WHEN size_bytes < 1048576 THEN printf('%.1f KB', size_bytes / 1024.0) ELSE printf('%.1f MB', size_bytes / 1048576.0) END AS size FROM landed_files""")
def human_bytes(spark, d):
    return table(spark, d, "landed_files").select("file_id", text.human_bytes(F.col("size_bytes").cast("double")).alias("size"))


@query("ref_x20_split_names", rf"""
SELECT rec_id, regexp_split_to_array(trim(name), '\s+')[1] AS first, coalesce(regexp_replace(regexp_extract(trim(name), '^\S+\s+(.*)$', 1), '^$', ''), '') AS last FROM {ALL_PEOPLE} WHERE name <> ''""")
def split_names(spark, d):
    first, last = text.first_last(F.col("name"))
    return people(spark, d).where("name <> ''").select("rec_id", first.alias("first"), last.alias("last"))


@query("ref_x22_split_addresses", f"SELECT rec_id, regexp_replace(email, '@[^@]*$', '') AS local, regexp_extract(email, '@([^@]*)$', 1) AS domain FROM {ALL_PEOPLE} WHERE contains(email, '@')")
def split_addresses(spark, d):
    e = F.col("email")
    return people(spark, d).where(F.contains("email", F.lit("@"))).select("rec_id", hashing.local_part(e).alias("local"), hashing.domain_part(e).alias("domain"))


@query("ref_x23_company_domains", f"""
SELECT DISTINCT d AS domain, 'fakecompany.' || array_to_string(string_split(d, '.')[2:], '.') AS masked, CASE WHEN length(split_part(d, '.', 1)) >= 6 THEN split_part(d, '.', 1) END AS company
FROM (SELECT lower(regexp_extract(email, '@([^@]*)$', 1)) AS d FROM {ALL_PEOPLE} WHERE contains(email, '@')) WHERE len(string_split(d, '.')) BETWEEN 2 AND 3 AND length(split_part(d, '.', 1)) >= 3 AND d NOT IN ('gmail.com', 'example.com', 'example.org')""")
def company_domains(spark, d):
    return identity.discovered_domains(people(spark, d).select(hashing.domain_part(F.col("email")).alias("domain")))


@query("ref_x19_day_arithmetic", "SELECT o_orderkey, strftime(o_orderdate - INTERVAL 3 DAY, '%Y%m%d') AS day FROM orders")
def day_arithmetic(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.day_key(F.to_date("o_orderdate"), 3).alias("day"))


@query("ref_x31_durations", "SELECT event_id, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%.1f min', s / 60.0) ELSE printf('%.1f hrs', s / 3600.0) END AS took FROM (SELECT event_id, (event_id % 30) * 360.0::DOUBLE AS s FROM events)")
def durations(spark, d):
    return table(spark, d, "events").select("event_id", text.duration(((F.col("event_id") % 30) * 360).cast("double")).alias("took"))


# masking and state


@query("ref_m5_masked_tickets", f"""
SELECT load_id, CASE WHEN assignee = '' THEN assignee ELSE 'User ' || {_hash_sql(hashing.JIRA_SALT, 'assignee', 8)} END AS assignee, CASE WHEN summary = '' THEN summary ELSE {_hash_sql(hashing.JIRA_SALT, 'summary', 24)} END AS summary,
  len(comments)::INTEGER AS n, [CASE WHEN x.author = '' THEN x.author ELSE 'User ' || {_hash_sql(hashing.JIRA_SALT, 'x.author', 8)} END FOR x IN comments] AS authors FROM tickets""")
def masked_tickets(spark, d):
    rows = table(spark, d, "tickets").select("load_id", "assignee", "summary", "comments")
    rules = {k: r for k, r in masking.ticket_rules("acme.test").items() if k.split(".")[0] in rows.columns}
    return masking.mask_columns(rows, rules).select("load_id", "assignee", "summary", F.size("comments").alias("n"), F.col("comments.author").alias("authors"))


@query("ref_m9_masked_events", """
SELECT event_id, md5('key:' || event_type) AS user_pseudo_id, CASE WHEN props IS NULL THEN NULL ELSE md5('key:' || props) END AS user_id, regexp_replace('/consult/' || event_type, '/consult/[^/?#]+', '/consult/redacted', 'g') AS url FROM events""")
def masked_events(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("event_type").alias("user_pseudo_id"), F.col("props").alias("user_id"), F.concat(F.lit("/consult/"), "event_type").alias("url"))
    return masking.mask_events(rows, keyed="key:")


@query("ref_g1_latest_checkpoints", f"""
SELECT job_id, status FROM (SELECT job_id, status, row_number() OVER (PARTITION BY job_id ORDER BY saved DESC NULLS LAST, save_id DESC) AS r FROM (SELECT job_id, status, save_id, __TIME__ AS saved FROM checkpoints)) WHERE r = 1""".replace("__TIME__", time_sql("updated_at")))
def latest_checkpoints(spark, d):
    return resume.latest_checkpoints(table(spark, d, "checkpoints")).select("job_id", "status")


@query("ref_p4_latest_tickets", f"WITH {LATEST} SELECT key, load_id FROM latest")
def latest_tickets(spark, d):
    rows = table(spark, d, "tickets").select(normal_key(F.col("key")).alias("key"), flexible_time(F.col("updated")).alias("u"), "load_id").where("key is not null")
    return rows.groupBy("key").agg(latest_by([F.col("u"), F.col("load_id")]).alias("r")).select("key", F.col("r.o1").alias("load_id"))


@query("ref_stream_windowed_counts", "SELECT date_trunc('hour', ts::TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    return resume.windowed_counts(table(spark, d, "events"), "ts", "event_type").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
