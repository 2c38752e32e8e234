"""Queries of sources, sinks, projections, recognisers and maskers over the exported tables, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.functions import hashing, recognizers, rewriting, text
from fathomgrid.operators import catalog, documents, identity, maskers, masking, projections, sampling, shaping, stats, validation
from fathomgrid.plans.corpus_sql import time_sql
from fathomgrid.plans.reference import ALL_PEOPLE, TEXTS, _entries, people, query, texts
from fathomgrid.sources import directories, landed, services, sinks
from fathomgrid.sources.tables import spark_type, table
from fathomgrid.streaming import resume
from fathomgrid.streaming.checkpoint import Checkpoint, Statistics


def _local(spark, name: str) -> str:
    """A fresh folder that the tasks reach through Arrow's file systems."""
    return storage.scratch(spark, name)


def _nations(spark, d):
    return table(spark, d, "nation").select(F.concat(F.lit("n/"), F.col("n_nationkey").cast("string"), F.lit(".json")).alias("key"), "n_nationkey", "n_name", "n_regionkey")


# sources and sinks


@query("ref_s1_list_keys", "SELECT 'n/' || n_nationkey || '.txt' AS key, length(n_name)::BIGINT AS length FROM nation")
def list_keys(spark, d):
    folder = _local(spark, "files")
    sinks.write_files(table(spark, d, "nation").select(F.concat(F.lit("n/"), F.col("n_nationkey").cast("string"), F.lit(".txt")).alias("key"), F.col("n_name").alias("content")), folder)
    return landed.list_keys(spark, folder)


@query("ref_s4_json_documents", "SELECT n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def json_documents(spark, d):
    folder = _local(spark, "documents")
    rows = _nations(spark, d)
    sinks.write_documents(rows.drop("key"), F.concat(F.lit("n/"), F.col("n_nationkey").cast("string"), F.lit(".json")), folder)
    return landed.read_documents(spark, f"{folder}/n", "n_nationkey int, n_name string, n_regionkey long").drop("path")


@query("ref_k1_pretty_documents", "SELECT 'n/' || n_nationkey || '.json' AS key, true AS indented FROM nation")
def pretty_documents(spark, d):
    folder = _local(spark, "pretty")
    sinks.write_documents(_nations(spark, d).drop("key"), F.concat(F.lit("n/"), F.col("n_nationkey").cast("string"), F.lit(".json")), folder)
    found = landed.read_bytes(spark, folder)
    return found.select(F.concat_ws("/", F.lit("n"), F.substring_index("path", "/", -1)).alias("key"), F.contains(F.col("content").cast("string"), F.lit("\n")).alias("indented"))


@query("ref_s5_bytes", "SELECT s_suppkey || '.bin' AS name, octet_length(encode(s_name))::BIGINT AS length, md5(s_name) AS digest FROM supplier")
def read_bytes(spark, d):
    folder = _local(spark, "bytes")
    sinks.write_files(table(spark, d, "supplier").select(F.concat(F.col("s_suppkey").cast("string"), F.lit(".bin")).alias("key"), F.col("s_name").alias("content")), folder)
    return landed.read_bytes(spark, folder).select(F.substring_index("path", "/", -1).alias("name"), "length", F.md5("content").alias("digest"))


@query("ref_k2_written_files", "SELECT count(*) AS written, sum(length(r_name))::BIGINT AS bytes FROM region")
def written_files(spark, d):
    folder = _local(spark, "written")
    n = sinks.write_files(table(spark, d, "region").select(F.col("r_name").alias("key"), F.col("r_name").alias("content")), folder)
    return landed.read_bytes(spark, folder).agg(F.sum("length").alias("bytes")).select(F.lit(n).cast("long").alias("written"), "bytes")


@query("ref_s6_exists", "SELECT 'n/' || n || '.txt' AS key, n IN (SELECT n_nationkey FROM nation) AS exists FROM unnest(range(40)) t(n)")
def existing_keys(spark, d):
    folder = _local(spark, "some")
    name = lambda c: F.concat(F.lit("n/"), F.col(c).cast("string"), F.lit(".txt")).alias("key")
    sinks.write_files(table(spark, d, "nation").select(name("n_nationkey"), F.col("n_name").alias("content")), folder)
    return landed.existing(spark.range(40).select(name("id")), landed.list_keys(spark, folder))


@query("ref_s7_csv_column", f"SELECT trim(email) AS email FROM {ALL_PEOPLE} WHERE regexp_matches(email, '[a-zA-Z0-9]')")
def csv_column(spark, d):
    folder = _local(spark, "csv")
    people(spark, d).select("rec_id", "email", "name").write.option("header", "true").csv(folder)
    return landed.read_csv_column(spark, folder, "email")


@query("ref_s9_parquet", "SELECT r_regionkey, r_name FROM region")
def parquet(spark, d):
    return table(spark, d, "region").select("r_regionkey", "r_name")


@query("ref_s16_day_tables", """
SELECT w.day AS day, CASE WHEN n IS NULL THEN 'missing' ELSE 'ok' END AS status, coalesce(n, 0) AS n FROM (SELECT strftime(x, '%Y%m%d') AS day FROM unnest(generate_series((SELECT max(o_orderdate)::DATE FROM orders) - 9, (SELECT max(o_orderdate)::DATE FROM orders) + 4, INTERVAL 1 DAY)) t(x)) w
LEFT JOIN (SELECT strftime(o_orderdate, '%Y%m%d') AS day, count(*) AS n FROM orders GROUP BY 1) o USING (day)""")
def day_tables(spark, d):
    """Rows of day tables and the days that have none. The tables of the last days are written first."""
    orders = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("at"))
    last = orders.agg(F.max("at")).first()[0]
    wanted = [r.day for r in landed.days(spark, f"{last:%Y-%m-%d}", 14).select(F.date_format(F.date_add(F.to_date("day", "yyyyMMdd"), 4), "yyyyMMdd").alias("day")).collect()]
    folder = _local(spark, "days")
    orders.withColumn("day", F.date_format("at", "yyyyMMdd")).where(F.col("day").isin(*wanted)).drop("at").write.partitionBy("day").parquet(folder)
    tables, status = landed.day_tables(spark, folder, wanted)
    counts = tables.groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return status.join(counts, "day", "left").select("day", "status", F.coalesce("n", F.lit(0)).alias("n"))


@query("ref_a10_day_stats", "SELECT count(*) AS days_exported, sum(n)::BIGINT AS total_rows, sum(b)::BIGINT AS total_bytes FROM (SELECT o_orderdate::DATE AS day, count(*) AS n, sum(length(o_orderpriority)) AS b FROM orders GROUP BY 1)")
def day_stats(spark, d):
    return stats.day_stats(table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("o_orderpriority")).alias("bytes")))


@query("ref_s17_user_directories", """
SELECT coalesce(email, '') AS email, coalesce(name, '') AS name, coalesce(github_login, '') AS id, 'github' AS source FROM people_github WHERE github_login <> ''
UNION ALL SELECT coalesce(email, ''), coalesce(jira_display_name, ''), coalesce(jira_account_id, ''), 'jira' FROM people_jira WHERE jira_account_id <> '' AND rec_id % 7 <> 0
UNION ALL SELECT coalesce(email, ''), coalesce(name, ''), coalesce(slack_user_id, ''), 'slack' FROM people_slack WHERE rec_id % 5 <> 0 AND rec_id % 11 <> 0 AND coalesce(slack_user_id, '') <> 'USLACKBOT'""")
def user_directories(spark, d):
    doc = lambda df, **f: df.select(F.to_json(F.struct(*[c.alias(n) for n, c in f.items()])).alias("content"))
    c = F.col
    raw = {
        "github": doc(table(spark, d, "people_github"), login=c("github_login"), name=c("name"), email=c("email")),
        "jira": doc(table(spark, d, "people_jira"), accountId=c("jira_account_id"), accountType=F.when(c("rec_id") % 7 == 0, "app").otherwise("atlassian"), displayName=c("jira_display_name"), emailAddress=c("email")),
        "slack": doc(table(spark, d, "people_slack"), id=F.coalesce("slack_user_id", F.lit("")), is_bot=c("rec_id") % 5 == 0, deleted=c("rec_id") % 11 == 0, profile=F.struct(c("email").alias("email"), c("name").alias("real_name"))),
    }
    return directories.all_users(raw).select("email", "name", F.greatest("github_login", "slack_user_id", "jira_account_id").alias("id"), F.col("sources")[0].alias("source"))


@query("ref_s18_package_entries", "SELECT doc_id, e.name AS name, e.size::BIGINT AS size FROM (SELECT doc_id, unnest([{'name': 'word/document.xml', 'size': octet_length(encode('<w:t>' || text || '</w:t>'))}, {'name': 'word/comments.xml', 'size': 5}]) AS e FROM documents WHERE text IS NOT NULL)")
def package_entries(spark, d):
    @F.pandas_udf("array<struct<name:string,size:long>>")
    def entries(texts):
        return texts.map(lambda t: [{"name": n, "size": s} for n, s in documents.package_entries(documents.package({"word/document.xml": f"<w:t>{t}</w:t>", "word/comments.xml": "<w:p>", "docProps/app.xml": ""}), "word/*")])

    return table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(entries("text")).alias("e")).select("doc_id", "e.*")


MAIL_SQL = "SELECT c_custkey, 'Order ' || c_custkey AS subject, 'c' || c_custkey || '@shop.test' AS sender, ['a@x.test', 'b' || c_custkey || '@y.test'] AS recipients, 'Dear ' || c_name AS body FROM customer"


def _mails(spark, d):
    c = storage.spread(table(spark, d, "customer"))
    k = F.col("c_custkey").cast("string")
    head = F.concat(F.lit("From: C <c"), k, F.lit("@shop.test>\r\nTo: A <a@x.test>, b"), k, F.lit("@y.test\r\nSubject: Order "), k, F.lit('\r\nX-Mailer: m 1.2\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary="=b"\r\n\r\n'))
    body = F.concat(F.lit("--=b\r\nContent-Type: text/plain\r\n\r\nDear "), "c_name", F.lit('\r\n--=b\r\nContent-Type: application/pdf; name="o.pdf"\r\nContent-Disposition: attachment; filename="o'), k, F.lit('.pdf"\r\n\r\nx\r\n--=b--\r\n'))
    return c.select("c_custkey", F.concat(head, body).alias("raw"))


@query("ref_s19_mail_parts", "SELECT c_custkey, subject, recipients, body, ['o' || c_custkey || '.pdf'] AS attachments FROM (" + MAIL_SQL + ")")
def mail_parts(spark, d):
    parts = _mails(spark, d).select("c_custkey", documents.mail_parts(F.encode("raw", "utf-8")).alias("m"))
    return parts.select("c_custkey", "m.subject", "m.recipients", F.trim(F.regexp_replace("m.text", r"\s+$", "")).alias("body"), "m.attachments")


@query("ref_p13_mail_entries", "SELECT 'm' || c_custkey AS id, 't' AS \"threadId\", ['INBOX'] AS \"labelIds\", '' AS snippet, c_custkey::BIGINT AS \"sizeEstimate\", ['o' || c_custkey || '.pdf'] AS attachments FROM customer")
def mail_entries(spark, d):
    """Index entries of raw mails as their service gives them, in base64."""
    raw = F.translate(F.base64(F.encode("raw", "utf-8")), "+/\r\n=", "-_")
    docs = _mails(spark, d).select(F.to_json(F.struct(F.concat(F.lit("m"), "c_custkey").alias("id"), F.lit("t").alias("threadId"), F.array(F.lit("INBOX")).alias("labelIds"), F.col("c_custkey").alias("sizeEstimate"), raw.alias("raw"))).alias("json"))
    return projections.parsed(docs, "json", projections.MAIL).select(*projections.mail_entry(F.col("doc"))).drop("internalDate")


@query("ref_t17_broken_mail", "SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0")
def broken_mail(spark, d):
    mails = _mails(spark, d).withColumn("raw", F.when(F.col("c_custkey") % 3 == 0, F.lit("\r\n\r\nno header")).otherwise(F.col("raw")))
    return validation.broken_mail(mails, "c_custkey", "raw")


@query("ref_x25_address_headers", "SELECT rec_id, 'User <' || substr(sha256('pii-store:' || rec_id || '@x.test'), 1, 8) || '@y.test>, ' || substr(sha256('pii-store:b@z.test'), 1, 8) || '@y.test' AS header FROM people_jira")
def address_headers(spark, d):
    import hashlib

    @F.pandas_udf("string")
    def masked(headers):
        address = lambda a: hashlib.sha256(f"pii-store:{a}".encode()).hexdigest()[:8] + "@y.test"
        return headers.map(lambda h: documents.mask_addresses(h, address, lambda n: "User"))

    header = F.concat(F.lit("Ann Vane <"), F.col("rec_id").cast("string"), F.lit("@x.test>, b@z.test"))
    return table(spark, d, "people_jira").select("rec_id", masked(header).alias("header"))


@query("ref_m10_masked_mail", "SELECT c_custkey, 'Order ' || c_custkey AS subject, ['u@z.test', 'u@z.test'] AS recipients, 'Dear C at new.test' AS body FROM customer")
def masked_mail(spark, d):
    """Mails with masked addresses, scanned bodies and swept domains, read again."""
    names = [("shop.test", "new.test")]

    @F.pandas_udf("binary")
    def masked(raws):
        return raws.map(lambda r: documents.mask_mail(r.encode().replace(b"Dear Customer", b"Dear C at shop.test Customer"), lambda t: t.split(" Customer")[0] if t.startswith("Dear") else t, lambda a: "u@z.test", lambda n: "", names))

    parts = _mails(spark, d).select("c_custkey", documents.mail_parts(masked("raw")).alias("m"))
    return parts.select("c_custkey", "m.subject", "m.recipients", F.regexp_replace("m.text", r"\s+$", "").alias("body"))


@query("ref_m11_masked_documents", "SELECT doc_id, length(text)::INTEGER AS n FROM documents WHERE text IS NOT NULL AND text <> ''")
def masked_documents(spark, d):
    """Office documents of the texts in two runs, in the body, a comment and a property, scanned by turning them round; all three agree afterwards."""
    from xml.sax.saxutils import escape

    @F.pandas_udf("int")
    def lengths(texts):
        def one(t: str) -> int:
            clean = "".join(c for c in t if c >= " ")
            half = len(clean) // 2
            runs = "<w:p>" + "".join(f"<w:r><w:t>{escape(x)}</w:t></w:r>" for x in (clean[:half], clean[half:])) + "</w:p>"
            raw = documents.package({"word/document.xml": runs, "word/comments.xml": runs, "docProps/core.xml": f"<dc:title>{escape(clean)}</dc:title>"})
            import io
            import re
            import zipfile
            from xml.sax.saxutils import unescape

            with zipfile.ZipFile(io.BytesIO(documents.mask_office(raw, lambda s: s[::-1]))) as z:
                found = [unescape("".join(re.findall(r">([^<]*)<", z.read(n).decode()))) for n in ("word/document.xml", "word/comments.xml", "docProps/core.xml")]
            return len(t) if all(f == clean[::-1] for f in found) or not clean else -1

        return texts.map(one)

    return table(spark, d, "documents").where("text is not null and text <> ''").select("doc_id", lengths("text").alias("n"))


@query("ref_x29_run_lengths", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN [o_orderstatus || 'a', 'bc'] ELSE [o_orderstatus || 'abcd', ''] END AS runs FROM orders")
def run_lengths(spark, d):
    @F.pandas_udf("array<string>")
    def runs(texts):
        return texts.map(lambda t: documents.spread(t, [2, 2]))

    return table(spark, d, "orders").select("o_orderkey", runs(F.concat("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, "abc").otherwise("abcd"))).alias("runs"))


@query("ref_f11_headers", "SELECT h AS header, CASE WHEN h IN ('From', 'Cc', 'Reply-To', 'Delivered-To') THEN 'address' WHEN h IN ('Date', 'X-Mailer', 'X-Priority', 'Message-ID', 'Received', 'DKIM-Signature', 'Content-Type') THEN 'skipped' ELSE 'scanned' END AS kind FROM unnest(['From', 'Cc', 'Reply-To', 'Delivered-To', 'Date', 'X-Mailer', 'X-Priority', 'Message-ID', 'Received', 'DKIM-Signature', 'Content-Type', 'Subject', 'X-Team', 'Organization']) t(h)")
def headers(spark, d):
    names = "From Cc Reply-To Delivered-To Date X-Mailer X-Priority Message-ID Received DKIM-Signature Content-Type Subject X-Team Organization".split()
    return spark.createDataFrame([(n,) for n in names], "header string").select("header", documents.header_kind(F.col("header")).alias("kind"))


@query("ref_s21_roster", f"SELECT 'user-' || rec_id AS id, coalesce(email, '') AS email, 'User ' || substr(sha256('pii-store:' || coalesce(name, '')), 1, 8) AS masked_name FROM {ALL_PEOPLE}")
def roster(spark, d):
    users = identity.numbered(people(spark, d).select("rec_id", "email", "name"), "rec_id").select(
        F.col("n").alias("number"), F.concat(F.lit("user-"), F.col("rec_id").cast("string")).alias("id"), F.create_map(F.lit("email"), F.coalesce("email", F.lit(""))).alias("real"),
        F.create_map(F.lit("name"), F.concat(F.lit("User "), hashing.salted(F.coalesce("name", F.lit("")), hashing.STORE_SALT, 8))).alias("masked"),
    )
    path = _local(spark, "roster")
    sinks.write_lines(sinks.roster_documents(users), path)
    docs = spark.read.schema("version int, domain_map map<string,string>, users array<struct<id:string,real:map<string,string>,masked:map<string,string>>>").json(path)
    return docs.select(F.explode("users").alias("u")).select("u.id", F.col("u.real")["email"].alias("email"), F.col("u.masked")["name"].alias("masked_name"))


@query("ref_k4_appended_lines", "SELECT load_id, key FROM tickets")
def appended_lines(spark, d):
    lines = sinks.Lines(spark, _local(spark, "appended"))
    rows = table(spark, d, "tickets").select("load_id", "key")
    for part in range(3):
        lines.append(rows.where(F.pmod("load_id", F.lit(3)) == part))
    return lines.read_all("load_id long, key string")


@query("ref_k7_copied_keys", """
SELECT 'r' || r_regionkey || e AS key, length(r_name)::BIGINT AS length, CASE e WHEN '.json' THEN 'application/json' WHEN '.eml' THEN 'message/rfc822' ELSE 'application/octet-stream' END AS content_type FROM region, (SELECT unnest(['.json', '.eml', '.dat']) AS e)""")
def copied_keys(spark, d):
    source, target = _local(spark, "from"), _local(spark, "to")
    rows = table(spark, d, "region").select("r_regionkey", "r_name", F.explode(F.array(*map(F.lit, (".json", ".eml", ".dat")))).alias("e")).select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string"), "e").alias("key"), F.col("r_name").alias("content"))
    sinks.write_files(rows, source)
    sinks.copy_keys(landed.list_keys(spark, source), source, target)
    return landed.list_keys(spark, target).select("key", "length", sinks.content_type(F.col("key")).alias("content_type"))


@query("ref_k8_manifest_document", "SELECT source AS masker, count(*) AS total, count(*) FILTER (content <> '') AS masked, 0::BIGINT AS skipped, count(*) FILTER (coalesce(content, '') = '') AS failed FROM landed_files GROUP BY ROLLUP (source)")
def manifest_document(spark, d):
    """The counts of a manifest, stored as one document and read again."""
    status = F.when(F.coalesce("content", F.lit("")) == "", "error").otherwise("ok")
    doc = sinks.manifest_document(stats.manifest(table(spark, d, "landed_files").select(F.col("source").alias("masker"), status.alias("status"))), F.lit("2026-03-01T00:00:00Z"))
    path = f"{_local(spark, 'manifest')}/manifest.json"
    sinks.write_document(doc, path)
    back = spark.createDataFrame([(storage.read_text(spark, path),)], "json string").select(F.from_json("json", doc.schema).alias("d"))
    each = back.select(F.explode("d.maskers").alias("masker", "c")).select("masker", "c.*")
    return each.unionByName(back.select(F.lit(None).cast("string").alias("masker"), "d.overall.*"))


@query("ref_k11_store_export", f"""
WITH e AS (SELECT DISTINCT email AS v FROM {ALL_PEOPLE} WHERE email <> '')
SELECT 'EMAIL_ADDRESS' AS section, v AS key, substr(sha256('pii-store:' || v), 1, 8) AS value FROM e UNION ALL SELECT 'domain_map', 'harborworks.example', 'acme.test' UNION ALL SELECT 'total', '', count(*)::VARCHAR FROM e""")
def store_export(spark, d):
    entries = people(spark, d).where("email <> ''").select(F.lit("EMAIL_ADDRESS").alias("entity_type"), F.col("email").alias("real_value"), hashing.salted(F.col("email"), hashing.STORE_SALT, 8).alias("masked_value")).distinct()
    return sinks.export_store(entries, spark.createDataFrame([("harborworks.example", "acme.test")], "real_domain string, masked_domain string"))


@query("ref_o9_export_order", f"SELECT row_number() OVER (ORDER BY v) AS place, v AS key FROM (SELECT DISTINCT email AS v FROM {ALL_PEOPLE} WHERE email <> '')")
def export_order(spark, d):
    """Places of the entries in the stored export, which is sorted by section and key."""
    path = _local(spark, "export")
    entries = people(spark, d).where("email <> ''").select(F.lit("EMAIL_ADDRESS").alias("entity_type"), F.col("email").alias("real_value"), F.lit("x").alias("masked_value")).distinct()
    sinks.write_lines(sinks.export_store(entries, spark.createDataFrame([], "real_domain string, masked_domain string")).coalesce(1), path)
    stored = spark.read.schema("section string, key string").json(path).withColumn("at", F.monotonically_increasing_id()).where("section = 'EMAIL_ADDRESS'")
    return stored.select((F.col("at") + 1).alias("place"), "key")


@query("ref_m14_routes", r"""
SELECT file_id, CASE WHEN regexp_extract(path, '[^/]*$') IN ('_stats.json', '_index.json') THEN 'copied' WHEN lower(path) LIKE '%.json' AND contains(path, '/messages/') THEN 'message' WHEN lower(path) LIKE '%.json' AND contains(path, '/tickets/') THEN 'ticket' WHEN lower(path) LIKE '%.json' THEN 'scanned' ELSE 'left out' END AS route FROM landed_files""")
def routes(spark, d):
    return table(spark, d, "landed_files").select("file_id", maskers.route(F.col("path")).alias("route"))


@query("ref_k12_copied_unchanged", r"SELECT file_id, content FROM landed_files WHERE regexp_extract(path, '[^/]*$') IN ('_stats.json', '_index.json')")
def copied_unchanged(spark, d):
    files = table(spark, d, "landed_files").where(maskers.route(F.col("path")) == "copied")
    path = _local(spark, "unchanged")
    sinks.write_parquet(files.select("file_id", "content"), path)
    return spark.read.parquet(path)


# projections


def _raw_tickets(spark, d):
    """Tickets as the raw documents their service gives, one JSON text each."""
    c, t = F.col, table(spark, d, "tickets")
    named = lambda x: F.struct(c(x).alias("name"))
    user = lambda r: F.struct(c(r).alias("displayName"), c(f"{r}_email").alias("emailAddress"), c(f"{r}_account_id").alias("accountId"))
    many = lambda x: F.transform(x, lambda v: F.struct(v.alias("name")))
    history = F.transform("changelog", lambda h: F.struct(h["date"].alias("created"), F.struct(h["author"].alias("displayName")).alias("author"), F.array(F.struct(h["field"].alias("field"), h["from"].alias("fromString"), h["to"].alias("toString"))).alias("items")))
    fields = F.struct(
        "summary", c("description_adf").alias("description"), named("issue_type").alias("issuetype"), F.struct(c("status").alias("name"), named("status_category").alias("statusCategory")).alias("status"), named("priority").alias("priority"), named("resolution").alias("resolution"), F.struct(c("project_key").alias("key"), c("project_name").alias("name")).alias("project"),
        "created", "updated", c("resolved").alias("resolutiondate"), c("due_date").alias("duedate"), *[user(r).alias(r) for r in ("assignee", "reporter", "creator")], "labels", many("components").alias("components"), many("fix_versions").alias("fixVersions"), many("affected_versions").alias("versions"), named("sprint").alias("sprint"),
        F.when(c("parent_key").isNotNull(), F.struct(c("parent_key").alias("key"), F.struct(c("parent_summary").alias("summary")).alias("fields"))).alias("parent"), c("original_estimate").alias("timeoriginalestimate"), c("remaining_estimate").alias("timeestimate"), c("time_spent").alias("timespent"), F.struct("votes").alias("votes"), F.struct(c("watchers").alias("watchCount")).alias("watches"),
        F.transform("attachments", lambda a: F.struct(a["id"].alias("id"), a["filename"].alias("filename"), a["size"].alias("size"), a["mime_type"].alias("mimeType"), a["created"].alias("created"), F.struct(a["author"].alias("displayName"), a["author_email"].alias("emailAddress")).alias("author"), a["content_url"].alias("content"))).alias("attachment"),
    )
    return t.select("load_id", F.to_json(F.struct("key", "id", "self", F.struct(history.alias("histories")).alias("changelog"), fields.alias("fields"))).alias("json"))


TICKET_COLUMNS = "key id self summary description_adf issue_type status status_category priority resolution project_key project_name created updated resolved due_date assignee assignee_email assignee_account_id reporter reporter_email reporter_account_id creator creator_email creator_account_id sprint parent_key parent_summary".split()


@query("ref_p5_ticket_projection", f"""
SELECT load_id, {", ".join(TICKET_COLUMNS)}, coalesce(array_to_string(labels, '|'), '') AS labels, coalesce(array_to_string(components, '|'), '') AS components, coalesce(array_to_string(fix_versions, '|'), '') AS fix_versions, coalesce(array_to_string(affected_versions, '|'), '') AS affected_versions,
  coalesce(original_estimate, '') AS original_estimate, coalesce(remaining_estimate, '') AS remaining_estimate, coalesce(time_spent, '') AS time_spent, coalesce(votes, 0) AS votes, coalesce(watchers, 0) AS watchers FROM tickets""")
def ticket_projection(spark, d):
    flat = projections.parsed(_raw_tickets(spark, d), "json", projections.TICKET).select("load_id", *projections.ticket(F.col("doc"))).drop("attachments", "changelog")
    return flat.withColumns({n: F.array_join(n, "|") for n in ("labels", "components", "fix_versions", "affected_versions")})


@query("ref_p5_ticket_attachments", "SELECT load_id, (i - 1)::INTEGER AS pos, a.id AS id, a.filename AS filename, a.size AS size, a.mime_type AS mime_type, a.author AS author, a.content_url AS content_url FROM (SELECT load_id, unnest(attachments) AS a, generate_subscripts(attachments, 1) AS i FROM tickets)")
def ticket_attachments(spark, d):
    flat = projections.parsed(_raw_tickets(spark, d), "json", projections.TICKET).select("load_id", *projections.ticket(F.col("doc")))
    return flat.select("load_id", F.posexplode("attachments").alias("pos", "a")).select("load_id", "pos", "a.id", "a.filename", "a.size", "a.mime_type", "a.author", "a.content_url")


@query("ref_p8_changelog_projection", """
SELECT load_id, c.date AS date, c.author AS author, c.field AS field, c."from" AS old, c."to" AS new FROM (SELECT load_id, unnest(changelog) AS c FROM tickets)""")
def changelog_projection(spark, d):
    flat = projections.parsed(_raw_tickets(spark, d), "json", projections.TICKET).select("load_id", *projections.ticket(F.col("doc")))
    return flat.select("load_id", F.explode("changelog").alias("c")).select("load_id", "c.date", "c.author", "c.field", F.col("c.from").alias("old"), F.col("c.to").alias("new"))


@query("ref_p6_persons", "SELECT load_id, coalesce(assignee, '') AS name, coalesce(assignee_email, '') AS email, coalesce(assignee_account_id, '') AS account_id FROM tickets")
def persons(spark, d):
    docs = projections.parsed(_raw_tickets(spark, d), "json", projections.TICKET)
    return docs.select("load_id", shaping.person(F.col("doc")["fields"]["assignee"]).alias("p")).select("load_id", "p.*")


@query("ref_p1_repository", """
WITH l AS (SELECT n_nationkey, l_returnflag, sum(l_quantity)::BIGINT AS bytes FROM nation JOIN supplier ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT n_name AS full_name, n_regionkey::BIGINT AS stargazers_count, n_nationkey % 2 = 0 AS private, l_returnflag AS language, bytes, round(bytes::DOUBLE / sum(bytes) OVER (PARTITION BY n_nationkey) * 100, 2) AS percentage FROM l JOIN nation USING (n_nationkey)""")
def repository(spark, d):
    lines = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("n_nationkey"), "l_returnflag").agg(F.sum("l_quantity").cast("long").alias("b"))
    maps = lines.groupBy("n_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "b"))).alias("languages"))
    raw = table(spark, d, "nation").join(maps, "n_nationkey").select(F.to_json(F.struct(F.col("n_name").alias("full_name"), (F.col("n_nationkey") % 2 == 0).alias("private"), F.col("n_regionkey").alias("stargazers_count"), "languages")).alias("json"))
    flat = projections.parsed(raw, "json", projections.REPOSITORY).select(*projections.repository(F.col("doc")))
    return flat.select("full_name", "private", "stargazers_count", F.explode("language_breakdown").alias("language", "i")).select("full_name", "stargazers_count", "private", "language", "i.bytes", "i.percentage")


def _raw_contributors(spark, d):
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    doc = F.struct(F.concat(F.lit("dev"), "o_custkey").alias("login"), F.col("o_custkey").alias("id"), F.lit("User").alias("type"), F.col("n").alias("contributions"), F.concat(F.lit("https://github.com/dev"), "o_custkey").alias("html_url"))
    return counts.select(F.to_json(doc).alias("json"))


CONTRIBUTORS_SQL = "SELECT 'dev' || o_custkey AS login, o_custkey::BIGINT AS id, 'User' AS type, count(*) AS contributions, 'https://github.com/dev' || o_custkey AS profile_url FROM orders GROUP BY o_custkey"


@query("ref_p2_contributors", CONTRIBUTORS_SQL)
def contributors(spark, d):
    return projections.parsed(_raw_contributors(spark, d), "json", projections.CONTRIBUTOR).select(*projections.contributor(F.col("doc")))


@query("ref_o1_ordered_contributors", f"SELECT row_number() OVER (ORDER BY contributions DESC, login) AS place, login FROM ({CONTRIBUTORS_SQL})")
def ordered_contributors(spark, d):
    """Places of the contributors in the list by falling contributions."""
    listed = projections.top_contributors(contributors(spark, d)).select("login", "contributions")
    path = _local(spark, "contributors")
    listed.coalesce(1).write.parquet(path)
    return spark.read.parquet(path).select((F.monotonically_increasing_id() + 1).alias("place"), "login")


COMMITS_SQL = "SELECT l_orderkey || '-' || l_linenumber AS sha, 'Ship ' || l_returnflag AS message, 'S' || l_suppkey AS author_name, 's' || l_suppkey || '@x.test' AS author_email, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'l' || l_suppkey END AS author_login, l_returnflag AS committer_name, [(l_orderkey - 1)::VARCHAR] AS parents, l_partkey::BIGINT AS additions FROM lineitem"


def _raw_commits(spark, d):
    s = lambda *c: F.concat(*[F.lit(x) if x[0] == "'" or len(x) < 3 else F.col(x).cast("string") for x in c])
    author = F.struct(s("S", "l_suppkey").alias("name"), F.concat(s("s", "l_suppkey"), F.lit("@x.test")).alias("email"))
    user = F.when(F.col("l_suppkey") % 3 != 0, F.struct(s("l", "l_suppkey").alias("login"))).alias("author")
    doc = F.struct(
        s("l_orderkey", "-", "l_linenumber").alias("sha"), F.struct(F.concat(F.lit("Ship "), "l_returnflag").alias("message"), author.alias("author"), F.struct(F.col("l_returnflag").alias("name")).alias("committer")).alias("commit"), user,
        F.array(F.struct((F.col("l_orderkey") - 1).cast("string").alias("sha"))).alias("parents"), F.struct(F.col("l_partkey").alias("additions")).alias("stats"),
    )
    return projections.parsed(table(spark, d, "lineitem").select(F.to_json(doc).alias("json")), "json", projections.COMMIT)


@query("ref_p3_commits", COMMITS_SQL)
def commits(spark, d):
    flat = _raw_commits(spark, d).select(shaping.commit(F.col("doc")).alias("c"), F.col("doc.stats.additions").alias("additions"))
    return flat.select("c.sha", "c.message", "c.author_name", "c.author_email", "c.author_login", "c.committer_name", "c.parents", "additions")


@query("ref_m2_masked_commits", f"""
SELECT sha, message, CASE WHEN author_name = '' THEN '' ELSE 'User ' || substr(sha256('pii-store:' || author_name), 1, 8) END AS author_name, substr(sha256('pii-store:' || split_part(author_email, '@', 1)), 1, 8) || '@masked.test' AS author_email,
  'user-' || substr(sha256('pii-store:' || author_login), 1, 10) AS author_login, 'User ' || substr(sha256('pii-store:' || committer_name), 1, 8) AS committer_name FROM ({COMMITS_SQL})""")
def masked_commits(spark, d):
    return maskers.scan_items(commits(spark, d).drop("parents", "additions"), "commit", maskers.Scanner((("x.test", "masked.test"),)))


@query("ref_m3_masked_contributors", f"SELECT 'user-' || substr(sha256('pii-store:' || login), 1, 10) AS login, 0::BIGINT AS id, type, contributions, replace(profile_url, 'github.com', 'code.test') AS profile_url FROM ({CONTRIBUTORS_SQL})")
def masked_contributors(spark, d):
    return maskers.scan_items(contributors(spark, d), "contributor", maskers.Scanner((("github.com", "code.test"),)))


def _raw_pages(spark, d):
    c = F.col
    body = F.struct(F.when(c("doc_id") % 3 == 0, F.struct(c("text").alias("value"))).alias("storage"), F.when(c("doc_id") % 3 == 1, F.struct(F.lit("adf").alias("value"))).alias("atlas_doc_format"), F.struct(F.lit("seen").alias("value")).alias("view"))
    doc = F.struct(c("doc_id").cast("string").alias("id"), c("lang").alias("title"), c("source").alias("spaceId"), F.lit("current").alias("status"), F.concat(F.lit("a"), c("n_chars").cast("string")).alias("authorId"), c("n_chars").alias("position"), F.struct(c("n_chars").alias("number")).alias("version"), body.alias("body"))
    return projections.parsed(table(spark, d, "documents").select(F.to_json(doc).alias("json")), "json", projections.PAGE)


PAGES_SQL = "SELECT doc_id::VARCHAR AS id, lang AS title, source AS space_id, 'current' AS status, 'a' || n_chars AS author_id, n_chars::BIGINT AS version, CASE WHEN doc_id % 3 = 0 AND text IS NOT NULL THEN text WHEN doc_id % 3 = 1 THEN 'adf' ELSE 'seen' END AS body, 'SPACE' AS space_key FROM documents"


@query("ref_p12_pages", PAGES_SQL)
def pages(spark, d):
    return _raw_pages(spark, d).select(*projections.page(F.col("doc"), F.lit("SPACE"), F.lit("storage"))).select("id", "title", "space_id", "status", "author_id", "version", "body", "space_key")


@query("ref_p14_drive_entries", "SELECT file_id::VARCHAR AS id, path AS name, size_bytes::VARCHAR AS size, source = 'jira' AS downloaded, CASE WHEN source = 'jira' THEN NULL ELSE 'skipped type' END AS skip_reason, [target] AS owners FROM landed_files")
def drive_entries(spark, d):
    c = F.col
    doc = F.struct(c("file_id").cast("string").alias("id"), c("path").alias("name"), c("size_bytes").cast("string").alias("size"), F.array(F.struct(c("target").alias("displayName"))).alias("owners"))
    raw = projections.parsed(table(spark, d, "landed_files").select("source", F.to_json(doc).alias("json")), "json", projections.DRIVE)
    entries = raw.select(*projections.drive_entry(c("doc"), c("source") == "jira", F.when(c("source") != "jira", "skipped type")))
    return entries.select("id", "name", "size", "downloaded", "skip_reason", F.transform("owners", lambda o: o["displayName"]).alias("owners"))


@query("ref_p7_named_fields", """
SELECT load_id, 'Custom field (' || k || ')' AS field, v AS value FROM (SELECT load_id, unnest(map_entries(custom_fields)) AS e FROM tickets), LATERAL (SELECT e.key AS k, CASE WHEN e.value IS NULL OR e.value = '' THEN 'none' ELSE 'v' || length(e.value) END AS v)""")
def named_fields(spark, d):
    """Custom fields by id as objects, shown under the names of a table of fields."""
    value = lambda v: F.to_json(F.struct(F.when(F.coalesce(v, F.lit("")) == "", "none").otherwise(F.concat(F.lit("v"), F.length(v).cast("string"))).alias("value")))
    t = table(spark, d, "tickets").select("load_id", F.map_from_entries(F.transform(F.map_entries("custom_fields"), lambda e: F.struct(F.concat(F.lit("customfield_"), F.md5(e["key"])), value(e["value"])))).alias("fields"))
    names = shaping.custom_fields(table(spark, d, "tickets"), "load_id", "custom_fields").select(F.concat(F.lit("customfield_"), F.md5("field")).alias("id"), F.col("field").alias("name")).distinct()
    return shaping.custom_fields(shaping.named_fields(t, "load_id", "fields", names), "load_id", "custom_fields")


@query("ref_p11_local_files", """
SELECT ts, f.id AS id, CASE WHEN f.mime_type LIKE 'image/%' THEN NULL ELSE 'attachments/' || f.id END AS local_file FROM (SELECT load_id::VARCHAR AS ts, unnest(attachments) AS f FROM tickets) WHERE f.id IS NOT NULL""")
def local_files(spark, d):
    m = table(spark, d, "tickets").select(F.col("load_id").cast("string").alias("ts"), F.filter("attachments", lambda a: a["id"].isNotNull()).alias("files"))
    got = m.select("ts", F.explode("files").alias("f")).where("coalesce(f.mime_type, '') not like 'image/%'").select("ts", F.col("f.id").alias("file_id"), F.concat(F.lit("attachments/"), "f.id").alias("local_file")).distinct()
    return shaping.with_local_files(m, got).select("ts", F.explode("files").alias("f")).select("ts", "f.id", F.col("f._local_file").alias("local_file"))


WORDS_SQL = "SELECT l_orderkey AS image, 1 AS block_num, 1 AS par_num, (l_linenumber % 2)::INTEGER AS line_num, l_linenumber::INTEGER AS \"left\", l_returnflag || l_linenumber AS text, (l_quantity - 5)::INTEGER AS conf, 10 AS top, l_linenumber::INTEGER + 20 AS width, 13 AS height FROM lineitem"


def _words(spark, d):
    c, n = F.col, F.col("l_linenumber").cast("int")
    return table(spark, d, "lineitem").select(
        c("l_orderkey").alias("image"), F.lit(1).alias("block_num"), F.lit(1).alias("par_num"), (n % 2).alias("line_num"), n.alias("left"), F.concat("l_returnflag", n.cast("string")).alias("text"), (c("l_quantity") - 5).cast("int").alias("conf"), F.lit(10).alias("top"), (n + 20).alias("width"), F.lit(13).alias("height")
    )


@query("ref_p21_lines_of_words", f"SELECT image, block_num, par_num, line_num, string_agg(text, ' ' ORDER BY \"left\", text) AS text FROM ({WORDS_SQL}) WHERE conf >= 0 GROUP BY ALL")
def lines_of_words(spark, d):
    return shaping.lines_of_words(_words(spark, d))


@query("ref_t19_changed_boxes", f"SELECT image, line_num, text, greatest(\"left\" - 3, 0) AS x0, 7 AS y0, \"left\" + width + 3 AS x1, 26 AS y1 FROM ({WORDS_SQL}) WHERE conf >= 0 AND text LIKE 'A%'")
def changed_boxes(spark, d):
    lines = shaping.lines_of_words(_words(spark, d)).withColumn("masked", F.replace("text", F.lit("A"), F.lit("_")))
    return shaping.changed_boxes(_words(spark, d), lines).select("image", "line_num", "text", *[F.col(c).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("ref_p18_mail_keys", f"""
SELECT rec_id, CASE WHEN contains(email, '@') THEN 'google/' || substr(sha256('pii-store:' || regexp_replace(email, '@[^@]*$', '')), 1, 8) || '_at_' || CASE WHEN lower(regexp_extract(email, '@([^@]*)$', 1)) = 'harborworks.example' THEN 'acme.test' ELSE regexp_extract(email, '@([^@]*)$', 1) END || '/gmail/1.eml' ELSE 'google/' || coalesce(email, '') || '/gmail/1.eml' END AS key
FROM {ALL_PEOPLE} WHERE NOT contains(coalesce(email, ''), '/')""")
def mail_keys(spark, d):
    scanner = maskers.Scanner((("harborworks.example", "acme.test"),))
    key = F.concat(F.lit("google/"), text.slug(F.coalesce("email", F.lit(""))), F.lit("/gmail/1.eml"))
    return people(spark, d).where("not contains(coalesce(email, ''), '/')").select("rec_id", text.mail_key(key, scanner.email, []).alias("key"))


@query("ref_p22_nested_documents", "SELECT project_key AS target, count(*) AS total, count(*) FILTER (status = 'Done') AS done FROM tickets GROUP BY 1")
def nested_documents(spark, d):
    """Statistics as nested documents, read again by their dotted paths."""
    per = table(spark, d, "tickets").groupBy(F.col("project_key").alias("target")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "Done").alias("m"))
    docs = per.select("target", stats.nested(tickets__total=F.col("n"), tickets__by__done=F.col("m")).alias("stats"))
    return docs.select("target", F.col("stats.tickets.total").alias("total"), F.col("stats.tickets.by.done").alias("done"))


def _ticket_documents(spark, d):
    t = table(spark, d, "tickets").withColumnRenamed("project_key", "target")
    totals = stats.ticket_stats(t, "target")
    maps = reduce(lambda a, b: a.join(b, "target"), [stats.count_map(t, F.col(c), ["target"], o) for c, o in (("issue_type", "by_type"), ("status", "by_status"), ("status_category", "by_status_category"), ("priority", "by_priority"))])
    return totals.join(maps, "target").select(
        "target", F.lit("2026-03-01").alias("exported_at"), stats.nested(total=F.col("total_tickets"), by_type=F.col("by_type"), by_status=F.col("by_status"), by_status_category=F.col("by_status_category"), by_priority=F.col("by_priority")).alias("tickets"),
        stats.nested(total=F.col("total_comments"), tickets_with_comments=F.col("tickets_with_comments")).alias("comments"), stats.nested(total=F.col("total_attachments"), total_size_bytes=F.col("total_attachment_size_bytes")).alias("attachments"), stats.nested(total=F.col("total_changelog_entries")).alias("changelog"),
    )


CATALOG_SQL = """
SELECT project_key AS target, '2026-03-01' AS exported_at, count(*) AS total_tickets, sum(coalesce(len([1 FOR x IN comments IF x IS NOT NULL]), 0))::BIGINT AS total_comments, sum(coalesce(len([1 FOR x IN changelog IF x IS NOT NULL]), 0))::BIGINT AS total_changelog_entries,
  count(*) FILTER (coalesce(issue_type, '') = 'Bug')::INTEGER AS bugs, count(*) FILTER (coalesce(priority, '') = '')::INTEGER AS unknown_priority FROM tickets GROUP BY 1"""


def _catalog_row(t):
    return t.select("target", "exported_at", "total_tickets", "total_comments", "total_changelog_entries", F.coalesce(F.col("by_type")["Bug"], F.lit(0)).alias("bugs"), F.coalesce(F.col("by_priority")["Unknown"], F.lit(0)).alias("unknown_priority"))


@query("ref_p16_jira_catalog", CATALOG_SQL)
def jira_catalog(spark, d):
    return _catalog_row(catalog.table(_ticket_documents(spark, d), "jira_projects"))


@query("ref_s10_catalog_lines", CATALOG_SQL)
def catalog_lines(spark, d):
    made = catalog.table(_ticket_documents(spark, d), "jira_projects")
    path = _local(spark, "catalog")
    sinks.write_lines(made, path)
    return _catalog_row(landed.read_catalog(spark, path, made.schema))


@query("ref_p16_slack_catalog", """
WITH m AS (SELECT target, json_array_length(content, '$.reactions') > 0 AS reacted FROM landed_files WHERE source = 'slack' AND contains(path, '/messages/') AND NOT contains(path, '/_') AND CASE WHEN json_valid(content) THEN json_type(content) = 'OBJECT' ELSE false END AND coalesce(content ->> '$.ts', '') <> '')
SELECT target, count(*) AS total_messages, count(*) FILTER (reacted) AS with_reactions, 0::BIGINT AS total_files FROM m GROUP BY 1""")
def slack_catalog(spark, d):
    m = stats.message_stats(_whole_messages(spark, d), "target")
    docs = m.select("target", stats.nested(total=F.col("total_messages"), with_reactions=F.col("with_reactions"), total_reactions=F.col("total_reactions"), thread_parents=F.col("thread_parents")).alias("messages"), stats.nested(total=F.col("total_files")).alias("files"))
    return catalog.table(docs, "slack_channels").select("target", "total_messages", "with_reactions", "total_files")


def _whole_messages(spark, d):
    """Chat messages of the landed files that hold one complete JSON object."""
    files = table(spark, d, "landed_files")
    whole = landed.messages(files).select("file_id").distinct()
    return landed.chat_messages(files).join(whole, "file_id", "left_semi")


@query("ref_p15_github_catalog", """
SELECT o_orderpriority AS target, 0::BIGINT AS stars, count(*) AS total_prs, count(*) FILTER (o_orderstatus = 'F') AS prs_merged, count(*) FILTER (o_orderstatus = 'O') AS prs_open, 0::BIGINT AS total_commits, sum(coalesce(n, 0))::BIGINT AS total_comments FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""")
def github_catalog(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    o = shaping.embed(table(spark, d, "orders"), lines, "o_orderkey", "comments", "l_linenumber")
    none = F.slice("comments", 1, 0)
    pr = o.select(F.col("o_orderpriority").alias("target"), F.when(F.col("o_orderstatus") == "F", "x").alias("merged_at"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"), none.alias("reviews"), none.alias("review_comments"), "comments", F.lit(0).alias("additions"), F.lit(0).alias("deletions"), F.lit(0).alias("changed_files"))
    s = stats.change_stats(pr, "target")
    docs = s.select("target", stats.nested(total=F.col("total"), merged=F.col("merged"), open=F.col("open"), closed=F.col("closed"), total_comments=F.col("total_comments")).alias("pull_requests"))
    return catalog.table(docs, "github_repos").select("target", "stars", "total_prs", "prs_merged", "prs_open", "total_commits", "total_comments")


# filters and recognisers


@query("ref_f2_attachments", r"""
SELECT file_id, s AS source, CASE WHEN s IN ('jira', 'slack', 'confluence') THEN regexp_matches(lower(key), '\.(docx|xlsx|pptx)$') WHEN s = 'bigquery' THEN lower(key) LIKE '%.parquet' ELSE false END AS wanted
FROM (SELECT file_id, path || e AS key, s FROM landed_files, (SELECT unnest(['.docx', '.PPTX', '.parquet', '']) AS e, unnest(['jira', 'slack', 'bigquery', 'google']) AS s))""")
def attachments(spark, d):
    kinds = F.explode(F.array(*[F.struct(F.lit(e).alias("e"), F.lit(s).alias("source")) for e, s in ((".docx", "jira"), (".PPTX", "slack"), (".parquet", "bigquery"), ("", "google"))]))
    keys = table(spark, d, "landed_files").select("file_id", "path", kinds.alias("k"))
    return keys.select("file_id", "k.source", landed.wanted_attachment(F.col("k.source"), F.concat("path", "k.e")).alias("wanted"))


@query("ref_f5_drive_skips", "SELECT load_id, a.mime_type AS mime_type, a.mime_type LIKE 'image/%' OR a.mime_type LIKE 'video/%' OR a.mime_type IN ('application/vnd.google-apps.folder', 'application/vnd.google-apps.form') AND a.mime_type <> 'application/vnd.google-apps.form' AS skipped FROM (SELECT load_id, unnest(attachments) AS a FROM tickets) WHERE a.mime_type IS NOT NULL")
def drive_skips(spark, d):
    mimes = table(spark, d, "tickets").select("load_id", F.explode("attachments.mime_type").alias("mime_type")).where("mime_type is not null")
    return mimes.select("load_id", "mime_type", landed.is_skipped_drive(F.col("mime_type")).alias("skipped"))


@query("ref_f6_thread_parents", "SELECT o_orderkey, o_orderkey % 4 > 0 AND o_orderstatus <> 'O' AS parent FROM orders")
def thread_parents(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey") % 4).alias("replies"), F.when(F.col("o_orderstatus") != "O", "x").alias("ts"))
    return o.select("o_orderkey", landed.is_thread_parent(F.col("replies"), F.col("ts")).alias("parent"))


ENTRIES_SQL = f"""(SELECT rec_id AS id, e.k AS entity_type, e.v AS real_value FROM (SELECT rec_id, unnest([{{'k': 'EMAIL_ADDRESS', 'v': email}}, {{'k': 'PERSON', 'v': name}}, {{'k': 'GITHUB_LOGIN', 'v': github_login}}, {{'k': 'SLACK_USER_ID', 'v': slack_user_id}}, {{'k': 'JIRA_ACCOUNT_ID', 'v': jira_account_id}}]) AS e FROM {ALL_PEOPLE}) WHERE e.v <> '')"""


@query("ref_f7_roster_entries", f"SELECT arg_min(entity_type, id) AS kind, lower(real_value) AS value FROM {ENTRIES_SQL} WHERE length(real_value) >= 4 GROUP BY lower(real_value)")
def roster_entries(spark, d):
    return recognizers.roster_entries(_entries(spark, d))


@query("ref_f9_sweep_entries", f"""
SELECT DISTINCT real_value FROM {ENTRIES_SQL} WHERE entity_type IN ('PERSON', 'EMAIL_ADDRESS') AND length(real_value) >= 6 AND real_value = trim(real_value) AND NOT regexp_matches(real_value, '[<>&;{{}}\\[\\]%#]') AND lower(real_value) NOT IN ('harborworks', 'harborworks.example')
  AND (contains(real_value, '@') OR regexp_full_match(real_value, '[A-Za-z][A-Za-z .''-]+'))""".replace("\\\\", "\\"))
def sweep_entries(spark, d):
    return recognizers.sweep_entries(_entries(spark, d).withColumn("masked_value", F.lit("x")), ["harborworks"], ["harborworks.example"]).select("real_value").distinct()


@query("ref_f10_wanted_by_exporter", r"SELECT source, target, count(*) AS n FROM landed_files WHERE source = 'jira' AND NOT starts_with(path, '_') AND regexp_extract(path, '[^/]*$') NOT IN ('_index.json', '_stats.json') AND regexp_matches(lower(path), '\.(json|eml|docx|xlsx|pptx)$') GROUP BY 1, 2")
def wanted_by_exporter(spark, d):
    """Items of one exporter without infrastructure, counted by target: the filter of the catalog and of validation."""
    files = table(spark, d, "landed_files").where(maskers.MASKERS["jira"].wants(F.col("path")))
    return files.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))


@query("ref_f12_threshold", "SELECT o_orderkey, ['EMAIL_ADDRESS'] AS kinds FROM orders")
def threshold(spark, d):
    """Kinds found at a threshold of 0.9: patterns with less score do not count."""
    t = F.concat(F.lit("mail m"), F.col("o_orderkey").cast("string"), F.lit("@x.test from 10.1.2.3 or 123-45-6789"))
    return table(spark, d, "orders").select("o_orderkey", F.transform(recognizers.spans(t, 0.9), lambda s: s["kind"]).alias("kinds"))


@query("ref_f13_user_keys", "SELECT path FROM landed_files WHERE split_part(path, '/', 2) IN (SELECT DISTINCT project_key FROM tickets WHERE issue_type = 'Bug')")
def user_keys(spark, d):
    slugs = table(spark, d, "tickets").where("issue_type = 'Bug'").select(F.col("project_key").alias("slug"))
    return landed.of_users(table(spark, d, "landed_files").select("path"), "path", slugs)


TYPED = {
    "PHONE_NUMBER": ("+91 9" + "{n}", r"\+?91[\s-]?[6-9]\d{9}"), "IN_PAN": ("ABCDE{4}F", None), "IN_UPI_ID": ("pay.{n}@okaxis", None), "IN_IFSC": ("HDFC0{6}", None), "IN_BANK_ACCOUNT": ("acct {n}77", None), "IN_GST": ("27ABCDE{4}F1Z5", None), "GEO_COORDINATE": ("12.{4}, 77.{4}", None), "IBAN_CODE": ("DE44{n}{n}", None),
}


def _typed_sql(kind: str) -> str:
    form, pattern = TYPED[kind]
    value = "'" + form.replace("{n}", "' || lpad(o_orderkey::VARCHAR, 9, '0') || '").replace("{4}", "' || lpad((o_orderkey % 10000)::VARCHAR, 4, '0') || '").replace("{6}", "' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') || '") + "'"
    return f"SELECT o_orderkey, unnest(regexp_extract_all('see ' || {value} || ' or ' || o_orderstatus, '(?i){pattern or recognizers.BY_KIND[kind].regex}')) AS found FROM orders"


def _typed(kind: str):
    def run(spark, d):
        n, out = F.col("o_orderkey"), F.lit("see ")
        for piece in TYPED[kind][0].replace("{", "\0{").replace("}", "}\0").split("\0"):
            pads = {"{n}": (n, 9), "{4}": (n % 10000, 4), "{6}": (n % 1000000, 6)}
            out = F.concat(out, F.lpad(pads[piece][0].cast("string"), pads[piece][1], "0") if piece in pads else F.lit(piece))
        return table(spark, d, "orders").select("o_orderkey", F.explode(recognizers.matches(F.concat(out, F.lit(" or "), "o_orderstatus"), kind)).alias("found"))

    return run


for _kind in TYPED:
    query(f"ref_t1_{_kind.lower()}", _typed_sql(_kind))(_typed(_kind))


@query("ref_t2_dictionary", "SELECT doc_id, w AS kind, (length(lower(text)) - length(replace(lower(text), w, ''))) // length(w) AS n FROM documents, (SELECT unnest(['comments', 'attachment', 'parent link', 'billing', 'release']) AS w) WHERE contains(lower(text), w)")
def dictionary(spark, d):
    """Hits of a dictionary in whole texts by entry, found by one automaton."""
    entries = [(w, w) for w in ("comments", "attachment", "parent link", "billing", "release")]
    hits = recognizers.dictionary_hits(table(spark, d, "documents"), ["doc_id"], "text", entries)
    return hits.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("ref_t3_card_numbers", """
SELECT o_orderkey, CASE WHEN list_sum([CASE WHEN i % 2 = 0 THEN x ELSE CASE WHEN 2 * x > 9 THEN 2 * x - 9 ELSE 2 * x END END FOR x, i IN digits]) % 10 = 0 THEN [card] ELSE [] END AS cards
FROM (SELECT o_orderkey, card, [substr(card, k, 1)::INTEGER FOR k IN range(1, 17)] AS digits FROM (SELECT o_orderkey, '4111' || lpad(o_orderkey::VARCHAR, 12, '0') AS card FROM orders))""")
def card_numbers(spark, d):
    card = F.concat(F.lit("4111 "), F.regexp_replace(F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), "(.{4})(?=.)", "$1 "))
    return table(spark, d, "orders").select("o_orderkey", recognizers.luhn_cards(F.concat(F.lit("pay "), card, F.lit(" now"))).alias("cards"))


SPANS_SQL = "SELECT l_orderkey, (l_partkey % 50)::INTEGER AS s, (l_partkey % 50 + 1 + l_quantity % 7)::INTEGER AS e, l_discount AS score FROM lineitem"


@query("ref_t4_resolved", f"""
WITH RECURSIVE x AS ({SPANS_SQL}), o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY s, e DESC, score DESC) AS rn FROM x),
walk AS (
  SELECT l_orderkey, rn, s, e, score, e AS last FROM o WHERE rn = 1
  UNION ALL
  SELECT o.l_orderkey, o.rn, o.s, o.e, o.score, o.e FROM walk w JOIN o ON o.l_orderkey = w.l_orderkey AND o.rn = (SELECT min(p.rn) FROM o p WHERE p.l_orderkey = w.l_orderkey AND p.rn > w.rn AND p.s >= w.last))
SELECT l_orderkey, s AS start_at, e AS end_at FROM walk""")
def resolved(spark, d):
    """Spans without overlap, resolved in the JVM."""
    c = F.col
    start = (c("l_partkey") % 50).cast("int")
    spans = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(start.alias("start"), (start + 1 + (c("l_quantity") % 7)).cast("int").alias("end"), c("l_discount").alias("score"))).alias("spans"))
    return spans.select("l_orderkey", F.explode(recognizers.resolved(c("spans"))).alias("s")).select("l_orderkey", c("s.start").alias("start_at"), c("s.end").alias("end_at"))


EMAIL, SSN = recognizers.BY_KIND["EMAIL_ADDRESS"].regex, recognizers.BY_KIND["US_SSN"].regex


@query("ref_t7_scanned_texts", f"SELECT load_id, field, pos, md5(CASE WHEN length(text) < 3 THEN text ELSE replace(regexp_replace(regexp_replace(text, '(?i){EMAIL}', '<EMAIL_ADDRESS>', 'g'), '(?i){SSN}', '<US_SSN>', 'g'), 'harborworks', 'acme') END) AS digest FROM {TEXTS}")
def scanned_texts(spark, d):
    masked = rewriting.scan(F.col("text"), lambda kind, value: f"<{kind}>", [("harborworks", "acme")], kinds=("EMAIL_ADDRESS", "US_SSN"))
    return texts(spark, d).select("load_id", "field", "pos", F.md5(masked).alias("digest"))


@query("ref_t5_spliced", "SELECT o_orderkey, 'a <IP_ADDRESS> b <EMAIL_ADDRESS> ' || o_orderkey AS masked FROM orders")
def spliced(spark, d):
    """Texts with two values of different length replaced at their places."""
    n = F.col("o_orderkey").cast("string")
    return table(spark, d, "orders").select("o_orderkey", rewriting.scan(F.concat(F.lit("a 10.2.3.4 b mail"), n, F.lit("@x.test "), n), lambda kind, value: f"<{kind}>", kinds=("EMAIL_ADDRESS", "IP_ADDRESS")).alias("masked"))


def scan_sql(column: str, literals: list[tuple[str, str]] = []) -> str:  # noqa: B006
    """A text with addresses and social security numbers replaced by their stand-ins, then literal names."""

    def stage(c: str, pattern: str, made: str) -> str:
        return f"[array_to_string(flatten([[z[1], z[2]] FOR z IN list_zip(regexp_split_to_array(v, '(?i){pattern}'), list_append([{made} FOR m IN regexp_extract_all(v, '(?i){pattern}')], ''))]), '') FOR v IN [{c}]][1]"

    out = stage(stage(column, EMAIL, "'[EMAIL_ADDRESS-' || substr(sha256('pii-store:' || m), 1, 8) || ']'"), SSN, "'[REDACTED-SSN]'")
    for old, new in literals:
        out = f"replace({out}, '{old}', '{new}')"
    return f"CASE WHEN {column} IS NULL THEN NULL WHEN length({column}) < 3 THEN {column} ELSE {out} END"


KINDS = ("EMAIL_ADDRESS", "US_SSN")
SCANNER = maskers.Scanner((("harborworks.example", "acme.test"),), KINDS)
NAMES = SCANNER.names()


def _stand_in(kind: str, v: str) -> str:
    h = lambda n: f"substr(sha256('pii-store:' || {v}), 1, {n})"
    domain = f"CASE WHEN lower(regexp_extract({v}, '@([^@]*)$', 1)) = 'harborworks.example' THEN 'acme.test' ELSE regexp_extract({v}, '@([^@]*)$', 1) END"
    local = f"substr(sha256('pii-store:' || regexp_replace({v}, '@[^@]*$', '')), 1, 8)"
    made = {
        "PERSON": f"'User ' || {h(8)}", "GITHUB_LOGIN": f"'user-' || {h(10)}", "JIRA_ACCOUNT_ID": f"'mask-' || {h(8)}", "SLACK_USER_ID": f"'[SLACK_USER_ID-' || {h(8)} || ']'",
        "EMAIL_ADDRESS": f"CASE WHEN contains({v}, '@') THEN {local} || '@' || {domain} ELSE {h(12)} END",
    }
    return f"CASE WHEN {v} IS NULL OR {v} = '' THEN {v} ELSE {made[kind]} END"


@query("ref_t8_typed_lookup", "SELECT load_id, " + ", ".join(f"{_stand_in(k, c)} AS {c}" for k, c in (("PERSON", "assignee"), ("EMAIL_ADDRESS", "assignee_email"), ("JIRA_ACCOUNT_ID", "assignee_account_id"))) + " FROM tickets")
def typed_lookup(spark, d):
    c = {"PERSON": "assignee", "EMAIL_ADDRESS": "assignee_email", "JIRA_ACCOUNT_ID": "assignee_account_id"}
    return table(spark, d, "tickets").select("load_id", *[SCANNER.structured(k)(F.col(n)).alias(n) for k, n in c.items()])


@query("ref_t9_urls", "SELECT load_id, replace(replace(\"self\", 'harborworks.example', 'acme.test'), 'Harborworks.example', 'Acme.test') AS url FROM tickets")
def urls(spark, d):
    return table(spark, d, "tickets").select("load_id", SCANNER.url(F.col("self")).alias("url"))


@query("ref_t10_html", f"""
SELECT load_id, (i - 1)::INTEGER AS pos, md5(regexp_replace(c.rendered_body, '(?i){EMAIL}', '<EMAIL_ADDRESS>', 'g')) AS digest FROM (SELECT load_id, unnest(comments) AS c, generate_subscripts(comments, 1) AS i FROM tickets) WHERE c.rendered_body IS NOT NULL""")
def html(spark, d):
    bodies = table(spark, d, "tickets").select("load_id", F.posexplode("comments.rendered_body").alias("pos", "html")).where("html is not null")
    only = lambda kind, value: "<EMAIL_ADDRESS>" if kind == "EMAIL_ADDRESS" else value
    return bodies.select("load_id", "pos", F.md5(rewriting.scan(F.col("html"), only, html=True)).alias("digest"))


@query("ref_t12_batch_scan", f"SELECT load_id, field, pos, md5(regexp_replace(text, '(?i){EMAIL}', '<EMAIL_ADDRESS>', 'g')) AS digest FROM {TEXTS}")
def batch_scan(spark, d):
    """Texts scanned as joined batches; other kinds than addresses keep their value."""

    @F.pandas_udf("string")
    def scanned(batch):
        import pandas as pd

        return pd.Series(rewriting.scan_batch(list(batch), lambda kind, value: "<EMAIL_ADDRESS>" if kind == "EMAIL_ADDRESS" else value))

    return texts(spark, d).select("load_id", "field", "pos", F.md5(scanned("text")).alias("digest"))


@query("ref_t13_labels", f"SELECT load_id, field, pos, md5(regexp_replace(text, '(?i){EMAIL}', '[EMAIL_ADDRESS]', 'g')) AS digest FROM {TEXTS}")
def labels(spark, d):
    return texts(spark, d).select("load_id", "field", "pos", F.md5(rewriting.labels(F.col("text"), 0.9)).alias("digest"))


@query("ref_t13_allowed", "SELECT c_custkey, 'at keep@x.test and [EMAIL_ADDRESS] or [IP_ADDRESS]' AS masked FROM customer")
def allowed(spark, d):
    t = F.concat(F.lit("at Keep@X.test and c"), F.col("c_custkey").cast("string"), F.lit("@x.test or 10.0.0.7"))
    return table(spark, d, "customer").select("c_custkey", F.replace(rewriting.labels(t, allowed=("keep@x.test",)), F.lit("Keep@X"), F.lit("keep@x")).alias("masked"))


@query("ref_t14_mentions", "SELECT c_custkey, 'cc @user-' || substr(sha256('pii-mask-github-v1:u' || c_custkey), 1, 10) || ' and a@b.test, @user-' || substr(sha256('pii-mask-github-v1:x-y'), 1, 10) AS masked FROM customer")
def mentions(spark, d):
    t = F.concat(F.lit("cc @u"), F.col("c_custkey").cast("string"), F.lit(" and a@b.test, @x-y"))
    return table(spark, d, "customer").select("c_custkey", rewriting.mentions(t).alias("masked"))


@query("ref_t20_audit_sample", "SELECT file_id, substr(content, 1, 8000) AS excerpt FROM landed_files WHERE coalesce(content, '') <> '' ORDER BY md5('42:' || file_id) LIMIT 100")
def audit_sample(spark, d):
    return validation.audit_sample(table(spark, d, "landed_files"), "file_id", "content")


@query("ref_t20_audit_findings", "SELECT o_orderkey, 'PERSON' AS type, o_orderpriority AS value, 'c' AS context FROM orders WHERE o_orderkey % 3 <> 0")
def audit_findings(spark, d):
    o = F.col("o_orderkey") % 3 == 0
    answer = F.when(o, "nothing found []").otherwise(F.concat(F.lit('Here: [{"type": "PERSON", "value": "'), "o_orderpriority", F.lit('", "context": "c"}] done')))
    return validation.audit_findings(table(spark, d, "orders").select("o_orderkey", answer.alias("a")), "o_orderkey", "a")


# maskers


M4_FIELDS = {"PERSON": ("assignee", "reporter", "creator"), "EMAIL_ADDRESS": ("assignee_email", "reporter_email", "creator_email"), "JIRA_ACCOUNT_ID": ("assignee_account_id", "reporter_account_id", "creator_account_id")}


@query("ref_m4_masked_tickets", "SELECT load_id, " + ", ".join(f"{_stand_in(k, c)} AS {c}" for k, cs in M4_FIELDS.items() for c in cs) + ", " + ", ".join(f"{scan_sql(c, NAMES)} AS {c}" for c in ("summary", "description_text", "parent_summary", "description_adf")) + ", replace(replace(\"self\", 'harborworks.example', 'acme.test'), 'Harborworks.example', 'Acme.test') AS self FROM tickets")
def masked_tickets(spark, d):
    rows = table(spark, d, "tickets").select("load_id", *[c for cs in M4_FIELDS.values() for c in cs], "summary", "description_text", "parent_summary", "description_adf", "self")
    return maskers.scan_items(rows, "ticket", SCANNER)


@query("ref_m4_masked_custom_fields", f"SELECT load_id, k AS field, {scan_sql('v', NAMES)} AS value FROM (SELECT load_id, e.key AS k, e.value AS v FROM (SELECT load_id, unnest(map_entries(custom_fields)) AS e FROM tickets))")
def masked_custom_fields(spark, d):
    rows = maskers.scan_items(table(spark, d, "tickets").select("load_id", "custom_fields"), "ticket", SCANNER)
    return shaping.custom_fields(rows, "load_id", "custom_fields")


@query("ref_m5_masked_comments", f"""
SELECT load_id, (i - 1)::INTEGER AS pos, {_stand_in('PERSON', 'c.author')} AS author, {_stand_in('EMAIL_ADDRESS', 'c.author_email')} AS author_email, {_stand_in('JIRA_ACCOUNT_ID', 'c.author_account_id')} AS author_account_id, md5({scan_sql('c.body_text', NAMES)}) AS body_text, md5({scan_sql('c.rendered_body', NAMES)}) AS rendered_body, md5({scan_sql('c.body_adf', NAMES)}) AS body_adf
FROM (SELECT load_id, unnest(comments) AS c, generate_subscripts(comments, 1) AS i FROM tickets)""")
def masked_comments(spark, d):
    rows = maskers.scan_items(table(spark, d, "tickets").select("load_id", "comments"), "ticket", SCANNER)
    c = rows.select("load_id", F.posexplode("comments").alias("pos", "c"))
    return c.select("load_id", "pos", "c.author", "c.author_email", "c.author_account_id", *[F.md5(f"c.{n}").alias(n) for n in ("body_text", "rendered_body", "body_adf")])


@query("ref_m5_masked_changes", f"""
SELECT load_id, (i - 1)::INTEGER AS pos, {_stand_in('PERSON', 'c.author')} AS author, c.field AS field, CASE WHEN c.field IN ('assignee', 'reporter', 'creator', 'Reviewer', 'Approver') THEN {_stand_in('PERSON', 'c."from"')} ELSE {scan_sql('c."from"', NAMES)} END AS old, CASE WHEN c.field IN ('assignee', 'reporter', 'creator', 'Reviewer', 'Approver') THEN {_stand_in('PERSON', 'c."to"')} ELSE {scan_sql('c."to"', NAMES)} END AS new
FROM (SELECT load_id, unnest(changelog) AS c, generate_subscripts(changelog, 1) AS i FROM tickets)""")
def masked_changes(spark, d):
    rows = maskers.scan_items(table(spark, d, "tickets").select("load_id", "changelog"), "ticket", SCANNER)
    c = rows.select("load_id", F.posexplode("changelog").alias("pos", "c"))
    return c.select("load_id", "pos", "c.author", "c.field", F.col("c.from").alias("old"), F.col("c.to").alias("new"))


@query("ref_m5_masked_attachments", f"SELECT load_id, (i - 1)::INTEGER AS pos, {_stand_in('PERSON', 'a.author')} AS author, {_stand_in('EMAIL_ADDRESS', 'a.author_email')} AS author_email, a.filename AS filename, replace(replace(a.content_url, 'harborworks.example', 'acme.test'), 'Harborworks.example', 'Acme.test') AS content_url FROM (SELECT load_id, unnest(attachments) AS a, generate_subscripts(attachments, 1) AS i FROM tickets)")
def masked_attachments(spark, d):
    rows = maskers.scan_items(table(spark, d, "tickets").select("load_id", "attachments"), "ticket", SCANNER)
    return rows.select("load_id", F.posexplode("attachments").alias("pos", "a")).select("load_id", "pos", "a.author", "a.author_email", "a.filename", "a.content_url")


@query("ref_m6_masked_pages", f"SELECT id, {_stand_in('JIRA_ACCOUNT_ID', 'author_id')} AS author_id, {scan_sql('title', NAMES)} AS title, md5({scan_sql('body', NAMES)}) AS body FROM ({PAGES_SQL})")
def masked_pages(spark, d):
    return maskers.scan_items(pages(spark, d).select("id", "author_id", "title", "body"), "page", SCANNER).withColumn("body", F.md5("body"))


@query("ref_m7_masked_messages", f"""
SELECT file_id, {_stand_in('SLACK_USER_ID', "u")} AS user, {scan_sql("t", NAMES)} AS text FROM (SELECT file_id, content ->> '$.user' AS u, content ->> '$.text' AS t FROM landed_files
WHERE source = 'slack' AND contains(path, '/messages/') AND CASE WHEN json_valid(content) THEN json_type(content) = 'OBJECT' ELSE false END)""")
def masked_messages(spark, d):
    return maskers.scan_items(landed.messages(table(spark, d, "landed_files")), "message", SCANNER).select("file_id", "user", "text")


@query("ref_m1_masked_reviews", f"""
SELECT o_orderkey, 'user-' || substr(sha256('pii-store:c' || o_custkey), 1, 10) AS author, 0::BIGINT AS author_id, 'Order of [EMAIL_ADDRESS-' || substr(sha256('pii-store:c' || o_custkey || '@x.test'), 1, 8) || '] at acme.test' AS title, ['user-' || substr(sha256('pii-store:' || o_orderpriority), 1, 10), NULL] AS assignees, 'https://acme.test/pr/' || o_orderkey AS html_url,
  'user-' || substr(sha256('pii-store:' || o_orderstatus), 1, 10) AS reviewer, 'SSN [REDACTED-SSN]' AS review FROM orders""")
def masked_reviews(spark, d):
    c, k = F.col, F.col("o_orderkey").cast("string")
    who = F.concat(F.lit("c"), c("o_custkey").cast("string"))
    rows = table(spark, d, "orders").select(
        "o_orderkey", who.alias("author"), c("o_custkey").cast("long").alias("author_id"), F.concat(F.lit("Order of "), who, F.lit("@x.test at harborworks.example")).alias("title"), F.array("o_orderpriority", F.lit(None)).alias("assignees"), F.concat(F.lit("https://harborworks.example/pr/"), k).alias("html_url"),
        F.array(F.struct(c("o_orderstatus").alias("reviewer"), F.lit("SSN 123-45-6789").alias("body"))).alias("reviews"),
    )
    masked = maskers.scan_items(rows, "review", SCANNER)
    return masked.select("o_orderkey", "author", "author_id", "title", "assignees", "html_url", c("reviews")[0]["reviewer"].alias("reviewer"), c("reviews")[0]["body"].alias("review"))


@query("ref_m3_masked_repository", f"SELECT s_suppkey, 'mail [EMAIL_ADDRESS-' || substr(sha256('pii-store:s' || s_suppkey || '@x.test'), 1, 8) || ']' AS description, ['acme.test', s_name] AS topics FROM supplier")
def masked_repository(spark, d):
    """Metadata without rules of its own: every text at any depth is scanned."""
    rows = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("mail s"), F.col("s_suppkey").cast("string"), F.lit("@x.test")).alias("description"), F.struct(F.array(F.lit("harborworks.example"), "s_name").alias("topics")).alias("about"))
    return maskers.scan_items(rows, "repository", SCANNER).select("s_suppkey", "description", "about.topics")


@query("ref_m8_masked_calendar", f"SELECT event_id, 'Meet [EMAIL_ADDRESS-' || substr(sha256('pii-store:u' || user_id || '@x.test'), 1, 8) || ']' AS summary, ['[EMAIL_ADDRESS-' || substr(sha256('pii-store:u' || user_id || '@x.test'), 1, 8) || ']'] AS attendees FROM events")
def masked_calendar(spark, d):
    mail = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@x.test"))
    rows = table(spark, d, "events").select("event_id", F.concat(F.lit("Meet "), mail).alias("summary"), F.array(F.struct(mail.alias("email"))).alias("attendees"))
    return maskers.scan_items(rows, "calendar", SCANNER).select("event_id", "summary", F.transform("attendees", lambda a: a["email"]).alias("attendees"))


# joins


ROSTER_SQL = f"""(SELECT rec_id, lower(email) AS email, lower(name) AS name, lower(first_name || ' ' || last_name) AS parts, first_name, last_name, lower(github_login) AS login, slack_user_id AS slack, jira_account_id AS jira, confluence_account_id AS wiki FROM {ALL_PEOPLE})"""


def _roster(spark, d):
    c = F.col
    names = ("email", "name", "first_name", "last_name", "github_login", "slack_user_id", "jira_account_id", "confluence_account_id")
    real = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.coalesce(n, F.lit("")) for n in names]))
    masked = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.concat(F.lit(f"{n}-"), c("rec_id").cast("string")) for n in names]))
    return people(spark, d).select(F.format_string("user-%09d", "rec_id").alias("id"), real.alias("real"), masked.alias("masked"))


_H = "substr(sha256('pii-mask-fallback-v1:' || {}), 1, {})".format


@query("ref_j3_by_email", f"""
SELECT load_id, CASE WHEN coalesce(v, '') = '' THEN v WHEN m IS NOT NULL THEN 'email-' || m WHEN contains(v, '@') THEN {_H("regexp_replace(v, '@[^@]*$', '')", 8)} || '@' || regexp_extract(v, '@([^@]*)$', 1) ELSE {_H('v', 12)} END AS masked
FROM (SELECT load_id, assignee_email AS v FROM tickets) LEFT JOIN (SELECT email, max(rec_id) AS m FROM {ROSTER_SQL} WHERE email <> '' GROUP BY 1) ON email = lower(v)""")
def by_email(spark, d):
    return identity.roster_lookup(table(spark, d, "tickets").select("load_id", "assignee_email"), _roster(spark, d), "email", F.col("assignee_email"), "masked").select("load_id", "masked")


@query("ref_j3_by_name", f"""
WITH whole AS (SELECT name AS k, max(rec_id) AS m FROM {ROSTER_SQL} WHERE name <> '' GROUP BY 1), parts AS (SELECT parts AS k, max(rec_id) AS m FROM {ROSTER_SQL} WHERE first_name <> '' AND last_name <> '' GROUP BY 1)
SELECT load_id, CASE WHEN coalesce(v, '') = '' THEN v WHEN w.m IS NOT NULL THEN 'name-' || w.m WHEN p.m IS NOT NULL THEN 'name-' || p.m ELSE 'User ' || {_H('v', 8)} END AS masked FROM (SELECT load_id, reporter AS v FROM tickets) LEFT JOIN whole w ON w.k = lower(v) LEFT JOIN parts p ON p.k = lower(v)""")
def by_name(spark, d):
    return identity.roster_lookup(table(spark, d, "tickets").select("load_id", "reporter"), _roster(spark, d), "name", F.col("reporter"), "masked").select("load_id", "masked")


@query("ref_j3_by_login", f"""
SELECT rec_id, v AS login, CASE WHEN coalesce(v, '') = '' THEN v WHEN m IS NOT NULL THEN 'github_login-' || m ELSE 'user-' || {_H('v', 10)} END AS masked
FROM (SELECT rec_id, CASE WHEN rec_id % 2 = 0 THEN upper(github_login) ELSE slack_username END AS v FROM {ALL_PEOPLE}) LEFT JOIN (SELECT login AS k, max(rec_id) AS m FROM {ROSTER_SQL} WHERE login <> '' GROUP BY 1) ON k = lower(v)""")
def by_login(spark, d):
    rows = people(spark, d).select("rec_id", F.when(F.col("rec_id") % 2 == 0, F.upper("github_login")).otherwise(F.col("slack_username")).alias("login"))
    return identity.roster_lookup(rows, _roster(spark, d), "github_login", F.col("login"), "masked")


@query("ref_j3_by_account", f"""
SELECT load_id, CASE WHEN coalesce(v, '') = '' THEN v WHEN m IS NOT NULL THEN 'jira_account_id-' || m ELSE 'acct-' || {_H('v', 16)} END AS masked FROM (SELECT load_id, reporter_account_id AS v FROM tickets)
LEFT JOIN (SELECT k, max(rec_id) AS m FROM (SELECT jira AS k, rec_id FROM {ROSTER_SQL} UNION ALL SELECT wiki, rec_id FROM {ROSTER_SQL}) WHERE k <> '' GROUP BY 1) ON k = v""")
def by_account(spark, d):
    return identity.roster_lookup(table(spark, d, "tickets").select("load_id", "reporter_account_id"), _roster(spark, d), "jira_account_id", F.col("reporter_account_id"), "masked").select("load_id", "masked")


@query("ref_j3_by_chat_id", f"""
SELECT file_id, CASE WHEN m IS NOT NULL THEN 'slack_user_id-' || m ELSE v END AS masked FROM (SELECT file_id, content ->> '$.user' AS v FROM landed_files WHERE source = 'slack' AND contains(path, '/messages/') AND CASE WHEN json_valid(content) THEN json_type(content) = 'OBJECT' ELSE false END)
LEFT JOIN (SELECT slack AS k, max(rec_id) AS m FROM {ROSTER_SQL} WHERE slack <> '' GROUP BY 1) ON k = v""")
def by_chat_id(spark, d):
    m = landed.messages(table(spark, d, "landed_files")).select("file_id", "user")
    return identity.roster_lookup(m, _roster(spark, d), "slack_user_id", F.col("user"), "masked").select("file_id", "masked")


@query("ref_j11_domains", f"SELECT load_id, field, pos, contains(lower(text), 'harborworks.example') OR contains(lower(text), 'mailnest.test') AS found FROM {TEXTS}")
def domains(spark, d):
    return texts(spark, d).select("load_id", "field", "pos", text.holds_domain(F.col("text"), ["Harborworks.example", "mailnest.test"]).alias("found"))


@query("ref_u4_user_union", f"SELECT src AS source, count(*) AS n, count(*) FILTER (coalesce(email, '') <> '') AS with_email FROM {ALL_PEOPLE} GROUP BY 1")
def user_union(spark, d):
    parts = [table(spark, d, f"people_{t}").select("rec_id", "email", *(["github_login"] if t == "github" else []), F.lit(t).alias("source")) for t in ("github", "slack", "jira")]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("email", F.lit("")) != "").alias("with_email"))


# aggregations and order


@query("ref_a1_nested_counters", "SELECT o_orderstatus || '.' || o_orderpriority AS path, count(*) AS n FROM orders GROUP BY 1")
def nested_counters(spark, d):
    return stats.histogram(table(spark, d, "orders"), F.concat_ws(".", "o_orderstatus", "o_orderpriority")).select(F.col("value").alias("path"), "n")


MESSAGES_SQL = """(SELECT file_id, target, content ->> '$.subtype' AS subtype, content -> '$.reactions' AS reactions FROM landed_files
WHERE source = 'slack' AND contains(path, '/messages/') AND NOT contains(path, '/_') AND CASE WHEN json_valid(content) THEN json_type(content) = 'OBJECT' ELSE false END AND coalesce(content ->> '$.ts', '') <> '')"""


@query("ref_a6_message_stats", f"""
SELECT target, count(*) AS total_messages, count(*) FILTER (json_array_length(reactions) > 0) AS with_reactions, coalesce(sum(list_sum([(r ->> '$.count')::BIGINT FOR r IN json_extract(reactions, '$[*]')])), 0)::BIGINT AS total_reactions, 0::BIGINT AS total_files FROM {MESSAGES_SQL} GROUP BY 1""")
def message_stats(spark, d):
    return stats.message_stats(_whole_messages(spark, d), "target").drop("thread_parents")


@query("ref_a6_subtypes", f"SELECT target, CASE WHEN coalesce(subtype, '') = '' THEN 'user_message' ELSE subtype END AS value, count(*) AS n FROM {MESSAGES_SQL} GROUP BY 1, 2")
def subtypes(spark, d):
    return stats.histogram(_whole_messages(spark, d), F.col("subtype"), ["target"], "user_message")


@query("ref_a7_comment_stats", "SELECT project_key, sum(n)::BIGINT AS total, count(*) FILTER (n > 0) AS items_with_comments FROM (SELECT project_key, coalesce(len([1 FOR x IN comments IF x IS NOT NULL]), 0) AS n FROM tickets) GROUP BY 1")
def comment_stats(spark, d):
    return stats.comment_stats(table(spark, d, "tickets"), "project_key")


@query("ref_a8_mail_stats", "SELECT project_key, count(*) AS total_messages, sum(coalesce(watchers, 0))::BIGINT AS total_size_bytes, sum(coalesce(len([1 FOR x IN attachments IF x IS NOT NULL]), 0))::BIGINT AS total_attachments, count(*) FILTER (len([1 FOR x IN attachments IF x IS NOT NULL]) > 0) AS messages_with_attachments FROM tickets GROUP BY 1")
def mail_stats(spark, d):
    return stats.mail_stats(table(spark, d, "tickets").withColumnRenamed("watchers", "sizeEstimate"), "project_key")


@query("ref_a8_calendar_stats", "SELECT project_key, count(*) AS total_events, count(*) FILTER (len([1 FOR x IN comments IF x IS NOT NULL]) > 0) AS with_attendees, count(*) FILTER (coalesce(sprint, '') <> '') AS with_location FROM tickets GROUP BY 1")
def calendar_stats(spark, d):
    return stats.calendar_stats(table(spark, d, "tickets").select("project_key", F.col("comments").alias("attendees"), F.col("sprint").alias("location")), "project_key")


@query("ref_a8_drive_stats", "SELECT target, count(*) AS total_files, count(*) FILTER (content <> '') AS downloaded, count(*) FILTER (coalesce(content, '') = '') AS skipped, sum(coalesce(size_bytes, 0))::BIGINT AS total_size_bytes FROM landed_files GROUP BY 1")
def drive_stats(spark, d):
    files = table(spark, d, "landed_files").select("target", (F.col("content") != "").alias("downloaded"), F.col("size_bytes").cast("string").alias("size"))
    return stats.drive_stats(files, "target")


@query("ref_a9_page_stats", """
SELECT project_key, count(*) AS total_pages, sum(coalesce(len([1 FOR x IN comments IF x IS NOT NULL]), 0))::BIGINT AS total_comments, count(*) FILTER (len([1 FOR x IN comments IF x IS NOT NULL]) > 0) AS pages_with_comments,
  sum(coalesce(len([1 FOR x IN attachments IF x IS NOT NULL AND coalesce(x.author, '') <> '']), 0))::BIGINT AS total_attachments, sum(coalesce(len([1 FOR x IN attachments IF x IS NOT NULL AND coalesce(x.author, '') = '']), 0))::BIGINT AS failed_attachments,
  sum(coalesce(list_sum([coalesce(x.size, 0) FOR x IN attachments IF coalesce(x.author, '') <> '']), 0))::BIGINT AS total_attachment_size_bytes FROM tickets GROUP BY 1""")
def page_stats(spark, d):
    """Tickets taken as pages; an attachment without author counts as one that failed."""
    pages = table(spark, d, "tickets").select("project_key", "comments", F.transform("attachments", lambda a: F.when(a.isNotNull(), F.struct(a["size"].alias("size"), (F.coalesce(a["author"], F.lit("")) == "").alias("failed")))).alias("attachments"))
    return stats.page_stats(pages, "project_key")


@query("ref_a11_by_exporter", "SELECT source, count(*) AS documents, count(DISTINCT target) AS targets FROM landed_files WHERE path LIKE '%/\\_stats.json' ESCAPE '\\' GROUP BY 1".replace("\\\\", "\\"))
def by_exporter(spark, d):
    """Statistics documents of the landed files by exporter."""
    return table(spark, d, "landed_files").where(F.col("path").endswith("/_stats.json")).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("target").alias("targets"))


@query("ref_o7_report_examples", """
SELECT source AS "check", e.path AS file FROM (SELECT source, path, row_number() OVER (PARTITION BY source ORDER BY path) AS r FROM landed_files WHERE coalesce(content, '') = '') e WHERE r <= 200""")
def report_examples(spark, d):
    """The first examples of each check; the number of examples is a feature of the report, the counts are of all findings."""
    found = table(spark, d, "landed_files").where("coalesce(content, '') = ''").select(F.col("source").alias("check"), F.col("path").alias("file"), F.lit("").alias("value"))
    return validation.report(found, ["slack", "jira"]).select("check", F.explode("examples").alias("e")).select("check", "e.file")


@query("ref_o2_status_order", """
SELECT row_number() OVER (ORDER BY exporter, target, save_id) AS place, exporter, target FROM (SELECT save_id, split_part(job_id, '/', 1) AS exporter, CASE WHEN instr(job_id, '/') = 0 THEN '—' WHEN starts_with(job_id, 'github/') THEN replace(regexp_extract(job_id, '/(.*)', 1), '__', '/') ELSE regexp_extract(job_id, '/(.*)', 1) END AS target FROM checkpoints)""")
def status_order(spark, d):
    """Places of the status rows, sorted as they are shown."""
    rows = shaping.status_rows(table(spark, d, "checkpoints").withColumn("phases", F.col("save_id"))).orderBy("exporter", "target", "phases")
    path = _local(spark, "status")
    rows.coalesce(1).write.parquet(path)
    return spark.read.parquet(path).select((F.monotonically_increasing_id() + 1).alias("place"), "exporter", "target")


@query("ref_o4_listing_order", "SELECT row_number() OVER (ORDER BY created DESC NULLS LAST, load_id) AS place, created FROM (SELECT load_id, created FROM tickets) ORDER BY 1 LIMIT 50")
def listing_order(spark, d):
    """Times of the first items in the order in which their service lists them; the limit is the lister's own."""
    path = _local(spark, "listed")
    projections.listed(table(spark, d, "tickets").select("created"), "tickets", 50).coalesce(1).write.parquet(path)
    return spark.read.parquet(path).select((F.monotonically_increasing_id() + 1).alias("place"), "created")


@query("ref_o6_longest_first", "SELECT c_custkey, '<long> and <short>' AS masked FROM customer")
def longest_first(spark, d):
    """A value that begins another is replaced after it: in long HTML values are replaced everywhere, the longest first."""
    mail = F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@x.test"))
    html = F.concat(F.lit("<p>"), mail, F.lit(".org and "), mail, F.lit("</p>"), F.repeat(F.lit(" "), F.lit(1100)))
    masked = rewriting.scan(html, lambda kind, v: "<long>" if v.endswith(".org") else "<short>", html=True)
    return table(spark, d, "customer").select("c_custkey", F.trim(F.regexp_replace(masked, "</?p>", "")).alias("masked"))


@query("ref_o10_first_documents", r"SELECT project_key, filename FROM (SELECT project_key, filename, row_number() OVER (PARTITION BY project_key ORDER BY load_id, filename) AS r FROM (SELECT DISTINCT project_key, load_id, a.filename AS filename FROM (SELECT project_key, load_id, unnest(attachments) AS a FROM tickets)) WHERE regexp_matches(lower(filename), '\.(docx|xlsx|pptx)$')) WHERE r <= 3")
def first_documents(spark, d):
    """The first office documents of each source: up to three, which is the finder's own limit."""
    names = table(spark, d, "tickets").select("project_key", "load_id", F.explode("attachments.filename").alias("filename")).where(landed.is_office(F.col("filename"))).distinct()
    return sampling.first_per_group(names, ["project_key"], [F.col("load_id"), F.col("filename")], 3).select("project_key", "filename")


@query("ref_u2_languages", "SELECT source AS target, coalesce(lang, '?') AS language, coalesce(sum(n_chars), 0)::BIGINT AS bytes, 0.0::DOUBLE AS percentage FROM documents GROUP BY 1, 2")
def languages(spark, d):
    per = table(spark, d, "documents").groupBy(F.col("source").alias("target"), F.coalesce("lang", F.lit("?")).alias("lang")).agg(F.sum("n_chars").cast("long").alias("b"))
    docs = per.groupBy("target").agg(F.map_from_entries(F.collect_list(F.struct("lang", F.struct(F.col("b").alias("bytes"), F.lit(None).cast("double").alias("percentage"))))).alias("languages"))
    return catalog.languages(docs)


@query("ref_u6_findings_union", "SELECT c AS \"check\", count(*) AS findings, count(*) = 0 AS passed FROM (SELECT 'broken' AS c FROM landed_files WHERE content IS NULL OR NOT json_valid(content) UNION ALL SELECT 'keys' FROM landed_files WHERE contains(lower(path), 'harb')) GROUP BY 1")
def findings_union(spark, d):
    files = table(spark, d, "landed_files")
    broken = validation.broken_json(files, "file_id", "content").select(F.lit("broken").alias("check"), F.col("file_id").cast("string").alias("file"), F.lit("").alias("value"))
    keys = validation.leaking_keys(files, "path", ["harb"]).select(F.lit("keys").alias("check"), F.col("path").alias("file"), F.lit("").alias("value"))
    return validation.report(broken.unionByName(keys), ["broken", "keys"]).select("check", "findings", "passed")


@query("ref_a20_distinct_findings", f"SELECT DISTINCT load_id, lower(email) AS value FROM (SELECT load_id, text FROM {TEXTS}) JOIN (SELECT DISTINCT email FROM {ALL_PEOPLE} WHERE length(email) >= 5) ON contains(lower(text), lower(email))")
def distinct_findings(spark, d):
    """Leaked addresses of a ticket, each once however many of its texts hold it."""
    mails = validation.leak_values(_entries(spark, d).where("entity_type = 'EMAIL_ADDRESS'"))
    rows = texts(spark, d).select(F.col("load_id"), "text")
    return validation.leaks(rows, "load_id", "text", mails).select("load_id", "value").dropDuplicates(["load_id", "value"])


# scalar functions


@query("ref_x3_extensions", "SELECT file_id, CASE WHEN contains(path, '.') THEN lower('.' || regexp_extract(path, '[^.]*$')) ELSE '.unknown' END AS extension FROM landed_files")
def extensions(spark, d):
    return table(spark, d, "landed_files").select("file_id", text.extension(F.col("path")).alias("extension"))


@query("ref_x5_fallback_hashes", f"SELECT rec_id, CASE WHEN coalesce(email, '') = '' THEN email WHEN contains(email, '@') THEN {_H(chr(34) + 'local' + chr(34), 8)} || '@' || regexp_extract(email, '@([^@]*)$', 1) ELSE {_H('email', 12)} END AS masked FROM (SELECT *, regexp_replace(email, '@[^@]*$', '') AS \"local\" FROM {ALL_PEOPLE})")
def fallback_hashes(spark, d):
    return people(spark, d).select("rec_id", hashing.email(F.col("email"), hashing.domain_part(F.col("email")), hashing.ROSTER_SALT).alias("masked"))


def _salted(salt: str, v: str, prefix: str, n: int) -> str:
    return f"CASE WHEN {v} IS NULL OR {v} = '' THEN {v} ELSE '{prefix}' || substr(sha256('{salt}' || {v}), 1, {n}) END"


@query("ref_x7_jira_hashes", f"SELECT load_id, {_salted(hashing.JIRA_SALT, 'assignee', 'User ', 8)} AS name, {_salted(hashing.JIRA_SALT, 'assignee_account_id', 'acct-', 16)} AS account, {_salted(hashing.JIRA_SALT, 'summary', '', 24)} AS text FROM tickets")
def jira_hashes(spark, d):
    c, s = F.col, hashing.JIRA_SALT
    return table(spark, d, "tickets").select("load_id", hashing.person(c("assignee"), s).alias("name"), hashing.account(c("assignee_account_id"), s).alias("account"), hashing.text(c("summary"), s).alias("text"))


@query("ref_x8_wiki_hashes", f"SELECT rec_id, {_salted(hashing.CONFLUENCE_SALT, 'confluence_account_id', 'acct-', 16)} AS account, {_salted(hashing.CONFLUENCE_SALT, 'name', '', 24)} AS text FROM {ALL_PEOPLE}")
def wiki_hashes(spark, d):
    c, s = F.col, hashing.CONFLUENCE_SALT
    return people(spark, d).select("rec_id", hashing.account(c("confluence_account_id"), s).alias("account"), hashing.text(c("name"), s).alias("text"))


@query("ref_x9_roster_fallbacks", f"SELECT rec_id, {_salted(hashing.ROSTER_SALT, 'name', 'User ', 8)} AS name, {_salted(hashing.ROSTER_SALT, 'github_login', 'user-', 10)} AS login, {_salted(hashing.ROSTER_SALT, 'jira_account_id', 'acct-', 16)} AS account, slack_user_id AS chat FROM {ALL_PEOPLE}")
def roster_fallbacks(spark, d):
    """Stand-ins of people whom an empty roster does not know."""
    rows, none = people(spark, d), _roster(spark, d).where("false")
    for by, column, out in (("name", "name", "name_"), ("github_login", "github_login", "login"), ("jira_account_id", "jira_account_id", "account"), ("slack_user_id", "slack_user_id", "chat")):
        rows = identity.roster_lookup(rows, none, by, F.col(column), out)
    return rows.select("rec_id", F.col("name_").alias("name"), "login", "account", "chat")


@query("ref_x11_random_ids", "SELECT event_id, 32 AS length, true AS distinct_ids FROM events")
def random_ids(spark, d):
    """Random ids: each of 32 digits, no two of them equal for equal values of the next event."""
    masked = masking.mask_events(table(spark, d, "events").select("event_id", F.lit("same").alias("user_pseudo_id"), F.lit("same").alias("user_id")))
    return masked.select("event_id", F.length("user_pseudo_id").alias("length"), (F.col("user_pseudo_id") != F.col("user_id")).alias("distinct_ids"))


@query("ref_x12_site_chain", "SELECT event_id, 'https://www-example-health-com.cache.test/doctor/redacted?sid=0&gad_source=0&x=1 | ExampleHealth at example-health-com, ' || user_id || ' example-health.com/feedback/upload/0' AS url FROM events")
def site_chain(spark, d):
    u = F.concat(F.lit("https://www-my-site-com.cache.test/doctor/"), "event_type", F.lit("?c_sid="), F.col("event_id").cast("string"), F.lit("&gad_source=ab-"), F.col("user_id").cast("string"), F.lit("&x=1 | MySite at my-site-com, "), F.col("user_id").cast("string"), F.lit(" my-site.com/feedback/upload/77"))
    return table(spark, d, "events").select("event_id", text.chain(u, text.url_chain("my-site.com", "example-health.com", "MySite", "ExampleHealth")).alias("url"))


@query("ref_x18_retry_after", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN (o_orderkey % 100)::DOUBLE WHEN 1 THEN 120.0 END AS seconds FROM orders")
def retry_after(spark, d):
    k = F.col("o_orderkey")
    header = F.when(k % 3 == 0, (k % 100).cast("string")).when(k % 3 == 1, "Wed, 21 Oct 2015 07:30:00 GMT").otherwise("soon")
    return table(spark, d, "orders").select("o_orderkey", text.retry_after(header, F.lit("2015-10-21 07:28:00").cast("timestamp")).alias("seconds"))


@query("ref_x32_reset_waits", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 300 ELSE greatest(o_orderkey % 200 + 5, 60) END AS wait FROM orders")
def reset_waits(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", text.reset_wait(F.when(k % 5 != 0, 1000 + k % 200), F.lit(1000)).cast("long").alias("wait"))


@query("ref_x21_short_logins", f"SELECT rec_id, lower(substr(first_name, 1, 1) || last_name) AS login FROM {ALL_PEOPLE}")
def short_logins(spark, d):
    return people(spark, d).select("rec_id", text.short_login(F.col("first_name"), F.col("last_name")).alias("login"))


@query("ref_x24_normal_locals", f"SELECT DISTINCT k AS key FROM (SELECT unnest([split_part(m, '@', 1), replace(replace(split_part(m, '@', 1), '.', ''), '_', '')]) AS k FROM (SELECT lower(email) AS m FROM {ALL_PEOPLE} WHERE contains(email, '@')))")
def normal_locals(spark, d):
    return people(spark, d).where(F.contains("email", F.lit("@"))).select(F.explode(identity.local_forms(F.lower("email"))).alias("key")).distinct()


@query("ref_x26_base64", "SELECT doc_id, md5(text) AS digest FROM documents WHERE text IS NOT NULL")
def base64(spark, d):
    """Texts in the alphabet of addresses and without padding, decoded again."""
    coded = F.translate(F.base64(F.encode("text", "utf-8")), "+/\r\n=", "-_")
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(text.base64url(coded)).alias("digest"))


@query("ref_x27_json_fields", "SELECT file_id, content ->> '$.key' AS key, content ->> '$.summary' AS summary FROM landed_files WHERE source = 'jira' AND CASE WHEN json_valid(content) THEN json_type(content) = 'OBJECT' ELSE false END")
def json_fields(spark, d):
    whole = landed.messages(table(spark, d, "landed_files").where("source = 'jira'").withColumns({"source": F.lit("slack"), "path": F.lit("/messages/")})).select("file_id")
    files = table(spark, d, "landed_files").join(whole, "file_id", "left_semi")
    return files.select("file_id", landed.json_fields(F.col("content"), "key string, summary string").alias("j")).select("file_id", "j.key", "j.summary")


@query("ref_x28_percentages", "SELECT o_orderkey, round(o_orderkey % 7 / CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_orderkey % 3 * 4 END::DOUBLE * 100, 2) AS share FROM orders")
def percentages(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", text.percentage(k % 7, k % 3 * 4).alias("share"))


# state of jobs


@query("ref_m13_hashed_reviews", f"""
SELECT o_orderkey, 'user-' || substr(sha256('{hashing.GITHUB_SALT}' || o_orderstatus), 1, 10) AS author, substr(sha256('{hashing.GITHUB_SALT}' || o_orderpriority), 1, 24) AS title, 'https://github.com/user-' || substr(sha256('{hashing.GITHUB_SALT}dev' || o_custkey), 1, 10) || '/repo' AS html_url FROM orders""")
def hashed_reviews(spark, d):
    c = F.col
    rows = table(spark, d, "orders").select("o_orderkey", c("o_orderstatus").alias("author"), c("o_orderpriority").alias("title"), F.concat(F.lit("https://github.com/dev"), c("o_custkey").cast("string"), F.lit("/repo")).alias("html_url"))
    return maskers.mask({"github": rows}, "x.test")["github"]


@query("ref_g1_job_state", "SELECT 'region-' || n_regionkey AS phase, 'completed' AS status, count(*) AS completed, list_sort(list(n_nationkey::VARCHAR)) AS ids FROM nation GROUP BY n_regionkey")
def job_state(spark, d):
    """A job over the nations that is interrupted half way and resumed: every item once, whatever was marked twice."""
    folder = _local(spark, "state")
    items = [(r.n_regionkey, str(r.n_nationkey)) for r in table(spark, d, "nation").orderBy("n_nationkey").collect()]
    for part in (items[: len(items) // 2], items):
        job = Checkpoint(spark, folder, "demo/nations")
        job.load()
        for region, item in part:
            if not job.is_marked(f"region-{region}", item):
                job.mark(f"region-{region}", item)
            job.save()
        job.save(force=True)
    for region in sorted({r for r, _ in items}):
        job.finish(f"region-{region}")
    job.complete()
    again = Checkpoint(spark, folder, "demo/nations")
    again.load()
    return spark.createDataFrame([(n, p.status, p.completed, sorted(p.completed_ids)) for n, p in again.phases.items()], "phase string, status string, completed long, ids array<string>")


@query("ref_g2_statistics", "SELECT 'nations.by_region.' || n_regionkey AS path, count(*) AS value FROM nation GROUP BY n_regionkey UNION ALL SELECT 'nations.total', count(*) FROM nation")
def statistics(spark, d):
    """Counters that are stored half way and go on after they are loaded again."""
    path = f"{_local(spark, 'statistics')}/_stats.json"
    rows = table(spark, d, "nation").orderBy("n_nationkey").collect()
    half = len(rows) // 2
    for part in (rows[:half], rows[half:]):
        s = Statistics(spark, path)
        s.load()
        for r in part:
            s.increment("nations.total")
            s.add_to_map("nations.by_region", str(r.n_regionkey))
        s.save(force=True)
    done = Statistics(spark, path)
    done.load()
    values = [(f"nations.by_region.{k}", v) for k, v in done.get("nations.by_region", {}).items()] + [("nations.total", done.get("nations.total"))]
    return spark.createDataFrame(values, "path string, value long")


@query("ref_g3_cursors", """
SELECT job_id, cursor_at::TIMESTAMP AS cursor_at FROM (SELECT job_id, cursor_at, row_number() OVER (PARTITION BY job_id ORDER BY saved DESC NULLS LAST, save_id DESC) AS r FROM (
  SELECT job_id, save_id, __SAVED__ AS saved, __CURSOR__ AS cursor_at FROM checkpoints) WHERE cursor_at IS NOT NULL) WHERE r = 1""".replace("__SAVED__", time_sql("updated_at")).replace("__CURSOR__", time_sql("phases['tickets'].cursor")))
def cursors(spark, d):
    return resume.cursors(table(spark, d, "checkpoints"), "tickets").withColumn("cursor_at", F.col("cursor_at").cast("timestamp_ntz"))


@query("ref_g8_isolated_targets", "SELECT n_name AS target, n_nationkey % 4 <> 0 AS done FROM nation")
def isolated_targets(spark, d):
    """Work on every target where some fail: the others go on."""
    from fathomgrid import runtime

    def work(target: str) -> bool:
        if numbers[target] % 4 == 0:
            raise ValueError(target)
        return True

    numbers = {r.n_name: r.n_nationkey for r in table(spark, d, "nation").collect()}
    done, failed = runtime.each(numbers, work)
    return spark.createDataFrame([(t, True) for t in done] + [(t, False) for t in failed], "target string, done boolean")


# paged services


def _service(paging: services.Paging, size: int = 10):
    """A service of numbered items, seven for each number in the name of a target; the first call for a page of target 3 fails."""
    asked: set[tuple] = set()

    def fetch(target: str, at: dict) -> object:
        n = int(target) * 7
        start = (at["page"] - 1) * size if paging.way == "number" else int(at["after"] or 0) if paging.way != "offset" else at["start"]
        if target == "3" and (start,) not in asked:
            asked.add((start,))
            raise ConnectionError("try again")
        if target == "5":
            raise PermissionError("no access")
        found = [{"id": f"{target}-{i}"} for i in range(start, min(n, start + size))]
        if not paging.items:
            return found
        page: dict = {paging.items: found, "ok": not (target == "4" and start >= size), "total": n}
        if paging.next and start + size < n:
            way = paging.next.split(".")
            page[way[0]] = str(start + size) if len(way) == 1 else {way[1]: str(start + size)}
        return page

    return fetch


SERVICE_SQL = "SELECT n_nationkey::VARCHAR AS target, i AS pos, n_nationkey || '-' || i AS id, NULL AS error FROM nation, LATERAL (SELECT unnest(range(n_nationkey * 7)) AS i) WHERE n_nationkey <> 5{} UNION ALL SELECT '5', 0, NULL, 'PermissionError: no access'"


def _paged(kind: str):
    def run(spark, d):
        paging = services.SERVICES[kind]
        rows = services.read(table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("target")), _service(paging), paging, attempts=2, base=0.0)
        return rows.select("target", "pos", F.get_json_object("content", "$.id").alias("id"), "error")

    return run


for _name, _kind in (("s11_github", "github"), ("s12_jira", "jira"), ("s12_jira_comments", "jira_comments"), ("s13_slack", "slack"), ("s14_gmail", "gmail"), ("s14_calendar", "calendar"), ("s14_drive", "drive"), ("s15_confluence", "confluence")):
    query(f"ref_{_name}_pages", SERVICE_SQL.format(" AND NOT (n_nationkey = 4 AND i >= 10)" if _kind == "slack" else ""))(_paged(_kind))


# what runs beside the plans


@query("ref_g4_retries", "SELECT n_nationkey, least(n_nationkey % 7 + 1, 5)::INTEGER AS calls, n_nationkey % 7 < 5 AS done FROM nation")
def retries(spark, d):
    """Calls of a function that fails n modulo 7 times, tried five times, in the tasks."""

    @F.pandas_udf("struct<calls:int,done:boolean>")
    def tried(numbers):
        import pandas as pd

        from fathomgrid import runtime

        def one(n: int) -> dict:
            calls = []

            def flaky() -> bool:
                calls.append(1)
                if len(calls) <= n % 7:
                    raise OSError
                return True

            try:
                runtime.retry(attempts=5, sleep=lambda s: None)(flaky)()
            except OSError:
                return {"calls": len(calls), "done": False}
            return {"calls": len(calls), "done": True}

        return pd.DataFrame([one(n) for n in numbers])

    return table(spark, d, "nation").select("n_nationkey", tried("n_nationkey").alias("t")).select("n_nationkey", "t.*")


@query("ref_g5_bucket_waits", "SELECT n::INTEGER AS take, greatest(n - 3, 0) * 0.5::DOUBLE AS seconds FROM unnest(range(1, 11)) t(n)")
def bucket_waits(spark, d):
    """When each of ten permits is given by a bucket of three that refills two a second."""
    from fathomgrid import runtime

    now = [0.0]

    def sleep(s: float) -> None:
        now[0] += s

    bucket = runtime.TokenBucket(2.0, 3.0, clock=lambda: now[0], sleep=sleep)
    given = []
    for n in range(1, 11):
        bucket.take()
        given.append((n, round(now[0], 6)))
    return spark.createDataFrame(given, "take int, seconds double")


@query("ref_g6_token_choice", "SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 3 THEN 'c' WHEN n_nationkey % 4 = 0 THEN 'a' ELSE 'b' END AS token, CASE WHEN n_nationkey % 4 = 3 THEN 5.0 ELSE 0.0 END::DOUBLE AS wait FROM nation")
def token_choice(spark, d):
    """Which of three tokens serves a call, by their budgets, and how long it waits."""

    @F.pandas_udf("struct<token:string,wait:double>")
    def chosen(numbers):
        import pandas as pd

        from fathomgrid.runtime import Token, pick_token

        def one(n: int) -> dict:
            left = {0: (9, 5, 0), 1: (3, 7, 0), 2: (0, 1, 0), 3: (0, 0, 0)}[n % 4]
            token, wait = pick_token([Token("a", left[0], 120.0), Token("b", left[1], 130.0), Token("c", left[2], 105.0)], 100.0)
            return {"token": token.name, "wait": wait}

        return pd.DataFrame([one(n) for n in numbers])

    return table(spark, d, "nation").select("n_nationkey", chosen("n_nationkey").alias("t")).select("n_nationkey", "t.*")


@query("ref_g9_log_lines", "SELECT n_nationkey, 'INFO' AS level, 'export' AS logger, 'nation ' || n_name AS message, n_nationkey::VARCHAR AS target FROM nation")
def log_lines(spark, d):
    """Log records as JSON lines with their extra field, read again."""
    import logging

    from fathomgrid import runtime

    form = runtime.JsonLines()
    rows = []
    for r in table(spark, d, "nation").collect():
        record = logging.makeLogRecord({"name": "export", "levelname": "INFO", "msg": "nation %s", "args": (r.n_name,), "target": str(r.n_nationkey)})
        rows.append((r.n_nationkey, form.format(record)))
    lines = spark.createDataFrame(rows, "n_nationkey int, line string")
    return lines.select("n_nationkey", F.from_json("line", "level string, logger string, message string, target string").alias("l")).select("n_nationkey", "l.*")


@query("ref_x16_types", "SELECT unnest(['STRUCT(a VARCHAR, b BIGINT[])[]', 'MAP(VARCHAR, DOUBLE)', 'STRUCT(\"x\" STRUCT(y DECIMAL(10, 2)))', 'BOOLEAN']) AS text, unnest(['array<struct<a:string,b:array<bigint>>>', 'map<string,double>', 'struct<x:struct<y:decimal(10,2)>>', 'boolean']) AS type")
def types(spark, d):
    """Types as another engine writes them, as they are here once Spark has read them."""
    from pyspark.sql.types import StructType

    texts = ["STRUCT(a VARCHAR, b BIGINT[])[]", "MAP(VARCHAR, DOUBLE)", 'STRUCT("x" STRUCT(y DECIMAL(10, 2)))', "BOOLEAN"]
    return spark.createDataFrame([(t, StructType.fromDDL(f"v {spark_type(t)}")["v"].dataType.simpleString()) for t in texts], "text string, type string")


@query("ref_x30_settings", "SELECT unnest(['A', 'B', 'C', 'D']) AS name, unnest(['7', 'true', 'x|y', 'fallback']) AS value")
def settings(spark, d):
    """Settings of a file of NAME=value lines as numbers, switches and lists, with a default for what is not there."""
    import os
    import tempfile

    from fathomgrid import runtime

    with tempfile.TemporaryDirectory() as folder:
        path = f"{folder}/settings.env"
        with open(path, "w") as f:
            f.write("# comment\nFATHOMGRID_A=7\nFATHOMGRID_B='yes'\nFATHOMGRID_C=x, y,\n")
        try:
            runtime.load_env(path)
            values = [("A", str(runtime.env_int("FATHOMGRID_A", 1))), ("B", str(runtime.env_bool("FATHOMGRID_B")).lower()), ("C", "|".join(runtime.env_list("FATHOMGRID_C"))), ("D", runtime.env("FATHOMGRID_D", "fallback"))]
        finally:
            for n in "ABC":
                os.environ.pop(f"FATHOMGRID_{n}", None)
    return spark.createDataFrame(values, "name string, value string")


# what is left: sinks, sets, structs


@query("ref_k5_parquet_sink", "SELECT count(*) AS written, count(*) AS found, sum(user_id)::BIGINT AS users FROM events")
def parquet_sink(spark, d):
    """Rows counted while they are written, and found again."""
    path = _local(spark, "sink")
    n = sinks.write_parquet(table(spark, d, "events"), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("found"), F.sum("user_id").alias("users")).select(F.lit(n).cast("long").alias("written"), "found", "users")


@query("ref_k9_reencoded", "SELECT doc_id, length(replace(replace(text, chr(13), ''), chr(10), ''))::INTEGER AS n, CASE WHEN doc_id % 2 = 0 THEN 'eml' ELSE 'docx' END AS kind FROM documents WHERE text <> ''")
def reencoded(spark, d):
    """Texts as mails and office documents, masked in one pass by kind with turning round for a scan, and read again: length of the text found, line ends aside."""
    plain = storage.spread(table(spark, d, "documents").where("text <> ''").select("doc_id", "text"))

    @F.pandas_udf("binary")
    def packed(texts):
        from xml.sax.saxutils import escape

        return texts.map(lambda t: documents.package({"word/document.xml": f"<w:p><w:r><w:t>{escape(t)}</w:t></w:r></w:p>"}))

    kind = F.when(F.col("doc_id") % 2 == 0, "eml").otherwise("docx")
    raw = F.when(F.col("doc_id") % 2 == 0, F.encode(F.concat(F.lit("From: a@b.test\r\nSubject: s\r\nContent-Type: text/plain; charset=utf-8\r\n\r\n"), "text"), "utf-8")).otherwise(packed("text"))
    masked = plain.select("doc_id", kind.alias("kind"), documents.masked_bytes(raw, kind, lambda t: t[::-1], lambda a: a, lambda n: n).alias("raw"))

    @F.pandas_udf("int")
    def size(raws, kinds):
        import io
        import re
        import zipfile
        from xml.sax.saxutils import unescape

        import pandas as pd

        def one(raw: bytes, kind: str) -> int:
            if kind == "eml":
                return len(re.sub(r"[\r\n]", "", documents.read_mail(raw)["text"] or ""))
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                return len(re.sub(r"[\r\n]", "", unescape("".join(re.findall(r">([^<]*)<", z.read("word/document.xml").decode())))))

        return pd.Series([one(r, k) for r, k in zip(raws, kinds)])

    return masked.select("doc_id", size("raw", "kind").alias("n"), "kind")


@query("ref_j9_field_names", "SELECT load_id, CASE WHEN length(k) % 2 = 0 THEN 'Custom field (' || k || ')' ELSE 'Custom field (customfield_' || md5(k) || ')' END AS field FROM (SELECT load_id, unnest(map_keys(custom_fields)) AS k FROM tickets)")
def field_names(spark, d):
    """Names of custom fields by id; an id that the table of names lacks stays as it is."""
    ident = lambda k: F.concat(F.lit("customfield_"), F.md5(k))
    t = table(spark, d, "tickets").select("load_id", F.map_from_entries(F.transform(F.map_keys("custom_fields"), lambda k: F.struct(ident(k), F.lit('"v"')))).alias("fields"))
    names = shaping.custom_fields(table(spark, d, "tickets"), "load_id", "custom_fields").where("length(field) % 2 = 0").select(ident(F.col("field")).alias("id"), F.col("field").alias("name")).distinct()
    return shaping.custom_fields(shaping.named_fields(t, "load_id", "fields", names), "load_id", "custom_fields").select("load_id", "field")


@query("ref_j10_message_files", "SELECT ts, count(*) AS files, count(local_file) AS got FROM (SELECT load_id::VARCHAR AS ts, CASE WHEN f.mime_type LIKE 'image/%' THEN NULL ELSE f.id END AS local_file FROM (SELECT load_id, unnest(attachments) AS f FROM tickets) WHERE f.id IS NOT NULL) GROUP BY 1")
def message_files(spark, d):
    """Files of messages and how many of them were downloaded."""
    return local_files(spark, d).groupBy("ts").agg(F.count(F.lit(1)).alias("files"), F.count("local_file").alias("got"))


@query("ref_u3_exporter_totals", "SELECT 'jira' AS exporter, 'items' AS measure, count(*) AS value FROM tickets UNION ALL SELECT 'slack', 'items', count(*) FROM landed_files WHERE source = 'slack' UNION ALL SELECT 'confluence', 'items', count(*) FROM documents")
def exporter_totals(spark, d):
    count = lambda df: df.agg(F.count(F.lit(1)).alias("items"))
    docs = {"jira": count(table(spark, d, "tickets")), "slack": count(table(spark, d, "landed_files").where("source = 'slack'")), "confluence": count(table(spark, d, "documents"))}
    return catalog.summary(docs, {k: ["items"] for k in (*docs, "github")}).where("measure = 'items'")


@query("ref_u7_difference", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def difference(spark, d):
    """Orders without any returned line: the same anti-join by which a run leaves out what is done."""
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return resume.remaining(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", returned)


@query("ref_x14_rebuilt_structs", """
SELECT event_id, md5('key:' || event_type) AS vendor_id, event_type AS category, '/doctor/redacted' AS page, CASE WHEN props IS NULL THEN NULL ELSE md5('key:' || props) END AS gclid, user_id::BIGINT AS n FROM events""")
def rebuilt_structs(spark, d):
    """Structs rebuilt field by field: identifiers by key, addresses rewritten, numbers as they are."""
    c = F.col
    rows = table(spark, d, "events").select(
        "event_id", F.struct(c("event_type").alias("vendor_id"), c("event_type").alias("category"), c("user_id").cast("long").alias("n")).alias("device"), F.struct(F.concat(F.lit("/doctor/"), "event_type").alias("page")).alias("web"), F.struct(c("props").alias("gclid")).alias("collected_traffic_source")
    )
    masked = masking.mask_events(rows, keyed="key:")
    return masked.select("event_id", "device.vendor_id", "device.category", "web.page", "collected_traffic_source.gclid", "device.n")
