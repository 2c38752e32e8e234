from __future__ import annotations

import email
import email.message
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from fathomgrid.operators import catalog, documents, identity, masking, sampling, shaping, stats, validation
from fathomgrid.sources import landed, sinks

PEOPLE = "rec int, email string, name string, github_login string, sources array<string>"


def test_persons_by_address_name_and_login(spark):
    rows = [(1, "Ann.Lee@x.test", "Ann Lee", "", ["s"]), (2, "ann.lee@X.test", "", "al", ["j", "s"]), (3, "", "ann lee", "", ["g"]), (4, None, "", "AnnLee", None), (5, "", "Bob", "zed", ["g"]), (6, "", "Bob", "zed", ["g"]), (7, "bob_ray@y.test", None, None, [None])]
    df = spark.createDataFrame(rows, PEOPLE)
    got = {r.rec: r.person for r in identity.resolve_persons(df, "rec").collect()}
    assert got == {1: "ann.lee@x.test", 2: "ann.lee@x.test", 3: "ann.lee@x.test", 4: "ann.lee@x.test", 5: "_orphan_5", 6: "_orphan_6", 7: "bob_ray@y.test"}
    merged = {r.person: r for r in identity.merge_persons(df, "rec").collect()}
    ann = merged["ann.lee@x.test"]
    assert (ann["name"], ann.github_login, ann.records, ann.sources) == ("Ann Lee", "al", 4, ["s", "j", "g"])
    assert merged["bob_ray@y.test"].sources == []
    assert identity.merge_persons(spark.createDataFrame([], PEOPLE), "rec").count() == 0


def test_lookup_never_multiplies_rows(spark):
    entries = spark.createDataFrame([("EMAIL", "A@x", "m1"), ("EMAIL", "a@X", "m2"), ("NAME", "a@x", "m3")], "entity_type string, real_value string, masked_value string")
    rows = spark.createDataFrame([("a@x",), ("b@x",), (None,)], "v string")
    assert sorted(identity.lookup(rows, entries, "EMAIL", F.col("v"), F.lit("?"), "m").select("v", "m").collect(), key=str) == sorted([("a@x", "m1"), ("b@x", "?"), (None, None)], key=str)
    made = {(r.real_value): r.masked_value for r in identity.get_or_create(entries, spark.createDataFrame([("EMAIL", "A@X"), ("PERSON", "Zed"), ("PERSON", "zed"), ("PHONE_NUMBER", "1"), ("PERSON", ""), ("PERSON", None)], "entity_type string, real_value string")).collect()}
    assert set(made) == {"Zed", "1"} and made["1"].startswith("[PHONE-") and " " in made["Zed"]


def test_numbers_in_order_without_gaps(spark):
    got = identity.numbered(spark.range(500).select((F.col("id") * 7 % 500).alias("v")), "v", 10).collect()
    assert sorted((r.v, r.n) for r in got) == [(i, i + 11) for i in range(500)]


def test_domains(spark):
    df = spark.createDataFrame([("Acme-Corp.co.in",), ("docs.google.com",), ("gmail.com",), ("ab.com",), ("a.b.c.d",), ("bata.com",), (None,)], "domain string")
    assert {tuple(r) for r in identity.discovered_domains(df).collect()} == {("acme-corp.co.in", "fakecompany.co.in", "acme-corp"), ("bata.com", "fakecompany.com", None)}


def test_masking_follows_the_schema(spark):
    df = spark.createDataFrame([(1, "a", ("b", ["c", None], {"k": "d"}), [("e", 1), None]), (2, None, None, None)], "id int, s string, t struct<x:string,y:array<string>,m:map<string,string>>, u array<struct<p:string,q:int>>")
    up = masking.mask_columns(df, {"u.p": lambda c: F.lit("masked")}, F.upper).orderBy("id").collect()
    assert up[0].s == "A" and up[0].t.y == ["C", None] and up[0].t.m == {"k": "D"} and up[0].u[0].p == "masked" and up[0].u[1] is None
    assert up[1].s is None and up[1].u is None
    one = df.select(masking.map_strings(df.schema["t"].dataType, F.col("t"), F.upper, 0).alias("t")).first()
    assert one.t.x == "b"


def test_events(spark):
    schema = "user_pseudo_id string, user_id string, geo struct<city:string,country:string>, device struct<vendor_id:string,page:string>, items array<struct<item_id:string>>, url string, n int"
    df = spark.createDataFrame([("p", None, ("c", "d"), ("v", "/consult/x"), [("i",)], "/doctor/a-b?gad_source=3", 1), (None, "u", None, None, None, None, None)], schema)
    a, b = masking.mask_events(df, keyed="k").collect()
    assert a.geo.city == "(redacted)" and a.geo.country == "d" and a.device.page == "/consult/redacted" and len(a.device.vendor_id) == 32 and a["items"][0].item_id == "i" and a.url == "/doctor/redacted?gad_source=0"
    assert len(b.user_pseudo_id) == 32 and b.geo.city is None and b["items"] is None
    x, y = [masking.mask_events(df).select("user_pseudo_id").first()[0] for _ in range(2)]
    assert len(x) == len(y) == 32 and a.user_id is None


def test_statistics(spark):
    schema = "k string, thread_ts string, reply_count int, reactions array<struct<count:int>>, files array<string>"
    df = spark.createDataFrame([("a", "1", 2, [(3,), (None,)], ["f"]), ("a", None, 2, None, None), ("a", "1", 0, [], [])], schema)
    assert tuple(stats.message_stats(df, "k").first()) == ("a", 3, 1, 1, 3, 1)
    results = spark.createDataFrame([("x", "ok"), ("x", "ok (3 rows)"), ("y", "skipped"), ("y", "error"), ("y", None)], "masker string, status string")
    assert {tuple(r) for r in stats.manifest(results).collect()} == {("x", 2, 2, 0, 0), ("y", 3, 0, 1, 2), (None, 5, 2, 1, 2)}
    assert {tuple(r) for r in stats.mail_stats(spark.createDataFrame([("u", 5, ["a"]), ("u", None, None)], "u string, sizeEstimate long, attachments array<string>"), "u").collect()} == {("u", 2, 5, 1, 1)}
    assert {tuple(r) for r in stats.drive_stats(spark.createDataFrame([("u", True, "7"), ("u", None, "x")], "u string, downloaded boolean, size string"), "u").collect()} == {("u", 2, 1, 1, 7)}
    assert {tuple(r) for r in stats.calendar_stats(spark.createDataFrame([("u", [("a",)], "x"), ("u", [], "")], "u string, attendees array<struct<email:string>>, location string"), "u").collect()} == {("u", 2, 1, 1)}


def test_catalog_defaults(spark):
    docs = spark.createDataFrame([("t", (3, {"Bug": 2}), None), ("s", None, None)], "target string, tickets struct<total:long,by_type:map<string,long>>, exported_at string")
    rows = {r.target: r.asDict() for r in catalog.table(docs, "jira_projects").collect()}
    assert len(rows["t"]) == 13 and rows["t"]["total_tickets"] == 3 and rows["t"]["by_type"] == {"Bug": 2} and rows["s"]["total_tickets"] == 0 and rows["s"]["by_status"] == {} and rows["t"]["exported_at"] == ""
    assert {n: len(t) + 1 for n, t in catalog.TABLES.items()} == {"github_repos": 21, "jira_projects": 13, "slack_channels": 14, "google_users": 16, "confluence_spaces": 9}
    langs = spark.createDataFrame([("r", {"Py": (10, 50.0)})], "target string, languages map<string,struct<bytes:long,percentage:double>>")
    assert tuple(catalog.languages(langs).first()) == ("r", "Py", 10, 50.0)


def test_leaks_and_report(spark):
    values = spark.createDataFrame([("name", "ann lee"), ("email", "a@x.test"), ("id", "12345")], "kind string, value string")
    texts = spark.createDataFrame([("f1", "Joann Lee; ANN LEE, annleea@x.test 123456 Ann Lee"), ("f2", None), ("f3", "")], "key string, text string")
    found = {(r.key, r.kind, r.value, r.at) for r in validation.leaks(texts, "key", "text", values).collect()}
    assert found == {("f1", "name", "ann lee", 11), ("f1", "email", "a@x.test", 26), ("f1", "id", "12345", 35)}
    findings = spark.createDataFrame([("c", f"f{i % 3}", str(i)) for i in range(500)], "check string, file string, value string")
    got = {r.check: r for r in validation.report(findings, ["c", "d"], 5).collect()}
    assert (got["c"].findings, got["c"].files, got["c"].passed, len(got["c"].examples)) == (500, 3, False, 5) and got["d"].passed
    assert validation.leaks(texts, "key", "text", values.where("false")).count() == 0


def test_samples_are_stable(spark):
    df = spark.range(1000).select((F.col("id") % 20).cast("string").alias("t"), "id")
    a, b = [sorted(map(tuple, sampling.stratified(df.repartition(n), "t", "id", 4, 3, 10).collect())) for n in (1, 7)]
    assert a == b and len(a) == 10 and len({t for t, _ in a}) == 4
    assert sampling.target_share("github", 1000) == 20 and sampling.target_share("bigquery", 3) == 3


def test_documents(spark):
    m = email.message.EmailMessage()
    m["From"], m["To"], m["Subject"] = "Ann <ann@x.test>", "bob@y.test, Cid <c@z.test>", "Hello Ann"
    m.set_content("Dear Bob, Ann here")
    m.add_attachment(b"x", maintype="application", subtype="pdf", filename="a.pdf")
    raw = m.as_bytes()
    parts = documents.read_mail(raw)
    assert parts["recipients"] == ["bob@y.test", "c@z.test"] and parts["attachments"] == ["a.pdf"] and "Ann here" in parts["text"]
    masked = documents.mask_mail(raw, lambda t: t.replace("Ann", "Eve"), lambda a: "m@m.test", lambda n: "M")
    back = documents.read_mail(masked)
    assert back["subject"] == "Hello Eve" and back["sender"] == "M <m@m.test>" and "Eve here" in back["text"] and back["attachments"] == ["a.pdf"]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", "<w:p><w:r><w:t>An</w:t></w:r><w:r><w:t>n &amp; co</w:t></w:r></w:p><w:p><w:t>x</w:t></w:p>")
        z.writestr("word/media/i.png", b"\x00")
    office = documents.mask_office(buffer.getvalue(), lambda t: t.replace("Ann", "Eve"))
    with zipfile.ZipFile(io.BytesIO(office)) as z:
        assert z.read("word/document.xml").decode() == "<w:p><w:r><w:t>Ev</w:t></w:r><w:r><w:t>e &amp; co</w:t></w:r></w:p><w:p><w:t>x</w:t></w:p>"
    assert documents.spread("abc", [1, 1]) == ["abc", ""] and documents.package_entries(office, "word/*.xml")[0][0] == "word/document.xml" and documents.package_entries(b"x") == []
    df = spark.createDataFrame([(bytearray(raw), "eml"), (bytearray(b"junk"), "docx"), (None, "eml")], "c binary, k string")
    got = [r[0] for r in df.select(documents.masked_bytes(F.col("c"), F.col("k"), lambda t: t, lambda a: "m@m.test", lambda n: n)).collect()]
    assert b"m@m.test" in bytes(got[0]) and got[1] is None and got[2] is None
    assert [r[0] for r in df.select(documents.mail_parts(F.col("c"))["subject"]).collect()] == ["Hello Ann", None, None]


def test_shaping(spark):
    raw = '{"type":"doc","content":[{"type":"text","text":"a"},{"type":"hardBreak"},{"type":"mention","attrs":{"id":"i","text":"@b"}}]}'
    df = spark.createDataFrame([(raw,), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(shaping.document_text(F.col("v"))).collect()] == ["a\n@b", None, None]
    parents, children = spark.range(2).withColumnRenamed("id", "k"), spark.createDataFrame([(0, i) for i in range(9)], "k long, o int")
    got = {r.k: r for r in shaping.embed(parents, children, "k", "c", "o", most=3).collect()}
    assert [x.o for x in got[0].c] == [0, 1, 2] and got[0].c_total == 9 and got[1].c == [] and got[1].c_total == 0
    fields = spark.createDataFrame([(1, {"f1": '{"value":"A"}', "f2": '["x","y"]', "f3": '"t"', "f4": '{"q":1}'})], "k int, raw map<string,string>")
    names = spark.createDataFrame([("f1", "Team")], "id string, name string")
    assert shaping.named_fields(fields, "k", "raw", names).first().custom_fields == {"Custom field (Team)": "A", "Custom field (f2)": "x, y", "Custom field (f3)": "t", "Custom field (f4)": '{"q":1}'}
    words = spark.createDataFrame([("i", 1, 1, 1, "Ann", 90, 10, 10, 30, 12), ("i", 1, 1, 1, "called", 90, 50, 10, 60, 12), ("i", 1, 1, 1, " ", 90, 0, 0, 1, 1), ("i", 1, 1, 1, "low", -1, 0, 0, 1, 1)], "image string, block_num int, par_num int, line_num int, text string, conf int, left int, top int, width int, height int")
    assert [r.text for r in shaping.lines_of_words(words).collect()] == ["Ann called"]
    masked = shaping.lines_of_words(words).withColumn("masked", F.lit("Eve called"))
    assert [tuple(r)[4:] for r in shaping.changed_boxes(words, masked).collect()] == [("Ann", 7, 7, 43, 25)]
    messages = spark.createDataFrame([("1", [("f", None)]), ("2", None)], "ts string, files array<struct<id:string,_local_file:string>>")
    linked = {r.ts: r.files for r in shaping.with_local_files(messages, spark.createDataFrame([("1", "f", "a.bin")], "ts string, file_id string, local_file string")).collect()}
    assert linked["1"][0]._local_file == "a.bin" and linked["2"] is None


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "t.csv").write_text("user,x\n ann ,1\n,2\n--,3\nbob,4\n")
    (tmp_path / "a" / "d.json").write_text('{"k": 1}')
    base = f"file://{tmp_path}/a"
    assert [r.user for r in landed.read_csv_column(spark, f"{base}/t.csv", "user").collect()] == ["ann", "bob"]
    with pytest.raises(ValueError, match="user, x"):
        landed.read_csv_column(spark, f"{base}/t.csv", "gone")
    assert {(r.key, r.length) for r in landed.list_keys(spark, base).collect()} == {("t.csv", 29), ("d.json", 8)}
    assert landed.read_documents(spark, f"{base}/d.json", "k int").first().k == 1 and landed.read_documents(spark, f"{base}/none.json", "k int").count() == 0
    assert landed.exists(spark, f"{base}/d.json") and not landed.exists(spark, f"{base}/e.json")
    assert sinks.copy_keys(spark.createDataFrame([("d.json",)], "key string"), str(tmp_path / "a"), str(tmp_path / "b")) == 1 and (tmp_path / "b" / "d.json").read_text() == '{"k": 1}'
    assert sinks.write_parquet(spark.range(7), f"file://{tmp_path}/p") == 7 and len(sinks.write_lines(spark.range(9), "unused", dry_run=True)) == 3
    spark.range(3).write.parquet(f"file://{tmp_path}/days/20260101.parquet")
    assert landed.read_days(spark, f"file://{tmp_path}/days", ["20251231", "20260101"]).count() == 3
    sinks.write_document(spark.range(1), f"file://{tmp_path}/one.json")
    assert (tmp_path / "one.json").read_text() == '{"id":0}'


def test_thread_replies(spark):
    rows = [(1, "c", "1.0", "1.0", None, "u", "parent"), (2, "c", "1.2", "1.0", "u", "v", "second"), (3, "c", "1.1", "1.0", None, "w", "first"), (4, "d", "1.1", "1.0", None, "w", "other channel"), (5, "c", "2.0", "2.0", "u", "u", "kept"), (6, "c", "3.0", None, None, "u", "alone")]
    df = spark.createDataFrame(rows, "file_id long, target string, ts string, thread_ts string, parent_user_id string, user string, text string")
    got = {r.file_id: [x.file_id for x in r["_replies"]] for r in shaping.thread_replies(df, "target").collect()}
    assert got == {1: [3, 2], 5: [5]}
