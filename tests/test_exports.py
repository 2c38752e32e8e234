"""Odd cases of sources, sinks, lookups, maskers and job state."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.functions import recognizers, rewriting, text
from fathomgrid.operators import documents, identity, maskers, projections, stats, validation
from fathomgrid.sources import directories, landed, services, sinks
from fathomgrid.sources.tables import spark_type
from fathomgrid.streaming.checkpoint import Checkpoint, Statistics


def test_job_state_is_stored_at_intervals_and_resumed(spark):
    now = [0.0]
    folder = storage.scratch(spark, "jobs")
    job = Checkpoint(spark, folder, "github/a__b", clock=lambda: now[0])
    assert not job.load() and job.status == "in_progress"
    job.start("commits", 3)
    job.mark("commits", "1")
    job.mark("commits", "1")
    assert job.save() and not job.save()
    job.mark("commits", "2")
    job.set_cursor("commits", "2026-01-01")
    now[0] = 31.0
    assert job.save() and not job.save() and job.save(force=True)
    again = Checkpoint(spark, folder, "github/a__b")
    assert again.load() and again.is_marked("commits", "2") and not again.is_marked("commits", "3") and again.phases["commits"].completed == 2 and again.cursor("commits") == "2026-01-01"
    assert again.cursor("none") is None and not again.is_finished("commits")
    again.finish("commits")
    again.complete()
    last = Checkpoint(spark, folder, "github/a__b")
    assert last.load() and last.status == "completed" and last.is_finished("commits")


def test_statistics_by_path(spark):
    s = Statistics(spark, f"{storage.scratch(spark, 'stats')}/_stats.json")
    assert not s.load() and s.get("a.b", 7) == 7
    s.set("exporter", "jira")
    s.increment("tickets.total", 3)
    s.add_to_map("files.by_extension", ".tar.gz")
    assert s.get("tickets.total") == 3 and s.get("files.by_extension") == {".tar.gz": 1} and s.get("exporter.x") is None
    assert s.save() and not s.save()


def test_pages_end_and_failures_stay_with_their_target(spark):
    def slow_list(target, at):
        if target == "bad":
            raise OSError("gone")
        return [{"n": i} for i in range((at["page"] - 1) * 2, min(5, at["page"] * 2))]

    assert [x["n"] for x in services.items(slow_list, "a", services.SERVICES["github"])] == [0, 1, 2, 3, 4]
    assert [x["n"] for x in services.items(slow_list, "a", services.SERVICES["github"], most=3)] == [0, 1, 2]
    targets = spark.createDataFrame([("a",), ("a",), ("bad",), (None,)], "target string")
    rows = services.read(targets, slow_list, services.SERVICES["github"], attempts=2, base=0.0).collect()
    assert sorted((r.target, r.pos, r.error) for r in rows if r.target == "a") == [("a", i, None) for i in range(5)]
    assert [(r.pos, r.content, r.error) for r in rows if r.target == "bad"] == [(0, None, "OSError: gone")]
    assert services.read(targets.where("false"), slow_list, services.SERVICES["github"]).count() == 0
    empty = {"ok": True, "results": None}
    assert list(services.items(lambda t, at: empty, "a", services.SERVICES["confluence"])) == [] and list(services.items(lambda t, at: {"ok": False}, "a", services.SERVICES["slack"])) == []


def test_directories(spark):
    raw = lambda *docs: spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "content string")
    chat = raw({"id": "U1", "name": "a", "profile": {"email": "a@x.test"}}, {"id": "USLACKBOT"}, {"id": "U2", "is_bot": True}, {"id": "U3", "deleted": True}, "{broken")
    assert [(r.slack_user_id, r.email, r.sources) for r in directories.users(chat, "slack").collect()] == [("U1", "a@x.test", ["slack"])]
    mail = raw({"primaryEmail": "b@x.test", "name": {"givenName": "B"}}, {"primaryEmail": "c@x.test", "suspended": True}, {})
    assert [(r.email, r.first_name, r.last_name) for r in directories.users(mail, "google").collect()] == [("b@x.test", "B", "")]
    with pytest.raises(directories.EmptyDirectory, match="jira"):
        directories.all_users({"slack": chat, "jira": raw({"accountType": "app", "accountId": "1"})})


def test_files_are_written_whole_and_copied(spark):
    a, b = storage.scratch(spark, "a"), storage.scratch(spark, "b")
    files = spark.createDataFrame([("x/1.json", "{}"), ("x/2.txt", None), (None, "lost"), ("y.bin", "ä")], "key string, content string")
    assert sinks.write_files(files, a) == 3 and sinks.write_files(files, a) == 3
    assert sinks.copy_keys(landed.list_keys(spark, a), a, b) == 3
    assert {(r.key, r.length) for r in landed.list_keys(spark, b).collect()} == {("x/1.json", 2), ("x/2.txt", 0), ("y.bin", 2)}
    lines = sinks.Lines(spark, storage.scratch(spark, "lines"))
    assert lines.read_all("k long").count() == 0
    lines.append(spark.range(2).withColumnRenamed("id", "k"))
    lines.append(spark.range(2).withColumnRenamed("id", "k"))
    assert lines.read_all("k long").count() == 4
    assert landed.read_catalog(spark, storage.scratch(spark, "none"), "a long").count() == 0


def test_index_keys_of_all_sources(spark):
    rows = [
        ("jira", "jira/A/tickets", '{"keys": ["A-1", "A-1", null, " "]}'), ("slack", "slack/C/messages", '["1.5"]'), ("confluence", "confluence/S/pages", '["7"]'), ("gmail", "google/u/gmail", '[{"id": "m1"}, {"x": 1}, null]'), ("calendar", "google/u/calendar/events", '["e1"]'),
        ("drive", "google/u/drive", '[{"id": "d1", "name": "a/b.DOCX", "downloaded": true}, {"id": "d2", "name": "c.docx", "downloaded": false}, {"id": "d3", "name": "d.png", "downloaded": true}]'), ("jira", "jira/B/tickets", '{"keys": ['), ("slack", "slack/D/messages", None), ("other", "x", "[]"),
    ]
    got = {r.key for r in landed.index_keys(spark.createDataFrame(rows, "source string, base string, content string")).collect()}
    assert got == {"jira/A/tickets/A-1.json", "slack/C/messages/1.5.json", "confluence/S/pages/7.json", "google/u/gmail/m1.eml", "google/u/calendar/events/e1.json", "google/u/drive/d1_a_b.DOCX"}


def test_roster_lookups(spark):
    roster = spark.createDataFrame([("u2", {"name": "Ann Vane", "confluence_account_id": "77"}, {"name": "New", "jira_account_id": "acct-x"}), ("u1", {"first_name": "Ann", "last_name": "Vane", "name": ""}, {"name": "Old"})], "id string, real map<string,string>, masked map<string,string>")
    rows = spark.createDataFrame([("ANN VANE",), ("",), (None,), ("Bo",)], "v string")
    got = {r.v: r.m for r in identity.roster_lookup(rows, roster, "name", F.col("v"), "m").collect()}
    assert got["ANN VANE"] == "New" and got[""] == "" and got[None] is None and got["Bo"].startswith("User ")
    ids = spark.createDataFrame([("77",), ("78",)], "v string")
    assert {r.v: r.m[:6] for r in identity.roster_lookup(ids, roster, "jira_account_id", F.col("v"), "m").collect()} == {"77": "acct-x", "78": "acct-" + identity.roster_lookup(ids.where("v = '78'"), roster, "jira_account_id", F.col("v"), "m").first().m[5]}
    assert identity.roster_lookup(ids, roster, "slack_user_id", F.col("v"), "m").where("v = m").count() == 2


def test_scans_in_nested_records(spark):
    schema = "id long, changelog array<struct<author:string,field:string,`from`:string,to:string>>, comments array<struct<author:string,body_text:string>>, summary string, self string"
    rows = [(1, [("Ann", "assignee", "Ann", None), ("Bo", "status", "mail a@x.test", ""), None], [("Ann", "see 123-45-6789"), (None, None)], "ab", "https://real.test/1"), (2, None, [], None, None)]
    masked = {r.id: r for r in maskers.scan_items(spark.createDataFrame(rows, schema), "ticket", maskers.Scanner((("real.test", "mask.test"),))).collect()}
    first = masked[1]
    assert first.changelog[0]["from"] == first.changelog[0].author != "Ann" and first.changelog[0].to is None and first.changelog[2] is None
    assert first.changelog[1]["from"].startswith("mail [EMAIL_ADDRESS-") and first.changelog[1].to == "" and first.comments[0].body_text == "see [REDACTED-SSN]" and first.comments[1].body_text is None
    assert first.summary == "ab" and first.self == "https://mask.test/1" and masked[2].changelog is None and masked[2].comments == []


def test_texts_and_spans(spark):
    one = spark.range(1)
    spans = "array<struct<start:int,end:int,score:double>>"
    got = spark.createDataFrame([([(5, 9, 0.5), (0, 4, 0.5), (0, 6, 0.1), (6, 7, 0.9)],), ([],), (None,)], f"s {spans}").select(recognizers.resolved(F.col("s")).alias("r")).collect()
    assert [[(x.start, x.end) for x in r.r] if r.r is not None else None for r in got] == [[(0, 6), (6, 7)], [], None]
    assert rewriting.scan_batch(["a@x.test b", None, "ab", "c 10.0.0.1"], lambda k, v: k) == ["EMAIL_ADDRESS b", None, "ab", "c IP_ADDRESS"]
    key = lambda k: one.select(text.mail_key(F.lit(k), lambda c: F.concat(F.lit("n."), c), [("real", "mask")])).first()[0]
    assert key("google/a_at_x.test/gmail/1.eml") == "google/n.a_at_x.test/gmail/1.eml" and key("google/real/x") == "google/mask/x" and key("real") == "mask"
    assert spark_type("STRUCT(a MAP(VARCHAR, INTEGER[]))") == "struct<a:map<string,array<int>>>"
    with pytest.raises(ValueError, match="UNION"):
        spark_type("UNION")
    answers = spark.createDataFrame([(1, 'x [{"type": "a", "value": "v"}] y'), (2, "none"), (3, "[broken"), (4, None)], "k long, a string")
    assert [tuple(r) for r in validation.audit_findings(answers, "k", "a").collect()] == [(1, "a", "v", None)]


def test_documents_and_raw_records(spark):
    raw = documents.package({"word/document.xml": "<w:p><w:r><w:t>real.test</w:t></w:r></w:p>"})
    assert [n for n, _ in documents.package_entries(raw)] == ["word/document.xml"] and documents.package_entries(b"no zip") == []
    assert documents.sweep(b"DKIM d=real.test", [("real.test", "mask.test")]) == b"DKIM d=mask.test"
    docs = spark.createDataFrame([(1, '{"key": "A-1", "fields": {}}'), (2, "{broken"), (3, None)], "id long, json string")
    flat = {r.id: r for r in projections.parsed(docs, "json", projections.TICKET).select("id", *projections.ticket(F.col("doc"))).collect()}
    assert flat[1].key == "A-1" and flat[1].labels == [] and flat[1].votes == 0 and flat[1].time_spent == "" and flat[1].assignee is None and flat[2].key is None and flat[3].labels == []
    pages = spark.createDataFrame([("s", None, [(5, False), (7, True), None]), ("s", [None, "c"], None)], "space string, comments array<string>, attachments array<struct<size:long,failed:boolean>>")
    assert stats.page_stats(pages, "space").first()[1:] == (2, 1, 1, 1, 1, 5)


def test_leaks_by_join_are_those_by_dictionary(spark, folder, monkeypatch):
    texts = spark.createDataFrame([(1, "Mail ANN@x.test or Ann Vane, ann vanes"), (1, "Mail ANN@x.test"), (2, None), (3, ""), (4, "İx Bo Li-Lang; xann@x.test"), (5, "id 12"), (6, "Ann Vane")], "k long, t string")
    values = spark.createDataFrame([("email", "ann@x.test"), ("name", "ann vane"), ("name", "bo li-lang"), ("id", "id 1"), ("name", "mail ann"), ("email", "")], "kind string, value string")
    show = lambda df: sorted(map(tuple, df.collect()))
    want = show(validation.leaks(texts, "k", "t", values))
    monkeypatch.setattr(validation, "BLOCK", 2)
    assert show(validation.leaks(texts, "k", "t", values)) == want and len(want) == 9
    assert validation.leaks(texts.where("false"), "k", "t", values).count() == 0 and validation.leaks(texts, "k", "t", values.where("false")).count() == 0
