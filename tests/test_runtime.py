from __future__ import annotations

import json
import logging

import pytest
from pyspark.sql import functions as F

from fathomgrid import __main__, runtime
from fathomgrid.functions import hashing, rewriting
from fathomgrid.operators import maskers
from fathomgrid.sources.datasource import LandedItems


def test_configuration(monkeypatch, tmp_path):
    (tmp_path / ".env").write_text("# c\nFG_A=1\nFG_B='x, y'\n")
    monkeypatch.setenv("FG_A", "7")
    monkeypatch.delenv("FG_B", raising=False)
    runtime.load_env(str(tmp_path / ".env"))
    assert runtime.env_int("FG_A", 0) == 7 and runtime.env_list("FG_B") == ["x", "y"] and runtime.env_int("FG_B", 3) == 3
    assert runtime.env_bool("FG_NONE", True) and runtime.env("FG_NONE", "d") == "d"
    monkeypatch.delenv("FG_B", raising=False)


def test_retry_bucket_tokens_and_isolation():
    calls, waits = [], []

    @runtime.retry(3, sleep=waits.append)
    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError
        return "ok"

    assert flaky() == "ok" and len(waits) == 2
    with pytest.raises(ZeroDivisionError):
        runtime.retry(2, sleep=waits.append)(lambda: 1 / 0)()
    now = [0.0]
    bucket = runtime.TokenBucket(2, 2, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(6):
        bucket.take()
    assert now[0] == pytest.approx(2.0)
    t = [runtime.Token("a", 5, 100), runtime.Token("b", 9, 100)]
    assert runtime.pick_token(t, 0)[0].name == "b"
    assert runtime.pick_token([runtime.Token("a", 0, 50), runtime.Token("b", 0, 20)], 5) == (runtime.Token("b", 0, 20), 15.0)
    done, failed = runtime.each(["a", "b"], lambda x: {"a": 1}[x])
    assert done == {"a": 1} and failed == {"b": "KeyError: 'b'"}


def test_log_lines_are_json():
    line = runtime.JsonLines().format(logging.makeLogRecord({"msg": "m %s", "args": ("x",), "query": "q"}))
    assert json.loads(line)["message"] == "m x" and json.loads(line)["query"] == "q"


def test_rewriting(spark):
    keep = lambda kind, v: f"<{kind}>"
    assert rewriting.scan_text("mail a@b.test at Acme", keep, [("Acme", "Bolt")]) == "mail <EMAIL_ADDRESS> at Bolt"
    assert rewriting.scan_text(None, keep) is None and rewriting.scan_text("ab", keep) == "ab"
    html = "<style>x@y.test</style><p>a@b.test</p>" + "<p>pad</p>" * 200 + "a@b.test"
    assert rewriting.scan_html(html, keep).count("<EMAIL_ADDRESS>") == 2 and "x@y.test" in rewriting.scan_html(html, keep)
    df = spark.createDataFrame([("cc @ann-l and a@b.test",), (None,), ("@x",)], "v string")
    got = [r[0] for r in df.select(rewriting.mentions(F.col("v"))).collect()]
    h = {n: r for n, r in spark.createDataFrame([("ann-l",), ("x",)], "n string").select("n", hashing.login(F.col("n")).alias("h")).collect()}
    assert got == [f"cc @{h['ann-l']} and a@b.test", None, f"@{h['x']}"]
    assert [r[0] for r in df.select(rewriting.labels(F.col("v"))).collect()] == ["cc @ann-l and [EMAIL_ADDRESS]", None, "@x"]
    assert [r[0] for r in df.select(rewriting.scan(F.col("v"), keep)).collect()] == ["cc @ann-l and <EMAIL_ADDRESS>", None, "@x"]


def test_registry(spark):
    pages = spark.createDataFrame([("1", "a", "T", [("b", "c")])], "id string, author_id string, title string, comments array<struct<author_id:string,body:string>>")
    r = maskers.mask({"confluence": pages}, "x.test")["confluence"].first()
    assert r.id == "1" and r.author_id.startswith("acct-") and len(r.title) == 24 and len(r.comments[0].body) == 24
    reviews = spark.createDataFrame([("ann", 7, ["bob", None], None)], "author string, author_id long, assignees array<string>, reviews array<struct<reviewer:string,body:string>>")
    g = maskers.mask({"github": reviews}, "x.test")["github"].first()
    assert g.author.startswith("user-") and g.author_id == 0 and g.assignees[1] is None and g.reviews is None
    with pytest.raises(ValueError, match="no masker for bigq"):
        maskers.mask({"bigq": pages}, "x.test")
    keys = spark.createDataFrame([("jira/A/tickets/A-1.json",), ("jira/A/_index.json",), ("slack/x.json",)], "k string")
    assert [x[0] for x in keys.select(maskers.MASKERS["jira"].wants(F.col("k"))).collect()] == [True, False, False]


def test_landed_items_by_page_and_cursor(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(f'{{"k": {i}}}')
    (tmp_path / "_index.json").write_text("[]")
    spark.dataSource.register(LandedItems)
    rows = spark.read.format("landed_items").option("page", "2").load(str(tmp_path))
    assert sorted(r.key for r in rows.collect()) == [f"{i}.json" for i in range(5)] and rows.rdd.getNumPartitions() == 3
    got = []
    stream = spark.readStream.format("landed_items").option("page", "2").load(str(tmp_path))
    q = stream.writeStream.foreachBatch(lambda df, n: got.extend(r.key for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(got) == [f"{i}.json" for i in range(5)]


def test_items_that_land_later_under_smaller_keys_are_taken_once(spark, tmp_path):
    spark.dataSource.register(LandedItems)
    (tmp_path / "in" / "b").mkdir(parents=True)
    got = []

    def go():
        stream = spark.readStream.format("landed_items").load(f"file://{tmp_path}/in")
        q = stream.writeStream.foreachBatch(lambda df, n: got.extend((r.key, r.content) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).start()
        q.processAllAvailable()
        q.stop()

    (tmp_path / "in" / "m.json").write_text("1")
    go()
    (tmp_path / "in" / "a.json").write_text("2")
    (tmp_path / "in" / "b" / "c.json").write_text("3")
    go()
    go()
    assert sorted(got) == [("a.json", "2"), ("b/c.json", "3"), ("m.json", "1")]


def test_command_line(spark, folder, tmp_path, capsys):
    assert __main__.main([]) == 0 and "p7_found" in capsys.readouterr().out
    assert __main__.main(["ref_s22_days", "--tables", folder, "--out", f"file://{tmp_path}"]) == 0
    assert spark.read.parquet(f"file://{tmp_path}/ref_s22_days").count() == 14
    with pytest.raises(SystemExit):
        __main__.main(["nothing"])


def test_small_tables_are_spread_and_shuffled_ones_are_not(spark, folder):
    from fathomgrid import storage

    rows = spark.read.parquet(f"{folder}/customer.parquet").selectExpr("c_custkey", "upper(c_name) as exchange_name")
    assert storage.spread(rows).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > rows.rdd.getNumPartitions()
    grouped = rows.groupBy("exchange_name").count()
    assert storage.spread(grouped) is grouped
