from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.operators import incremental
from fathomgrid.streaming import resume


def test_every_row_once_over_runs_and_failures(spark):
    table = storage.scratch(spark, "incremental")
    first = spark.range(1, 11).withColumnRenamed("id", "seq")
    batch = incremental.run(first, table, "seq", lambda r: r)
    assert (batch.high, batch.committed) == (10, True)
    assert incremental.run(first, table, "seq", lambda r: r) is None

    more = spark.range(1, 21).withColumnRenamed("id", "seq")

    def fails(rows):
        return rows.select(F.raise_error("lost").alias("seq"))

    with pytest.raises(Exception, match="lost"):
        incremental.run(more, table, "seq", fails)
    assert incremental.watermark(spark, table) == 10
    assert incremental.run(more, table, "seq", lambda r: r).low == 10
    assert sorted(r.seq for r in incremental.committed(spark, table).collect()) == list(range(1, 21))


def test_upper_bound_is_fixed_and_only_one_of_two_runs_commits(spark):
    table = storage.scratch(spark, "incremental")
    rows = spark.range(5).withColumnRenamed("id", "seq")
    seen = []

    def other_run_first(bounded):
        seen.append(incremental.run(rows, table, "seq", lambda r: r))
        return bounded

    late = incremental.run(rows, table, "seq", other_run_first)
    assert seen[0].committed and not late.committed
    assert incremental.committed(spark, table).count() == 5


def test_empty_and_null_sequences(spark):
    table = storage.scratch(spark, "incremental")
    assert incremental.run(spark.createDataFrame([], "seq long"), table, "seq", lambda r: r) is None
    assert incremental.run(spark.createDataFrame([(None,)], "seq long"), table, "seq", lambda r: r) is None
    assert incremental.committed(spark, table) is None


TICKETS = "load_id long, loaded_at timestamp, key string, project_key string, updated string"
SAVES = "save_id long, job_id string, status string, started_at string, updated_at string, phases map<string,struct<status:string,total:long,completed:long,cursor:string,completed_ids:array<string>>>"


def test_keys_to_process(spark):
    ok = {"tickets": ("completed", 1, 1, "2026-01-10T00:00:00Z", [])}
    later = {"tickets": ("in_progress", None, 1, "page_3", ["p-2 ", None, "P-4"])}
    saves = [
        (1, "jira/P", "completed", "2026-01-09T00:00:00Z", "2026-01-10T01:00:00+0000", ok), (1, "jira/P", "completed", "2026-01-09T00:00:00Z", "2026-01-10T01:00:00+0000", ok),
        (2, "jira/P", "x", "2026-01-12T00:00:00Z", "2026-01-12 02:00:00", later), (3, "slack/P", "x", "2026-01-12T00:00:00Z", "2026-01-12 02:00:00", ok), (4, "jira/Q", "completed", None, None, None),
    ]
    t = lambda day: f"2026-01-{day:02d}T00:00:00.000+0000"
    ts = "to_timestamp"
    rows = [
        (1, 9, "P-1", t(9)), (2, 9, "P-2", t(11)), (3, 9, "P-3", t(11)), (4, 13, "P-4", t(11)), (5, 9, "p-5", None), (6, 11, "P-6", t(1)), (7, 9, "Q-1", t(1)), (8, 9, "P-1 ", t(8)), (9, 9, None, t(12)), (10, 9, "P-7", "not a time"),
    ]
    df = spark.createDataFrame([(i, f"2026-01-{d:02d} 00:00:00", k, (k or "P").strip()[0].upper(), u) for i, d, k, u in rows], TICKETS.replace("loaded_at timestamp", "loaded_at string")).withColumn("loaded_at", F.expr(f"{ts}(loaded_at)"))
    got = {r.key for r in incremental.keys_to_process(df, spark.createDataFrame(saves, SAVES)).collect()}
    assert got == {"P-3", "P-4", "P-5", "P-6", "Q-1", "P-7"}
    assert incremental.keys_to_process(spark.createDataFrame([], TICKETS), spark.createDataFrame(saves, SAVES)).count() == 0
    assert incremental.keys_to_process(df, spark.createDataFrame([], SAVES)).count() == 8


def test_resume_helpers(spark, tmp_path):
    items = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "key string")
    assert [r.key for r in resume.remaining(items, "key", spark.createDataFrame([("b",), (None,)], "key string")).collect()] in (["a", None], [None, "a"])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"k": 1}\n{"k": 2}\n')
    got = []
    for _ in range(2):
        resume.run_available(spark, str(tmp_path / "in"), "k long", str(tmp_path / "cp"), lambda df, n: got.append((n, df.count())))
    (tmp_path / "in" / "2.json").write_text('{"k": 3}\n')
    resume.run_available(spark, str(tmp_path / "in"), "k long", str(tmp_path / "cp"), lambda df, n: got.append((n, df.count())))
    assert got == [(0, 2), (1, 1)]
