from __future__ import annotations

import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.operators import compaction


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (2, 4)])
def test_curve_visits_neighbours(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    codes = compaction.hilbert_codes(points, bits)
    assert sorted(codes) == list(range(len(points)))
    way = points[np.argsort(codes)]
    assert (np.abs(np.diff(way, axis=0)).sum(1) == 1).all()


def files_of(df):
    return {f: os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in df.inputFiles()}


def test_balanced_files_and_equal_rows_also_for_a_hot_code(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("x" * 50).alias("content"), F.lit(None).cast("double").alias("n"))
    path = storage.scratch(spark, "compacted")
    made = compaction.compact(rows, path, [F.col("k"), F.col("n")], F.lit(50), 100_000)
    back = spark.read.parquet(path)
    counts = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert made.rows == back.count() == 20_000 and len(counts) == made.files == 11
    assert max(counts) < 1.3 * min(counts)
    assert compaction.digest(rows, rows.columns) == compaction.digest(back.select(*rows.columns), rows.columns)


def test_far_values_and_equal_rows_stay_balanced_and_in_order(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") == 5, 10**15).otherwise(F.col("id") % 4000).alias("k"), F.lit("x").alias("content"))
    same = spark.range(10_000).select(F.lit(17).cast("long").alias("k"), F.lit("same").alias("content"))
    path = storage.scratch(spark, "compacted")
    made = compaction.compact(rows.unionByName(same), path, [F.col("k"), F.col("k")], F.lit(99), 150_000)
    per = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect()
    assert made.files == len(per) == 20 and max(r.n for r in per) < 1.3 * min(r.n for r in per)
    ends = sorted((r.low, r.high) for r in per if r.high < 10**15)
    assert all(b[0] >= a[1] - 8 for a, b in zip(ends, ends[1:]))


def test_nothing_is_published_when_digests_differ(spark, monkeypatch):
    real = compaction.digest
    calls = []

    def wrong(rows, columns):
        calls.append(1)
        n, s, x = real(rows, columns)
        return n + len(calls), s, x

    monkeypatch.setattr(compaction, "digest", wrong)
    path = storage.scratch(spark, "compacted")
    with pytest.raises(compaction.DigestMismatch):
        compaction.compact(spark.range(5), path, [F.col("id")], F.lit(1))
    assert not storage.exists(spark, path)


FILES = "file_id long, path string, source string, target string, size_bytes long, modified_at timestamp, content string"


def landed(spark, rows):
    return spark.createDataFrame([(i, p, s, t, 1, None if m is None else m, c) for i, p, s, t, m, c in rows], FILES.replace("modified_at timestamp", "modified_at string")).withColumn("modified_at", F.expr("to_timestamp(modified_at)"))


def test_records_of_landed_files(spark):
    day = "2026-01-0{} 00:00:00".format
    rows = [
        (1, "slack/C/messages/b/1.json", "slack", "C", day(1), '{"ts": "1.5"}'), (2, "slack/C/messages/b/1-copy.json", "slack", "C", day(2), ' [{"ts": 1.500000}] '), (3, "slack/C/messages/b/2.json", "slack", "C", day(1), '{"ts": "2.000000", "x"'),
        (4, "slack/C/messages/b/_index.json", "slack", "C", day(1), '["1.500000", "2.000000", 3, null, ["a"]]'), (5, "slack/C/messages/b/4.json", "slack", "C", day(1), '{"ts": "4.000000"} {}'), (6, "slack/C/messages/b/5.json", "slack", "C", None, '{"ts": "5"}'),
        (7, "jira/P/tickets/b/P-1.json", "jira", "P", day(1), '{"key": " p-1\\n"}'), (8, "jira/P/tickets/b/P-1.json.1", "jira", "P", day(1), '{"key": "P-1"}'), (9, "jira/P/tickets/b/_index.json", "jira", "P", day(1), '{"keys": ["P-1", "p-9", ""], "custom_fields": []}'),
        (10, "jira/P/b/_stats.json", "jira", "P", day(1), '{"key": "P-7"}'), (11, "jira/P/tickets/b/x.json", "jira", "P", day(1), None), (12, "jira/P/tickets/b/y.json", "jira", "P", day(1), "[{}, {}]"), (13, "jira/P/tickets/b/z.json", "jira", "P", day(1), '{"key": null}'),
    ]
    kept, lost = compaction.compact_landed(landed(spark, rows), storage.scratch(spark, "compacted"))
    found = {tuple(r) for r in compaction.irregular(kept, lost).collect()}
    assert found == {("slack", "C", "1.500000", 2), ("slack", "C", "2.000000", -1), ("slack", "C", "3.000000", -1), ("jira", "P", "P-1", 8), ("jira", "P", "P-9", -1)}
    assert {(r.record_id, r.content) for r in kept.collect()} == {("1.500000", '{"ts": 1.500000}'), ("5.000000", '{"ts": "5"}'), ("P-1", '{"key": "P-1"}')}


def test_no_files(spark):
    kept, lost = compaction.compact_landed(landed(spark, []), storage.scratch(spark, "compacted"))
    assert kept.count() == lost.count() == 0
