"""Processing only new or changed records, exactly once.

A run reads the high watermark from the last committed batch, fixes its upper
bound once at the start, processes the half-open range between them and
publishes output and watermark by one rename. A crash before the rename leaves
nothing behind that a reader sees; the next run repeats the same range. Two
runs that start from the same watermark aim at the same folder, so only one
can publish.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.functions.keys import blank_to_null, flexible_time, latest_by, normal_key

START = -(2**63)


@dataclass(frozen=True)
class Batch:
    """One run: rows with low < sequence <= high; committed tells whether this run published them."""

    low: int
    high: int
    path: str
    committed: bool


def _name(low: int) -> str:
    return f"after={low - START:020d}"


def watermark(spark: SparkSession, table: str) -> int:
    """The highest sequence that committed batches cover: that of the batch which begins last, as each begins where another ends."""
    batches = storage.children(spark, table)
    note = storage.read_text(spark, f"{table}/{batches[-1]}/_watermark.json") if batches else None
    return json.loads(note)["high"] if note is not None else START


def run(rows: DataFrame, table: str, sequence: str, process: Callable[..., DataFrame], history: bool = False) -> Batch | None:
    """Process the rows after the table's watermark and commit the output with the new one.

    sequence: a long column that only grows as rows are committed upstream.
    Rows with a null sequence are never committed upstream and are left out.
    process: gets the new rows and, with history, all rows up to the upper
    bound, for results that depend on older rows too. The upper bound is read
    once, before processing: rows that arrive meanwhile wait for the next run.
    None when there is nothing new. When processing fails nothing is committed,
    and the next run takes the same rows again.
    """
    spark = rows.sparkSession
    low = watermark(spark, table)
    high = rows.where(F.col(sequence) > low).agg(F.max(sequence)).first()[0]
    if high is None:
        return None
    seen = rows.where(F.col(sequence) <= high)
    staged = storage.scratch(spark, "staged")
    new = seen.where(F.col(sequence) > low)
    (process(new, seen) if history else process(new)).write.parquet(f"{staged}/rows")
    storage.write_text(spark, f"{staged}/_watermark.json", storage.dump_json({"low": low, "high": high}))
    final = f"{table}/{_name(low)}"
    return Batch(low, high, final, storage.publish(spark, staged, final))


def committed(spark: SparkSession, table: str) -> DataFrame | None:
    """All rows of committed batches; None when there is none yet."""
    paths = [f"{table}/{name}/rows" for name in storage.children(spark, table)]
    return spark.read.parquet(*paths) if paths else None


def last_success(saves: DataFrame, phase: str = "tickets") -> DataFrame:
    """Of each project its latest save, by updated_at, whose phase is completed and has a cursor.

    saves: checkpoints with project, started (timestamp), saved (timestamp),
    status, cursor (of the phase) and save_id. A cursor that is no time marks a
    page inside a run and is no success. Columns: project, cursor_at, saved_at.
    """
    ok = saves.where((F.col("status") == "completed") & F.col("cursor").isNotNull() & F.col("saved").isNotNull())
    return ok.groupBy("project").agg(latest_by([F.col("saved"), F.col("save_id")], F.col("cursor")).alias("s")).select(
        "project", F.col("s.cursor").alias("cursor_at"), F.col("s.o0").alias("saved_at")
    )


def phase_saves(checkpoints: DataFrame, system: str, phase: str) -> DataFrame:
    """Saves of one system's jobs with the phase of interest spread into columns.

    Null phases, null ids and blank ids are left out of `ids`; the phase is
    null where a save does not know it. Extra columns are ignored.
    """
    p = F.col("phases")[phase]
    job = F.lower(F.split_part(F.col("job_id"), F.lit("/"), F.lit(1)))
    return checkpoints.where(F.trim(job) == system).select(
        "save_id",
        normal_key(F.split_part(F.col("job_id"), F.lit("/"), F.lit(2))).alias("project"),
        flexible_time(F.col("started_at")).alias("started"),
        flexible_time(F.col("updated_at")).alias("saved"),
        F.lower(F.trim(p["status"])).alias("status"),
        flexible_time(blank_to_null(p["cursor"])).alias("cursor"),
        p["completed_ids"].alias("ids"),
    )


def touched(new: DataFrame, seen: DataFrame) -> DataFrame:
    """All rows seen of the keys, in normal form, that have a new row."""
    key = normal_key(F.col("key"))
    keys = new.select(key.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    return seen.withColumn("_key", key).join(keys, "_key", "left_semi").drop("_key")


def keys_to_process(tickets: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Keys whose latest row is not covered by their project's export runs.

    tickets: load_id, loaded_at, key, project_key, updated. Keys and projects
    compare in normal form; rows with a blank key are left out. The latest row
    of a key has the greatest updated (null lowest), ties by greatest load_id.
    A key is due when that row changed after the cursor of the last success or
    was loaded after its save or has no updated, unless a later run has taken
    it since; all keys of a project without success are due. Repeated rows,
    repeated saves and null or repeated ids change nothing. Column: key.
    """
    rows = tickets.select(
        normal_key(F.col("key")).alias("key"), normal_key(F.col("project_key")).alias("project"), "load_id", "loaded_at",
        flexible_time(F.col("updated")).alias("updated"),
    ).where(F.col("key").isNotNull())
    latest = rows.groupBy("key").agg(latest_by([F.col("updated"), F.col("load_id")], F.col("loaded_at"), F.col("project")).alias("r")).select(
        "key", F.col("r.o0").alias("updated"), F.col("r.loaded_at").alias("loaded_at"),
        F.coalesce(F.col("r.project"), F.regexp_replace("key", r"-[^-]*$", "")).alias("project"),
    )
    saves = phase_saves(checkpoints, "jira", "tickets")
    success = last_success(saves)
    taken = (
        saves.join(success.select("project", "saved_at"), "project").where(F.col("saved") > F.col("saved_at"))
        .select("project", "started", "saved", F.explode("ids").alias("id"))
        .select("project", "started", "saved", normal_key(F.col("id")).alias("key")).where(F.col("key").isNotNull())
        .groupBy("project", "started", "key").agg(F.min("saved").alias("first_saved"))
        .groupBy("project", "key").agg(F.max("first_saved").alias("taken_at"))
    )
    changed = F.col("updated").isNull() | (F.col("updated") > F.col("cursor_at")) | (F.col("loaded_at") > F.col("saved_at"))
    covered = F.col("updated").isNotNull() & (F.col("taken_at") >= F.greatest("updated", "loaded_at"))
    return (
        latest.join(success, "project", "left").join(taken, ["project", "key"], "left")
        .where(F.col("saved_at").isNull() | (F.coalesce(changed, F.lit(False)) & ~F.coalesce(covered, F.lit(False))))
        .select("key")
    )
