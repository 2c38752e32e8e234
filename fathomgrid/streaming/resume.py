"""Resumable runs: checkpoints as a table, anti-joins, and streams that take what is new and stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fathomgrid.functions.keys import flexible_time, latest_by, normal_key


def remaining(items: DataFrame, key: str, completed: DataFrame) -> DataFrame:
    """Items whose key is not among the completed ones; null keys stay."""
    return items.join(completed.select(F.col(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def union_ids(done: DataFrame, new: DataFrame) -> DataFrame:
    """Ids of an index after a run: the old and the new ones, each once."""
    return done.unionByName(new).distinct()


def latest_checkpoints(checkpoints: DataFrame) -> DataFrame:
    """The latest save of every job, by updated_at, ties by save_id: job_id, status, saved_at, phases."""
    rows = checkpoints.withColumn("_at", flexible_time(F.col("updated_at")))
    last = rows.groupBy("job_id").agg(F.max(F.struct("_at", "save_id")).alias("_last"))
    return rows.join(last, "job_id").where((F.col("_at").eqNullSafe(F.col("_last._at"))) & (F.col("save_id") == F.col("_last.save_id"))).select("job_id", "status", F.col("_at").alias("saved_at"), "phases")


def completed_items(checkpoints: DataFrame, phase: str) -> DataFrame:
    """Ids that any save lists as completed in a phase, in normal form, each once: job_id, key."""
    return checkpoints.select("job_id", F.explode(F.col("phases")[phase]["completed_ids"]).alias("id")).select("job_id", normal_key(F.col("id")).alias("key")).where(F.col("key").isNotNull()).distinct()


def cursors(checkpoints: DataFrame, phase: str) -> DataFrame:
    """The latest cursor of a phase per job that is a time: job_id, cursor_at."""
    rows = checkpoints.select("job_id", "save_id", flexible_time(F.col("updated_at")).alias("at"), flexible_time(F.col("phases")[phase]["cursor"]).alias("cursor")).where(F.col("cursor").isNotNull())
    return rows.groupBy("job_id").agg(latest_by([F.col("at"), F.col("save_id")], F.col("cursor")).alias("r")).select("job_id", F.col("r.cursor").alias("cursor_at"))


def run_available(
    spark: SparkSession, folder: str, schema: T.StructType | str, checkpoint: str, process: Callable[[DataFrame, int], None], kind: str = "json", files_per_trigger: int = 1000
) -> StreamingQuery:
    """Process the files of a folder that came since the last run, in bounded batches, and stop.

    The checkpoint remembers what was taken. `process` gets each batch with its
    number; a batch that is repeated after a failure has the same number, so a
    writer that names its output by it repeats nothing.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(kind).load(folder)
    query = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(events: DataFrame, at: str, by: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window and value of a stream or table; events later than `late` are left out of a stream."""
    return events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), by, "n")
