"""Queries of the general data-pipeline operators: p2, p4, p6 and p7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.functions.keys import flexible_time, latest_by, normal_key
from fathomgrid.operators import compaction, hierarchy, incremental, nested
from fathomgrid.sources.tables import table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records of landed_files without exactly one readable object, from a full compaction."""
    kept, lost = compaction.compact_landed(table(spark, folder, "landed_files"), storage.scratch(spark, "compacted"))
    return compaction.irregular(kept, lost)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Keys an export run must take, committed as one batch together with its watermark."""
    state = storage.scratch(spark, "exports")
    checkpoints = table(spark, folder, "checkpoints")
    incremental.run(table(spark, folder, "tickets"), state, "load_id", lambda new: incremental.keys_to_process(new, checkpoints))
    done = incremental.committed(spark, state)
    return done if done is not None else spark.createDataFrame([], "key string")


class Crash(RuntimeError):
    """A failure in the middle of a run."""


def p4_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Keys to take in each of three runs while tickets land in three parts, with a failed run before the second and an idle one at the end."""
    state = storage.scratch(spark, "runs")
    tickets, checkpoints = table(spark, folder, "tickets"), table(spark, folder, "checkpoints")
    low, high = tickets.agg(F.min("load_id"), F.max("load_id")).first()
    for n, fails in ((1, False), (2, True), (2, False), (3, False), (3, False)):

        def process(new: DataFrame, seen: DataFrame, n: int = n, fails: bool = fails) -> DataFrame:
            due = incremental.keys_to_process(incremental.touched(new, seen), checkpoints).withColumn("run", F.lit(n))
            if fails:
                due.write.parquet(storage.scratch(spark, "lost"))
                raise Crash
            return due

        landed = tickets.where(F.col("load_id") <= (low or 0) + ((high or 0) - (low or 0)) * n // 3)
        try:
            incremental.run(landed, state, "load_id", process, history=True)
        except Crash:
            continue
    found = incremental.committed(spark, state)
    return found.select("run", "key") if found is not None else spark.createDataFrame([], "run int, key string")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Flat tables of the nested fields of tickets, one under the other."""
    tickets = table(spark, folder, "tickets")
    ids = lambda c: F.transform(c, lambda x: F.when(x.isNotNull(), F.struct(x["id"].alias("id"))))
    arrays = tickets.select(
        "load_id", nested.without_repeats(ids("comments"), "id").alias("comments"), nested.without_repeats(ids("attachments"), "id").alias("attachments"),
        F.transform("changelog", lambda x: F.when(x.isNotNull(), F.struct(x["field"].alias("field")))).alias("changelog"),
    )
    flat = nested.placed(nested.labels(arrays, "load_id"), "load_id", {"comments": "comment", "attachments": "attachment", "changelog": "changelog"})
    nodes = nested.tree_links(tickets, "load_id", "description_adf")
    return flat.unionByName(nodes.withColumn("child", F.lit("adf_node")))


def ticket_parents(tickets: DataFrame) -> DataFrame:
    """key and parent of the latest row of every key, both in normal form."""
    rows = tickets.select(
        normal_key(F.col("key")).alias("key"), normal_key(F.col("parent_key")).alias("parent"), "load_id", flexible_time(F.col("updated")).alias("updated")
    ).where(F.col("key").isNotNull())
    latest = rows.groupBy("key").agg(latest_by([F.col("updated"), F.col("load_id")], F.col("parent")).alias("r"))
    return latest.select("key", F.col("r.parent").alias("parent"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Root, depth and cycle state of every ticket key."""
    return hierarchy.hierarchy(ticket_parents(table(spark, folder, "tickets")))


def p7_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Path of every ticket key: the keys from its root, or from the cycle's key it hangs on, down to itself."""
    tree = hierarchy.hierarchy(ticket_parents(table(spark, folder, "tickets")), with_path=True)
    return tree.select("key", F.array_join("path", " > ").alias("path"), "in_cycle")


def p7_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """All descendants of every ticket key with their distance, itself included."""
    return hierarchy.descendants(hierarchy.hierarchy(ticket_parents(table(spark, folder, "tickets")), with_path=True))


QUERIES = {"p4_runs": p4_runs, "p7_paths": p7_paths, "p7_descendants": p7_descendants, "p2_found": p2_found, "p4_found": p4_found, "p6_found": p6_found, "p7_found": p7_found}
