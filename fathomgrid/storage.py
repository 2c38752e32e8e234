"""Shared storage: cutting lineage and committing output atomically.

Everything that outlives a stage goes to the folder the cluster names in
``spark.checkpoint.dir``, which all executors share, so that the loss of an
executor never loses it. Only on a single machine (tests) a folder of our own
is used where that setting is missing. What is left of it when the driver ends
is deleted then.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session, without a trailing slash.

    Without one a cluster is refused: its executors would write to disks of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="fathomgrid-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"


#: Applications whose scratch folder is marked for removal at their end.
_marked: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing exists there yet, and the end of the application removes what will."""
    folder, app = _session_folder(spark), spark.sparkContext.applicationId
    if app not in _marked:
        fs, p = _fs(spark, folder)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _marked.add(app)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Remove all scratch of the session now; results not stored elsewhere can't be read any more."""
    for name in children(spark, _session_folder(spark)):
        remove(spark, f"{_session_folder(spark)}/{name}")


def _fs(spark: SparkSession, path: str) -> tuple[Any, Any]:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; a missing one is no error."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder, sorted; none when it is missing."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small document; the parent folder is created."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Read one small document, None when it is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, staged: str, final: str) -> bool:
    """Move a complete folder into place by one rename.

    True when this call published it; False when `final` was there already,
    in which case the staged folder is removed and nothing changes.
    """
    fs, src = _fs(spark, staged)
    _, dst = _fs(spark, final)
    if not fs.exists(dst):
        fs.mkdirs(dst.getParent())
        if fs.rename(src, dst) and not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(dst, src.getName())):
            return True
        # a rename onto a folder that appeared meanwhile moves the source below it
        nested = spark._jvm.org.apache.hadoop.fs.Path(dst, src.getName())
        if fs.exists(nested):
            fs.delete(nested, True)
    fs.delete(src, True)
    return False


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back with a short lineage.

    Returns the table and its path, so that loops can drop older rounds.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise_counted(df: DataFrame, name: str, which: Column) -> tuple[DataFrame, str, int]:
    """Like materialise, with the number of rows for which a condition holds, counted while writing."""
    seen = Observation()
    stored, path = materialise(df.observe(seen, F.count_if(which).alias("n")), name)
    return stored, path, int(seen.get["n"])


def _plan_nodes(df: DataFrame) -> Iterator[str]:
    """Names of the operators of a table's physical plan."""
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        yield name
        inner = [node.executedPlan()] if name == "AdaptiveSparkPlan" else []
        todo += inner + [node.children().apply(i) for i in range(node.children().size())]


def spread(df: DataFrame) -> DataFrame:
    """The rows over at least as many partitions as there are cores, for stages that compute more than they read.

    Tables with enough partitions, as all large ones have, are not shuffled.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if any("Exchange" in n or n.endswith("QueryStage") for n in _plan_nodes(df)):
        return df  # shuffled already; counting partitions would run its stages
    return df if df._jdf.rdd().getNumPartitions() >= want else df.repartition(want)


def scatter(df: DataFrame) -> DataFrame:
    """The rows over four tasks a core, for work that takes far longer than moving them.

    After a shuffle small results come in few partitions, however much is to be
    computed on each row; partitions asked for by number stay as they are.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def dump_json(value: Any) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, default=str)
