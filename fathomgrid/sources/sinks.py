"""Writing results: JSON lines, Parquet, copies, single documents, fixed-width tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.sources.tables import file_system


def write_lines(rows: DataFrame, path: str, dry_run: bool = False) -> list[str]:
    """A table as JSON lines; a dry run writes nothing and returns the first three rows, cut at 200 characters."""
    if dry_run:
        return [r[0][:200] for r in rows.limit(3).select(F.to_json(F.struct("*"))).collect()]
    rows.write.mode("overwrite").json(path)
    return []


def write_parquet(rows: DataFrame, path: str, compression: str = "snappy") -> int:
    """A table as Parquet; returns the number of rows, counted while writing."""
    count = Observation()
    rows.observe(count, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", compression).parquet(path)
    return int(count.get["n"])


def write_document(row: DataFrame, path: str) -> None:
    """A single row as one JSON document."""
    first = row.select(F.to_json(F.struct("*"))).first()
    storage.write_text(row.sparkSession, path, first[0] if first else "{}")


# Content types by file ending.
CONTENT_TYPES = {
    ".json": "application/json", ".eml": "message/rfc822", ".txt": "text/plain", ".html": "text/html", ".csv": "text/csv", ".parquet": "application/octet-stream",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
}


def content_type(key: Column) -> Column:
    """Content type of a key by its ending, plain bytes for others."""
    out = F.lit("application/octet-stream")
    for ending, kind in CONTENT_TYPES.items():
        out = F.when(F.lower(key).endswith(ending), kind).otherwise(out)
    return out


def _put(system: fs.FileSystem, path: str, data: bytes | None, source: fs.NativeFile | None = None) -> None:
    """Write a file beside its place and move it there, so that a reader never sees a part."""
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.part-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        if source is None:
            out.write(data or b"")
        else:
            while chunk := source.read(8 << 20):
                out.write(chunk)
    system.move(part, path)


def write_files(files: DataFrame, folder: str) -> int:
    """One file for each row (key, content as bytes or text) below a folder; returns how many.

    Written by the tasks through Arrow's file systems; a repeated task writes
    the same files again. Rows without key are left out, null contents are empty files.
    """

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        n = 0
        for b in it:
            for key, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                _put(system, f"{root}/{key}", content)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows = files.where(F.col("key").isNotNull()).select("key", F.col("content").cast("binary").alias("content"))
    return int(rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0)


def write_documents(rows: DataFrame, key: Column, folder: str) -> int:
    """Each row as an indented JSON document of its own under its key."""
    return write_files(rows.select(key.alias("key"), F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("content")), folder)


def copy_keys(keys: DataFrame, source: str, target: str) -> int:
    """Copy files named in `key` from one folder to another, in parallel and in pieces; returns how many.

    A file that is there already is written again, so a repeated task changes nothing.
    """

    def copy(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (system, root), (into, to) = file_system(source), file_system(target)
        n = 0
        for b in it:
            for key in b.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{key}") as f:
                    _put(into, f"{to}/{key}", None, f)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return int(keys.select("key").mapInArrow(copy, "n long").agg(F.sum("n")).first()[0] or 0)


class Lines:
    """JSON lines that grow by appended tables; what was appended stays readable after a failure."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").json(self.path)

    def read_all(self, schema: str) -> DataFrame:
        """All rows appended so far; none where nothing was."""
        if not storage.exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(self.path)


def manifest_document(counts: DataFrame, finished_at: Column) -> DataFrame:
    """A manifest as one row: finished_at, overall and the counts by masker; counts: masker (null overall), total, masked, skipped, failed."""
    numbers = F.struct("total", "masked", "skipped", "failed")
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("masker").isNotNull(), F.struct("masker", numbers.alias("counts")))))).alias("maskers"), F.max(F.when(F.col("masker").isNull(), numbers)).alias("overall")).select(finished_at.alias("finished_at"), "overall", "maskers")


def roster_documents(users: DataFrame, size: int = 1000) -> DataFrame:
    """Roster documents of up to `size` users each: version, domain_map, users. users: number (consecutive), id, real, masked."""
    numbered = users.withColumn("_d", F.floor(F.col("number") / size))
    return numbered.groupBy("_d").agg(F.array_sort(F.collect_list(F.struct("id", "real", "masked")), lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)).alias("users")).select(F.lit(1).alias("version"), F.create_map().cast("map<string,string>").alias("domain_map"), "users")


def export_store(entries: DataFrame, domains: DataFrame) -> DataFrame:
    """Entries and domains as ordered rows of one export: section, key, value, and the number of entries under `total`; write_lines stores them."""
    e = entries.select(F.col("entity_type").alias("section"), F.col("real_value").alias("key"), F.col("masked_value").alias("value"))
    d = domains.select(F.lit("domain_map").alias("section"), F.col("real_domain").alias("key"), F.col("masked_domain").alias("value"))
    total = entries.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("section"), F.lit("").alias("key"), F.col("n").cast("string").alias("value"))
    return e.unionByName(d).unionByName(total).orderBy("section", "key")


def fixed_width(columns: list[tuple[Column, int]]) -> Column:
    """A line of a table with columns of fixed width, cut and padded to the right."""
    return F.rtrim(F.concat_ws(" ", *[F.rpad(F.coalesce(c, F.lit("—")), w, " ") for c, w in columns]))
