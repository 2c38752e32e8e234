"""Reading landed exports: listings, documents, columns of CSV files, rosters, day tables."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomgrid import storage
from fathomgrid.functions import text
from fathomgrid.sources.tables import file_system

# Folders and files that describe an export and are no items.
INFRASTRUCTURE = ("_checkpoints/", "_manifest/")
DESCRIPTIONS = ("_index.json", "_stats.json")
OFFICE = ("docx", "xlsx", "pptx")
IMAGES = ("png", "jpg", "jpeg", "gif", "bmp", "tiff", "tif", "webp")
MASKABLE = ("json", "eml", *OFFICE)
SKIPPED_ENDINGS = (".mp4", ".mov", ".avi", ".wmv", ".flv", ".mkv", ".webm", ".apk", ".ipa", ".ico", ".heic")
SKIPPED_DRIVE = ("folder", "shortcut", "map", "site", "fusiontable")


def list_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder without reading them, empty ones too: key (relative path) and length. A missing folder has none.

    The folders of the first level are listed by the tasks, each with all that
    is below it, through Arrow's file systems.
    """
    root = folder.rstrip("/")
    system, at = file_system(root)
    top = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
    own = spark.createDataFrame([(i.base_name, i.size) for i in top if i.is_file], "key string, length long")
    folders = [(i.base_name,) for i in top if not i.is_file]
    if not folders:
        return own

    def listed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = file_system(root)
        for b in it:
            for name in b.column(0).to_pylist():
                found = [i for i in system.get_file_info(fs.FileSelector(f"{at}/{name}", recursive=True)) if i.is_file]
                yield pa.RecordBatch.from_arrays([pa.array([i.path[len(at) + 1 :] for i in found], pa.string()), pa.array([i.size for i in found], pa.int64())], names=["key", "length"])

    return own.unionByName(spark.createDataFrame(folders, "folder string").repartition(min(len(folders), 1000)).mapInArrow(listed, "key string, length long"))


def entities(keys: DataFrame, key: str, level: int) -> DataFrame:
    """Distinct names at one level of the keys, counted from 1."""
    return keys.select(F.get(F.split(key, "/"), F.lit(level - 1)).alias("entity")).where(F.col("entity").isNotNull()).distinct()


def bounded_keys(keys: DataFrame, key: str, prefix: str, most: int, suffix: str = "") -> DataFrame:
    """Keys below a prefix with a suffix among the first `most` keys; the bound comes before the suffix."""
    return keys.where(F.col(key).startswith(prefix)).orderBy(key).limit(most).where(F.col(key).endswith(suffix))


def read_documents(spark: SparkSession, paths: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Whole-file JSON documents with a known schema and their path; broken ones have nulls only. None found gives an empty table."""
    try:
        return spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE").json(paths).withColumn("path", F.input_file_name())
    except Exception as e:  # a missing folder is an empty export
        if "PATH_NOT_FOUND" not in str(e):
            raise
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("path", F.lit(None).cast("string"))


def read_bytes(spark: SparkSession, paths: str, pattern: str = "*") -> DataFrame:
    """Files as bytes: path, length, content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(paths).select("path", "length", "content")


def exists(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, path)


def read_csv_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One named column of a CSV file, trimmed, without values that hold no letter or digit."""
    table = spark.read.option("header", "true").csv(path)
    if column not in table.columns:
        raise ValueError(f"no column {column!r}, there are: {', '.join(table.columns)}")
    value = F.trim(F.col(f"`{column}`"))
    return table.select(value.alias(column)).where(F.col(column).rlike("[a-zA-Z0-9]"))


def users_from_addresses(rows: DataFrame, email: str) -> DataFrame:
    """Names of users by the local parts of their addresses: email, first_name, last_name, name.

    A local part with at least two parts between dots and underscores gives the first and last of them, capitalised; others give blanks.
    """
    parts = F.split(F.split_part(F.col(email), F.lit("@"), F.lit(1)), "[._]")
    cap = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))
    two = F.size(parts) >= 2
    first, last = F.when(two, cap(parts[0])).otherwise(""), F.when(two, cap(F.element_at(parts, -1))).otherwise("")
    return rows.select(F.col(email).alias("email"), first.alias("first_name"), last.alias("last_name"), F.trim(F.concat_ws(" ", first, last)).alias("name"))


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """Users of roster documents with their real and masked fields as maps: id, real, masked."""
    schema = "version int, domain_map map<string,string>, users array<struct<id:string,real:map<string,string>,masked:map<string,string>>>"
    return read_documents(spark, path, schema).select(F.explode("users").alias("u")).select("u.*")


def read_days(spark: SparkSession, folder: str, days: list[str]) -> DataFrame:
    """Day tables `folder/<day>.parquet`, those that exist; missing days are left out."""
    there = set(storage.children(spark, folder))
    paths = [f"{folder}/{d}.parquet" for d in days if f"{d}.parquet" in there]
    if not paths:
        raise ValueError(f"no table of the days {', '.join(days)} in {folder}")
    return spark.read.parquet(*paths)


def days(spark: SparkSession, end: str, count: int) -> DataFrame:
    """The last `count` days up to a day as yyyyMMdd."""
    last = F.to_date(F.lit(end))
    return spark.range(1).select(F.explode(F.sequence(F.date_sub(last, count - 1), last)).alias("d")).select(F.date_format("d", "yyyyMMdd").alias("day"))


def should_process(key: Column) -> Column:
    """Whether a key is an item to mask: no infrastructure, no description, a known ending."""
    name = F.substring_index(key, "/", -1)
    infrastructure = F.lit(False)
    for p in INFRASTRUCTURE:
        infrastructure = infrastructure | key.startswith(p)
    return ~infrastructure & ~name.isin(*DESCRIPTIONS) & F.lower(key).rlike(r"\.(" + "|".join(MASKABLE) + ")$")


def is_office(key: Column) -> Column:
    return F.lower(key).rlike(r"\.(" + "|".join(OFFICE) + ")$")


def is_image(key: Column) -> Column:
    return F.lower(key).rlike(r"\.(" + "|".join(IMAGES) + ")$")


def is_skipped_file(name: Column, mode: Column) -> Column:
    """Chat files that are not downloaded: removed or external ones, films and programs."""
    ending = F.when(F.contains(name, F.lit(".")), F.lower(F.concat(F.lit("."), F.substring_index(name, ".", -1)))).otherwise("")
    return F.coalesce(mode.isin("tombstone", "external"), F.lit(False)) | F.coalesce(ending.isin(*SKIPPED_ENDINGS), F.lit(False))


def is_skipped_drive(mime: Column) -> Column:
    """Drive entries that are not downloaded: folders and the like, images and films."""
    return mime.isin(*[f"application/vnd.google-apps.{x}" for x in SKIPPED_DRIVE]) | mime.startswith("image/") | mime.startswith("video/")


def wanted_attachment(source: Column, key: Column) -> Column:
    """Whether a file beside the items is masked: office documents of ticket, chat and wiki services, tables of event services, nothing else."""
    return F.when(source.isin("jira", "slack", "confluence"), is_office(key)).when(source == "bigquery", F.lower(key).endswith(".parquet")).otherwise(F.lit(False))


def of_users(keys: DataFrame, key: str, slugs: DataFrame) -> DataFrame:
    """Keys below the folder of one of the users (column slug), the second part of the key."""
    return keys.withColumn("_slug", F.get(F.split(key, "/"), F.lit(1))).join(slugs.select(F.col("slug").alias("_slug")).distinct(), "_slug", "left_semi").drop("_slug")


def is_thread_parent(reply_count: Column, thread_ts: Column) -> Column:
    """Whether a message has replies of its own."""
    return F.coalesce((reply_count > 0) & (F.coalesce(thread_ts, F.lit("")) != ""), F.lit(False))


def index_keys(indexes: DataFrame) -> DataFrame:
    """Keys of the items that index documents list: key, each once.

    indexes: source, base (folder of the index), content. Tickets by key, chat
    messages by ts, wiki pages and calendar events by id, mails by the id of
    their entry, stored files by id and safe name where they were downloaded and
    are office documents. Broken indexes and blank entries give none.
    """
    content, source = F.col("content"), F.lower(F.trim("source"))
    names = F.when(source == "jira", F.from_json(content, "keys array<string>")["keys"]).when(source.isin("slack", "confluence", "calendar"), F.from_json(content, "array<string>"))
    entry = F.from_json(content, "array<struct<id:string,name:string,downloaded:boolean>>")
    stored = F.transform(F.filter(entry, lambda e: F.coalesce(e["downloaded"], F.lit(False)) & (e["id"] != "") & (e["name"] != "")), lambda e: F.concat_ws("_", e["id"], text.file_name(e["name"])))
    listed = F.when(source == "gmail", F.transform(entry, lambda e: e["id"])).when(source == "drive", F.filter(stored, is_office)).otherwise(names)
    ending = F.when(source == "gmail", ".eml").when(source == "drive", "").otherwise(".json")
    rows = indexes.select("base", ending.alias("ending"), F.explode(listed).alias("name")).where(F.coalesce(F.trim("name"), F.lit("")) != "")
    return rows.select(F.concat("base", F.lit("/"), "name", "ending").alias("key")).distinct()


def existing(keys: DataFrame, listing: DataFrame) -> DataFrame:
    """Keys with whether a listing (key) has them."""
    there = listing.select("key").distinct().withColumn("exists", F.lit(True))
    return keys.join(there, "key", "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


def day_tables(spark: SparkSession, folder: str, wanted: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """Day tables `day=<yyyyMMdd>` of a folder with their day, and a row (day, status) for each wanted one: ok or missing. No table gives None."""
    there = set(storage.children(spark, folder))
    found = [d for d in wanted if f"day={d}" in there]
    status = spark.createDataFrame([(d, "ok" if d in found else "missing") for d in wanted], "day string, status string")
    tables = spark.read.option("basePath", folder).parquet(*[f"{folder}/day={d}" for d in found]) if found else None
    return tables, status


def read_catalog(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """A catalog table of JSON lines by its schema; a table that was never written is empty."""
    return spark.read.schema(schema).json(folder) if storage.exists(spark, folder) else spark.createDataFrame([], schema)


def chat_messages(files: DataFrame) -> DataFrame:
    """Chat messages of landed files with what statistics need: file_id, target, ts, thread_ts, subtype, reply_count, reactions, files; contents that hold no message are left out."""
    schema = "ts string, thread_ts string, subtype string, reply_count long, reactions array<struct<name:string,count:long,users:array<string>>>, files array<struct<id:string,name:string>>"
    found = files.where((F.col("source") == "slack") & F.contains("path", F.lit("/messages/")) & ~F.contains("path", F.lit("/_")))
    return found.select("file_id", "target", F.from_json("content", schema).alias("m")).select("file_id", "target", "m.*").where(F.coalesce("ts", F.lit("")) != "")


def messages(files: DataFrame) -> DataFrame:
    """Chat messages of landed files that hold one complete JSON object: file_id, target, ts, thread_ts, parent_user_id, user, text."""
    names = ("ts", "thread_ts", "parent_user_id", "user", "text")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for i, content in enumerate(b.column(2).to_pylist()):
                try:
                    value = json.loads(content)
                except ValueError:
                    continue
                if isinstance(value, dict):
                    rows.append((i, *(None if value.get(n) is None else str(value[n]) for n in names)))
            kept = b.take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), *(pa.array([r[k] for r in rows], pa.string()) for k in range(1, 6))], names=["file_id", "target", *names])

    found = files.where((F.col("source") == "slack") & F.contains("path", F.lit("/messages/")) & F.col("content").isNotNull())
    return found.select(F.col("file_id").cast("long").alias("file_id"), "target", "content").mapInArrow(batches, "file_id long, target string, " + ", ".join(f"{n} string" for n in names))


def json_fields(content: Column, schema: str) -> Column:
    """Fields of a JSON text by schema; null for broken ones."""
    return F.from_json(content, schema, {"mode": "PERMISSIVE"})
