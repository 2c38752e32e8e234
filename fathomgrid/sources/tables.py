"""Reading the tables of a data folder."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a folder, given as an address or a local path, and the folder's path in it."""
    if "://" in folder:
        system, root = fs.FileSystem.from_uri(folder)
        return system, root.rstrip("/")
    return fs.LocalFileSystem(), folder.removeprefix("file:").rstrip("/")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Plain types of other engines by name.
PLAIN = {
    "VARCHAR": "string", "TEXT": "string", "BIGINT": "bigint", "INT64": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "TINYINT": "tinyint", "DOUBLE": "double", "FLOAT64": "double", "FLOAT": "float", "BOOLEAN": "boolean", "BOOL": "boolean", "DATE": "date", "TIMESTAMP": "timestamp", "BLOB": "binary", "BYTES": "binary",
}


def spark_type(text: str) -> str:
    """A type as other engines write it, such as STRUCT(a VARCHAR, b BIGINT[])[] or MAP(VARCHAR, DOUBLE), as a Spark type; unknown ones are an error."""
    text = text.strip()
    if text.endswith("[]"):
        return f"array<{spark_type(text[:-2])}>"
    head, _, rest = text.partition("(")
    if rest:
        inner, depth, parts = rest[:-1], 0, [""]
        for c in inner:
            depth += (c == "(") - (c == ")")
            if c == "," and depth == 0:
                parts.append("")
            else:
                parts[-1] += c
        if head.strip().upper() == "STRUCT":
            fields = [p.strip().partition(" ") for p in parts]
            return "struct<" + ",".join(f"{n.strip(chr(34))}:{spark_type(t)}" for n, _, t in fields) + ">"
        if head.strip().upper() == "MAP":
            return "map<" + ",".join(map(spark_type, parts)) + ">"
        if head.strip().upper() == "DECIMAL":
            return f"decimal({inner.replace(' ', '')})"
    if text.upper() not in PLAIN:
        raise ValueError(f"unknown type {text!r}")
    return PLAIN[text.upper()]
