"""Many tiny files into few well-sized ones, clustered along a Hilbert curve.

Steps: compute a multidimensional Hilbert code per record from the ranks of its
dimensions, count the bytes of every code exactly, cut the curve into files of
equal size from those counts, shuffle each record straight to its file, write,
and compare digests of source and destination rows before publishing.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from fathomgrid import storage

#: Bits of each dimension: its values are placed by rank among 2**BITS quantiles.
BITS = 12


def hilbert_codes(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of each row of an (n, dims) array of unsigned integers.

    Vectorised form of the transposed-axes construction: rotations are undone
    from the highest bit down, then the axes are Gray-decoded and interleaved.
    """
    x = points.astype(np.uint64).T.copy()
    dims = len(x)
    top = np.uint64(1 << (bits - 1))
    q = top
    while q > 1:
        low = q - np.uint64(1)
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - np.uint64(1)), t)
        q >>= np.uint64(1)
    x ^= t
    code = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            code = (code << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return code.astype(np.int64)


def _quantiles(rows: DataFrame, numbers: list[Column]) -> list[np.ndarray]:
    """Distinct quantiles of each dimension; values are placed by their rank, so single far ones do not stretch the scale."""
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = rows.agg(*[F.percentile_approx(n, shares, 1 << (BITS + 1)).alias(f"q{i}") for i, n in enumerate(numbers)]).first()
    return [np.unique(np.array(q if q is not None else [], np.float64)) for q in found]


def _cuts(coded: DataFrame, weight: Column, file_bytes: int) -> tuple[pd.DataFrame, int, int]:
    """Codes at which a file begins or that several files share: code, off and len in bytes along the curve; with all bytes and the number of files.

    The bytes of every code are counted exactly and summed along the curve in
    ranges of codes; only the sums of the ranges and the codes at the files'
    ends, at most two a file, come to the driver.
    """
    spark = coded.sparkSession
    counts, counts_at = storage.materialise(coded.groupBy("_code").agg(F.sum(weight).alias("len")), "codes")
    ranges, ranges_at = storage.materialise(counts.repartitionByRange("_code").withColumn("part", F.spark_partition_id()), "ranges")
    sums = ranges.groupBy("part").agg(F.sum("len").alias("s")).orderBy("part").toPandas()
    total = int(sums.s.sum())
    files = max(1, -(-total // file_bytes))
    base = spark.createDataFrame(pd.DataFrame({"part": sums.part.astype("int32"), "base": (sums.s.cumsum() - sums.s).astype("int64")}), "part int, base long") if len(sums) else spark.createDataFrame([], "part int, base long")
    along = Window.partitionBy("part").orderBy("_code")
    placed = ranges.join(F.broadcast(base), "part").select("_code", (F.col("base") + F.sum("len").over(along) - F.col("len")).alias("off"), "len")
    file_of = lambda at: F.floor(at.cast("decimal(30,0)") * files / F.lit(total))
    last, first = file_of(F.col("off") + F.col("len") - 1), file_of(F.col("off"))
    cuts = placed.where((first != last) | (F.col("off") == 0) | (first != file_of(F.col("off") - 1))).toPandas().sort_values("_code")
    storage.remove(spark, counts_at)
    storage.remove(spark, ranges_at)
    return cuts, total, files


def digest(rows: DataFrame, columns: list[str]) -> tuple[int, int, int]:
    """Number of rows, sum and exclusive-or of their hashes: equal for equal multisets of rows, in any order."""
    h = rows.select(F.xxhash64(*columns).alias("h"))
    n, s, x = h.agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
    return int(n), int(s or 0), int(x or 0)


@dataclass(frozen=True)
class Compacted:
    path: str
    rows: int
    files: int


class DigestMismatch(RuntimeError):
    """Source and destination rows differ; nothing was published."""


def compact(rows: DataFrame, path: str, dims: list[Column], size: Column, file_bytes: int = 128 << 20) -> Compacted:
    """Write the rows as balanced files in Hilbert order of two to four numeric dimensions.

    size: bytes of a row. Null dimensions count as the lowest value. A code that
    holds more than a file's share is spread over several files by the hash of
    its rows and their places, so no task gets an unbounded part. Rows are neither dropped nor
    merged; repeated rows stay repeated. Raises DigestMismatch and publishes
    nothing if the written rows differ from the given ones. The rows are read
    four times, the first two times only dimensions and size: pass a stored
    table, not a long plan. What comes to the driver and travels to the tasks is
    bounded by the number of files.
    """
    spark = rows.sparkSession
    columns = rows.columns
    numbers = [d.cast("double") for d in dims]
    quantiles = _quantiles(rows, numbers)

    @F.pandas_udf("long")
    def code(points: pd.DataFrame) -> pd.Series:
        ranks = [np.where(np.isnan(v), 0, np.searchsorted(q, v, side="left")) for q, v in zip(quantiles, points.to_numpy(np.float64, na_value=np.nan).T)]
        return pd.Series(hilbert_codes(np.stack(ranks, 1), BITS))

    coded = rows.withColumn("_code", code(F.struct(*[n.alias(f"d{i}") for i, n in enumerate(numbers)])))
    cuts, total, files = _cuts(coded, F.coalesce(size.cast("long"), F.lit(0)) + 1, file_bytes)
    at, off, length = (cuts[c].to_numpy(np.int64) for c in ("_code", "off", "len"))

    @F.pandas_udf("int")
    def place(codes: pd.Series, even: pd.Series) -> pd.Series:
        k = np.searchsorted(at, codes.to_numpy(), side="right") - 1
        inside = at[k] == codes.to_numpy()
        byte = np.where(inside, off[k] + (even.to_numpy() * length[k]).astype(np.int64), off[k] + length[k] - 1)
        return pd.Series(np.minimum(byte.astype(object) * files // max(1, total), files - 1).astype(np.int32))

    even = F.pmod(F.xxhash64(F.monotonically_increasing_id(), *columns), F.lit(1 << 20)) / F.lit(1 << 20)
    placed = coded.withColumn("_file", place("_code", even)).repartitionById(files, "_file").sortWithinPartitions("_code")
    staged = storage.scratch(spark, "staged")
    placed.select(*columns).write.parquet(staged)
    want, got = digest(rows, columns), digest(spark.read.schema(rows.schema).parquet(staged), columns)
    if want != got:
        storage.remove(spark, staged)
        raise DigestMismatch(f"source rows {want}, written rows {got}")
    storage.publish(spark, staged, path)
    return Compacted(path, want[0], files)


def _no_constant(name: str) -> None:
    raise ValueError(name)


def readable(content: str | None) -> Any:
    """The value of a complete JSON text, numbers with a fraction as their text; None when it is unreadable."""
    if not content:
        return None
    try:
        return json.loads(content, parse_float=str, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None


def record_id(source: str | None, value: Any) -> str | None:
    """A ts with six decimals for messages, else a key in normal form; None for blank values and those that are neither text nor number."""
    if value is None or isinstance(value, (bool, list, dict)):
        return None
    text = str(value).strip()
    if (source or "").strip().lower() != "slack":
        return text.upper() or None
    try:
        return f"{Decimal(text):.6f}" if Decimal(text).is_finite() else text
    except InvalidOperation:
        return text or None


LANDED = "source string, target string, record_id string, file_id long, modified_at timestamp, content string"


def parse_landed(files: DataFrame) -> DataFrame:
    """Readable records and index entries of landed files.

    Columns: source, target, record_id, file_id, modified_at, content; the last
    three are null for entries of an index. Readable is one complete JSON
    object, alone or as the only element of an array; null, empty and cut
    contents and those with something after the value are not. Objects without
    a ts or key are no records. JSON is read once per row in Arrow batches: the
    built-in parsers accept text after a complete value.
    """
    kinds = to_arrow_schema(_parse_datatype_string(LANDED))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            at, ids, named, texts = [], [], [], []
            columns = [b.column(i).to_pylist() for i in (1, 3, 5)]
            for i, (source, path, content) in enumerate(zip(*columns)):
                value = readable(content)
                if value is None:
                    continue
                field = "ts" if (source or "").strip().lower() == "slack" else "key"
                name = (path or "").rpartition("/")[2].lower()
                if name.startswith("_index"):
                    entries = value.get("keys") if isinstance(value, dict) else value
                    found = [record_id(source, e) for e in entries] if isinstance(entries, list) else []
                    at += [i] * len(found)
                    ids += found
                    named += [True] * len(found)
                    texts += [None] * len(found)
                elif not name.startswith("_stats"):
                    text = content.strip()
                    if isinstance(value, list) and len(value) == 1:
                        value, text = value[0], text[1:-1].strip()
                    if isinstance(value, dict):
                        at.append(i)
                        ids.append(record_id(source, value.get(field)))
                        named.append(False)
                        texts.append(text)
            rows, by_index = b.take(pa.array(at, pa.int64())), pa.array(named, pa.bool_())
            only = lambda c, kind: pc.if_else(by_index, pa.scalar(None, kind), c.cast(kind))
            out = pa.RecordBatch.from_arrays(
                [rows.column(1), rows.column(2), pa.array(ids, pa.string()), only(rows.column(0), pa.int64()), only(rows.column(4), kinds.field("modified_at").type), pa.array(texts, pa.string())],
                names=kinds.names,
            )
            yield out.filter(out.column(2).is_valid())

    needed = files.select(F.col("file_id").cast("long").alias("file_id"), "source", "target", "path", "modified_at", "content")
    return storage.spread(needed).mapInArrow(batches, LANDED)


def ledger(records: DataFrame) -> DataFrame:
    """One row per record: source, target, record_id, copies, file_id, modified_at, content and its length of the copy modified last.

    Ties go to the greatest file_id, a null time is lowest. copies is 0 and
    file_id -1 where only an index names the record. Copies of one record
    combine before the shuffle.
    """
    best = F.max(F.when(F.col("file_id").isNotNull(), F.struct("modified_at", "file_id", "content"))).alias("best")
    return records.groupBy("source", "target", "record_id").agg(F.count("file_id").alias("copies"), best).select(
        "source", "target", "record_id", "copies", F.coalesce("best.file_id", F.lit(-1)).cast("long").alias("file_id"), "best.modified_at", "best.content", F.length("best.content").alias("chars")
    )


def compact_landed(files: DataFrame, path: str, file_bytes: int = 128 << 20) -> tuple[DataFrame, DataFrame]:
    """Compact landed files to `path`; returns the compacted records and the lost ones.

    The compacted table holds each readable record once, with the number of
    readable copies; the lost ones are named by an index and readable nowhere.
    Dimensions of the curve: target, order of the record (its ts, or the number
    in its key) and time of modification.
    """
    spark = files.sparkSession
    book, book_at = storage.materialise(ledger(parse_landed(files)), "ledger")
    order = F.coalesce(F.col("record_id").try_cast("double"), F.regexp_extract("record_id", r"(\d+)$", 1).try_cast("double"))
    group = F.pmod(F.xxhash64("source", "target"), F.lit(1 << 16))
    dims = [group, order, F.unix_micros("modified_at")]
    result = compact(book.where(F.col("copies") > 0), path, dims, F.col("chars"), file_bytes)
    kept = spark.read.schema(book.schema).parquet(result.path)
    return kept, book.where(F.col("copies") == 0)


def irregular(kept: DataFrame, lost: DataFrame) -> DataFrame:
    """Records without exactly one readable object: source, target, record_id, file_id (-1 for lost ones)."""
    columns = ["source", "target", "record_id", "file_id"]
    return reduce(DataFrame.unionByName, [kept.where(F.col("copies") > 1).select(*columns), lost.select(*columns)])
