"""Checks of masked output: leaked values, unreadable texts, broken structure, leaking keys."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomgrid import storage
from fathomgrid.functions.text import holds_domain
from fathomgrid.operators.compaction import readable
from fathomgrid.operators.documents import read_mail
from fathomgrid.operators.sampling import rank_key

#: Most values that travel to the tasks as one dictionary; larger sets are joined by the hashes of their first GRAM characters.
BLOCK = 200_000
#: Characters of a value by which it is joined, and bits of the filter over them as a power of two (8 MB).
GRAM, FILTER = 5, 26


def leak_values(entries: DataFrame) -> DataFrame:
    """Values whose appearance is a leak: kind, value (lower case).

    entries: entity_type, real_value, source. Addresses of imported people from
    five characters, names from eight with a space, other identifiers from five.
    """
    v, kind = F.col("real_value"), F.col("entity_type")
    mail = (kind == "EMAIL_ADDRESS") & (F.col("source") == "roster_import") & (F.length(v) >= 5)
    name = (kind == "PERSON") & (F.length(v) >= 8) & F.contains(v, F.lit(" "))
    other = kind.isin("IN_PAN", "IN_AADHAAR", "PHONE_NUMBER", "CREDIT_CARD", "IN_UPI_ID", "IN_BANK_ACCOUNT", "US_SSN") & (F.length(v) >= 5)
    return entries.where(mail | name | other).select(F.when(mail, "email").when(name, "name").otherwise("id").alias("kind"), F.lower(v).alias("value")).distinct()


class _Finder:
    """Multi-pattern search: an Aho-Corasick automaton, or plain search where that library is missing."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.rows = rows
        try:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for kind, value in rows:
                old = self.automaton.get(value, [])
                self.automaton.add_word(value, [*old, kind])
            self.automaton.make_automaton() if rows else None
        except ImportError:
            self.automaton = None

    def hits(self, low: str) -> Iterator[tuple[str, str, int]]:
        if not self.rows:
            return
        if self.automaton is not None:
            for end, kinds in self.automaton.iter(low):
                yield from ((k, "", end + 1) for k in kinds)
            return
        for kind, value in self.rows:
            at = low.find(value)
            while at >= 0:
                yield kind, value, at + len(value)
                at = low.find(value, at + 1)


def lowered(text: str) -> str:
    """Lower case character by character, so that places hold for letters whose lower case is longer."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _grams(text: str) -> np.ndarray:
    """Hashes of the runs of GRAM characters of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < GRAM:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(codes) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - GRAM + 1 + i]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def leaks(texts: DataFrame, key: str, text: str, values: DataFrame, context: int = 30) -> DataFrame:
    """Values found in texts, each once per text: key, kind, value, at, context.

    Names count only between characters that are neither letters nor digits,
    other kinds anywhere; case is ignored. `at` is the first place. Up to BLOCK
    values go to the tasks as one dictionary. More of them are joined: one pass
    over the texts gives the places where a value can begin, by a bit filter of
    fixed size over the first characters of all values, and the join by those
    characters decides; only values shorter than that go in blocks.
    """
    clean = values.select("kind", "value").where(F.col("value") != "").distinct()
    if clean.limit(BLOCK + 1).count() <= BLOCK:
        return _dictionary_leaks(texts, key, text, clean, context)
    short = F.length("value") < GRAM
    joined = _joined_leaks(texts, key, text, clean.where(~short), context)
    return joined.unionByName(_dictionary_leaks(texts, key, text, clean.where(short), context))


def _joined_leaks(texts: DataFrame, key: str, text: str, values: DataFrame, context: int) -> DataFrame:
    spark = texts.sparkSession

    def coded(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            own = [int(_grams(v[:GRAM]).view(np.int64)[0]) for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.int64())], names=["kind", "value", "gram"])

    known, _ = storage.materialise(values.mapInArrow(coded, "kind string, value string, gram long"), "leak-values")
    place = F.shiftrightunsigned("gram", 64 - FILTER)
    words = known.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER - 6), np.uint64)
    bits[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    shared, longest = spark.sparkContext.broadcast(bits), int(known.agg(F.max(F.length("value"))).first()[0] or 0)
    schema = f"{key} {dict(texts.dtypes)[key]}, row long, at int, gram long, piece string, around string"

    def places(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in it:
            rows, out = [], []
            for i, (row, t) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                if not t:
                    continue
                low = lowered(t)
                h = _grams(low)
                p = h >> np.uint64(64 - FILTER)
                for at in np.flatnonzero((table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).tolist():
                    rows.append(i)
                    out.append((row, at, int(h[at : at + 1].view(np.int64)[0]), (low[at - 1] if at else " ") + low[at : at + longest] + (low[at + longest : at + longest + 1] or " "), t[max(0, at - context) : at + longest + context]))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))], names=[key, "row", "at", "gram", "piece", "around"])

    found = texts.select(key, F.monotonically_increasing_id().alias("row"), text).mapInArrow(places, schema).join(known, "gram")
    n = F.length("value")
    alone = ~F.substring("piece", 1, 1).rlike(r"[\p{L}\p{N}]") & ~F.substring("piece", n + 2, F.lit(1)).rlike(r"[\p{L}\p{N}]")
    hits = found.where((F.substring("piece", F.lit(2), n) == F.col("value")) & ((F.col("kind") != "name") | alone))
    around = F.substring("around", F.lit(1), F.least("at", F.lit(context)) + n + F.lit(context))
    first = hits.groupBy("row", key, "kind", "value").agg(F.min(F.struct("at", around.alias("context"))).alias("f"))
    return first.select(key, "kind", "value", "f.at", "f.context")


def _dictionary_leaks(texts: DataFrame, key: str, text: str, values: DataFrame, context: int) -> DataFrame:
    """Values in blocks, each as one automaton against all texts."""
    spark = texts.sparkSession
    schema = f"{key} {dict(texts.dtypes)[key]}, kind string, value string, at int, context string"
    source = values.select("kind", "value").toLocalIterator()
    found: DataFrame | None = None
    while rows := [(r[0], r[1]) for r in islice(source, BLOCK)]:
        shared = spark.sparkContext.broadcast(rows)

        def batches(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            by_value: dict[str, list[str]] = {}
            for kind, value in shared.value:
                by_value.setdefault(value, []).append(kind)
            finder = _Finder([("|".join(k), v) for v, k in by_value.items()])
            lengths = sorted({len(v) for v in by_value}, reverse=True)
            for b in it:
                at, kinds, vals, places, contexts = [], [], [], [], []
                for i, t in enumerate(b.column(1).to_pylist()):
                    if not t:
                        continue
                    low = lowered(t)
                    seen = set()
                    for _, value, end in finder.hits(low):
                        for n in [len(value)] if value else lengths:
                            v = low[end - n : end] if n <= end else ""
                            for kind in by_value.get(v, ()):
                                start = end - n
                                if kind == "name" and (start > 0 and low[start - 1].isalnum() or end < len(low) and low[end].isalnum()):
                                    continue
                                if (kind, v) not in seen:
                                    seen.add((kind, v))
                                    at.append(i)
                                    kinds.append(kind)
                                    vals.append(v)
                                    places.append(start)
                                    contexts.append(t[max(0, start - context) : end + context])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()), pa.array(vals, pa.string()), pa.array(places, pa.int32()), pa.array(contexts, pa.string())], names=[key, "kind", "value", "at", "context"])

        part = texts.select(key, text).mapInArrow(batches, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def unreadable(text: Column) -> Column:
    """Whether a trimmed text is nothing but a long run of hexadecimal digits."""
    return F.trim(text).rlike("^(?i)[0-9a-f]{20,}$")


def broken_json(files: DataFrame, key: str, content: str) -> DataFrame:
    """Rows whose content is no complete JSON text: key. Null and empty contents count as broken."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            bad = [readable(t) is None and (t or "").strip() != "null" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(bad, pa.bool_()))], names=[key])

    return files.select(key, content).mapInArrow(batches, f"{key} {dict(files.dtypes)[key]}")


def report(findings: DataFrame, checks: list[str], most: int = 200) -> DataFrame:
    """One row per check: findings, distinct files, whether it passed, and up to `most` examples.

    findings: check, file, value. Examples are the smallest by file and value,
    kept by a bounded top-k per task before the shuffle.
    """
    salted = findings.withColumn("_s", F.pmod(F.xxhash64("file", "value"), F.lit(64)))
    first = F.row_number().over(Window.partitionBy("check", "_s").orderBy("file", "value"))
    few = salted.withColumn("_r", first).where(F.col("_r") <= most)
    top = few.groupBy("check").agg(F.slice(F.array_sort(F.collect_list(F.struct("file", "value"))), 1, most).alias("examples"))
    counts = findings.groupBy("check").agg(F.count(F.lit(1)).alias("findings"), F.count_distinct("file").alias("files"))
    every = findings.sparkSession.createDataFrame([(c,) for c in checks], "check string")
    return every.join(counts, "check", "left").join(top, "check", "left").select(
        "check", F.coalesce("findings", F.lit(0)).alias("findings"), F.coalesce("files", F.lit(0)).alias("files"), (F.coalesce("findings", F.lit(0)) == 0).alias("passed"), F.coalesce("examples", F.array().cast("array<struct<file:string,value:string>>")).alias("examples")
    )


def leaking_keys(keys: DataFrame, key: str, domains: list[str]) -> DataFrame:
    """Keys that still name a real domain."""
    return keys.where(holds_domain(F.col(key), domains)).select(key)


def broken_mail(mails: DataFrame, key: str, content: str) -> DataFrame:
    """Mails without any header or body that can be read: key. Null and empty contents count as broken."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            parts = [read_mail(raw) for raw in b.column(1).to_pylist()]
            bad = [p["error"] is not None or not (p["subject"] or p["sender"] or p["recipients"]) for p in parts]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(bad, pa.bool_()))], names=[key])

    return mails.select(key, F.col(content).cast("binary")).mapInArrow(batches, f"{key} {dict(mails.dtypes)[key]}")


def audit_sample(files: DataFrame, key: str, content: str, most: int = 100, chars: int = 8000, seed: int = 42) -> DataFrame:
    """A sample of files for a reader's audit: key and the beginning of the content. The sample is the same for the same seed."""
    drawn = files.where(F.coalesce(content, F.lit("")) != "").orderBy(rank_key(seed, key)).limit(most)
    return drawn.select(key, F.substring(content, 1, chars).alias("excerpt"))


def audit_findings(answers: DataFrame, key: str, answer: str) -> DataFrame:
    """Findings in a reader's answers, the first JSON array in each: key, type, value, context. Answers without a readable array give none."""
    array = F.regexp_extract(answer, r"(?s)\[.*\]", 0)
    found = F.from_json(array, "array<struct<type:string,value:string,context:string>>")
    return answers.select(key, F.explode(found).alias("f")).select(key, "f.*").where(F.coalesce("value", F.lit("")) != "")
