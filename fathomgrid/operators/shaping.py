"""Projections and reshaping of exported records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomgrid.functions.text import percentage
from fathomgrid.operators.nested import load_document


def shares(rows: DataFrame, by: list[str], part: str, amount: Column) -> DataFrame:
    """Amounts and percentages of parts within a group: by, part, amount, percentage.

    Amounts are summed per part first, so the window sees one row per part.
    """
    sums = rows.groupBy(*by, part).agg(F.sum(amount).alias("amount"))
    return sums.withColumn("percentage", percentage(F.col("amount"), F.sum("amount").over(Window.partitionBy(*by))))


def person(value: Column) -> Column:
    """Display name, address and account id of a nested user; blanks where it is missing."""
    return F.struct(*[F.coalesce(value[f], F.lit("")).alias(n) for f, n in (("displayName", "name"), ("emailAddress", "email"), ("accountId", "account_id"))])


def commit(c: Column) -> Column:
    """A commit document flattened: sha, message, author and committer with their logins, parents."""
    inner = c["commit"]
    fields = [c["sha"].alias("sha"), inner["message"].alias("message")]
    for role in ("author", "committer"):
        fields += [inner[role]["name"].alias(f"{role}_name"), inner[role]["email"].alias(f"{role}_email"), c[role]["login"].alias(f"{role}_login"), inner[role]["date"].alias(f"{role}_date")]
    return F.struct(*fields, F.transform(c["parents"], lambda p: p["sha"]).alias("parents"))


def embed(parents: DataFrame, children: DataFrame, key: str, name: str, order: str, most: int | None = None) -> DataFrame:
    """Parents with their children as an ordered array; parents without any have an empty one.

    A document holds its own children, so the array is as large as that
    document. Where a key may gather without bound give `most`: then the first
    children by order are embedded and `<name>_total` has the number of all.
    """
    fields = [c for c in children.columns if c != key]
    kept = children
    if most is not None:
        kept = children.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_r") <= most).drop("_r")
    arrays = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias(name))
    out = parents.join(arrays, key, "left")
    empty = F.array().cast(dict(arrays.dtypes)[name])
    out = out.withColumn(name, F.coalesce(name, empty))
    if most is not None:
        out = out.join(children.groupBy(key).agg(F.count(F.lit(1)).alias(f"{name}_total")), key, "left").withColumn(f"{name}_total", F.coalesce(f"{name}_total", F.lit(0)))
    return out


def thread_replies(messages: DataFrame, by: str) -> DataFrame:
    """Parents of threads with their replies in `_replies`, by time: by, ts and the other columns.

    messages: by, file_id, ts, thread_ts, parent_user_id and more. A message
    that is its own thread's parent is no reply unless it has parent_user_id.
    Replies without a landed parent have nowhere to go.
    """
    own = (F.col("ts") == F.col("thread_ts")) & (F.coalesce("parent_user_id", F.lit("")) == "")
    replies = messages.where(F.col("thread_ts").isNotNull() & ~F.coalesce(own, F.lit(False)))
    fields = [c for c in messages.columns if c not in (by, "ts", "file_id")]
    arrays = replies.groupBy(by, F.col("thread_ts").alias("_ts")).agg(F.array_sort(F.collect_list(F.struct("ts", "file_id", *fields))).alias("_replies"))
    return messages.join(arrays.withColumnRenamed("_ts", "ts"), [by, "ts"])


def custom_fields(rows: DataFrame, key: str, fields: str) -> DataFrame:
    """Custom fields as rows: key, field, value."""
    return rows.select(key, F.explode(fields).alias("field", "value"))


def named_fields(raw: DataFrame, key: str, fields: str, names: DataFrame) -> DataFrame:
    """Raw custom fields under readable names: key, map of `Custom field (Name)`; unknown ids keep their id.

    raw: a map of field id to JSON text; objects give their value, name or
    displayName, lists their elements joined by commas. names: id, name.
    """
    flat = raw.select(key, F.explode(fields).alias("id", "json")).join(names.select("id", "name"), "id", "left")
    text = F.when(F.col("json").startswith("["), F.array_join(F.from_json("json", "array<string>"), ", ")).when(
        F.col("json").startswith("{"), F.coalesce(*[F.when(F.get_json_object("json", f"$.{f}") != "", F.get_json_object("json", f"$.{f}")) for f in ("value", "name", "displayName")], F.col("json"))
    ).otherwise(F.regexp_replace("json", '^"|"$', ""))
    label = F.concat(F.lit("Custom field ("), F.coalesce("name", "id"), F.lit(")"))
    return flat.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(label.alias("k"), text.alias("v"))))).alias("custom_fields"))


def changelog(histories: Column) -> Column:
    """Changes of nested histories as one flat array: date, author, field, from, to."""
    return F.flatten(F.transform(histories, lambda h: F.transform(h["items"], lambda i: F.struct(h["created"].alias("date"), h["author"]["displayName"].alias("author"), i["field"].alias("field"), i["fromString"].alias("from"), i["toString"].alias("to")))))


def document_text(value: Column) -> Column:
    """Plain text of rich-text JSON: texts, mentions by name, breaks as lines; null where unreadable."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def text(raw: str | None) -> str | None:
            document = load_document(raw)
            if document is None:
                return None
            out, stack = [], [document]
            while stack:
                node = stack.pop()
                if not isinstance(node, dict):
                    continue
                kind, attrs = node.get("type"), node.get("attrs") or {}
                if kind == "text":
                    out.append(str(node.get("text", "")))
                elif kind == "mention":
                    out.append(str(attrs.get("text") or attrs.get("id") or ""))
                elif kind == "hardBreak":
                    out.append("\n")
                inner = node.get("content")
                if isinstance(inner, list):
                    stack.extend(inner[::-1])
            return "".join(out).encode("utf-8", "replace").decode()

        for b in batches:
            yield b.map(text)

    return extract(value)


def page_body(body: Column, kinds: tuple[str, ...] = ("storage", "atlas_doc_format", "view")) -> Column:
    """The first body of a page that is there, by preference."""
    return F.coalesce(*[body[k]["value"] for k in kinds])


def with_local_files(messages: DataFrame, downloads: DataFrame) -> DataFrame:
    """Messages whose files know their local copy, by message and file id. downloads: ts, file_id, local_file."""
    per = downloads.groupBy("ts").agg(F.map_from_entries(F.collect_set(F.struct("file_id", "local_file"))).alias("_local"))
    files = F.transform("files", lambda f: f.withField("_local_file", F.try_element_at("_local", f["id"])))
    return messages.join(per, "ts", "left").withColumn("files", files).drop("_local")


def status_rows(checkpoints: DataFrame) -> DataFrame:
    """Exporter and target of jobs with their status: the job id split at its first slash, __ as / for repositories."""
    exporter, rest = F.split_part("job_id", F.lit("/"), F.lit(1)), F.regexp_replace("job_id", "^[^/]*/?", "")
    target = F.when(rest == "", "—").when(exporter == "github", F.replace(rest, F.lit("__"), F.lit("/"))).otherwise(rest)
    return checkpoints.select(exporter.alias("exporter"), target.alias("target"), F.coalesce("status", F.lit("unknown")).alias("status"), "phases")


def phase_summary(phases: Column) -> Column:
    """`no phases`, `n/n complete`, or the phases done of all with the first unfinished one by name."""
    entries = F.array_sort(F.map_entries(phases))
    done = F.size(F.filter(entries, lambda e: e["value"]["status"] == "completed"))
    now = F.get(F.filter(entries, lambda e: F.coalesce(e["value"]["status"], F.lit("")) != "completed"), F.lit(0))["key"]
    total = F.size(entries)
    return F.when(phases.isNull() | (F.size(phases) == 0), "no phases").when(done == total, F.format_string("%d/%d complete", total, total)).otherwise(F.format_string("%d/%d (%s)", done, total, now))


def lines_of_words(words: DataFrame) -> DataFrame:
    """Recognised words joined to lines: block_num, par_num, line_num, text; blank words and those without confidence are left out."""
    kept = words.where((F.trim("text") != "") & (F.col("conf") >= 0))
    return kept.groupBy("image", "block_num", "par_num", "line_num").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("left", "text"))), lambda w: w["text"]), " ").alias("text"))


def changed_boxes(words: DataFrame, lines: DataFrame) -> DataFrame:
    """Boxes of words that are no longer in their scanned line, with a margin. lines: the keys of a line and its scanned text `masked`."""
    keys = ["image", "block_num", "par_num", "line_num"]
    gone = words.where((F.trim("text") != "") & (F.col("conf") >= 0)).join(lines.select(*keys, "masked"), keys).where(~F.contains(F.lower("masked"), F.lower("text")))
    pad = F.greatest(F.floor(F.col("height") / 4), F.lit(2))
    return gone.select(*keys, "text", F.greatest(F.col("left") - pad, F.lit(0)).alias("x0"), F.greatest(F.col("top") - pad, F.lit(0)).alias("y0"), (F.col("left") + F.col("width") + pad).alias("x1"), (F.col("top") + F.col("height") + pad).alias("y1"))
