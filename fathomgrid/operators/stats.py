"""Statistics of exported items: always recomputed from the items, never counted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions.text import extension


def histogram(rows: DataFrame, value: Column, by: list[str] | None = None, default: str = "Unknown") -> DataFrame:
    """Counts of a value, blanks under a default name: by, value, n."""
    shown = F.when(F.coalesce(value, F.lit("")) == "", F.lit(default)).otherwise(value)
    return rows.groupBy(*(by or []), shown.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def count_map(rows: DataFrame, value: Column, by: list[str], out: str, default: str = "Unknown") -> DataFrame:
    """The same counts as a map per group. The map is as large as the number of distinct values; use histogram for ids."""
    return histogram(rows, value, by, default).groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias(out))


def length(array: str) -> Column:
    """Elements of an array that are not null; 0 for a null array."""
    return F.coalesce(F.size(F.filter(array, lambda x: x.isNotNull())), F.lit(0))


def ticket_stats(tickets: DataFrame, by: str) -> DataFrame:
    """Totals per target: tickets, comments, tickets with comments, attachments and their bytes, changes."""
    sizes = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["size"], F.lit(0)))
    return tickets.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_tickets"), F.sum(length("comments")).alias("total_comments"), F.count_if(length("comments") > 0).alias("tickets_with_comments"),
        F.sum(length("attachments")).alias("total_attachments"), F.sum(F.coalesce(sizes, F.lit(0))).alias("total_attachment_size_bytes"), F.sum(length("changelog")).alias("total_changelog_entries"),
    )


def message_stats(messages: DataFrame, by: str) -> DataFrame:
    """Totals per channel: messages, thread parents, with reactions, reactions, files.

    messages: thread_ts, reply_count, reactions (array of struct with count) and files (array), as far as the channel has them.
    """
    reacted = F.coalesce(F.aggregate("reactions", F.lit(0).cast("long"), lambda a, r: a + F.coalesce(r["count"], F.lit(0))), F.lit(0).cast("long"))
    parent = F.coalesce((F.col("reply_count") > 0) & (F.coalesce("thread_ts", F.lit("")) != ""), F.lit(False))
    return messages.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_messages"), F.count_if(parent).alias("thread_parents"), F.count_if(length("reactions") > 0).alias("with_reactions"), F.sum(reacted).alias("total_reactions"), F.sum(length("files")).alias("total_files")
    )


def commit_stats(commits: DataFrame, by: str, author: Column, at: Column) -> DataFrame:
    """Commits, distinct authors, first and last time per target."""
    return commits.groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count_distinct(author).alias("unique_authors"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def change_stats(requests: DataFrame, by: str) -> DataFrame:
    """Change requests per target by state (merged, open, closed) with the sums of their sizes.

    requests: merged_at, state, reviews, review_comments, comments (arrays), additions, deletions, changed_files.
    """
    merged = F.coalesce("merged_at", F.lit("")) != ""
    is_open = ~merged & (F.col("state") == "open")
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(f"total_{c}")
    return requests.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(merged).alias("merged"), F.count_if(is_open).alias("open"), F.count_if(~merged & ~F.coalesce(is_open, F.lit(False))).alias("closed"),
        *[F.sum(length(a)).alias(f"total_{a}") for a in ("reviews", "review_comments", "comments")], *map(total, ("additions", "deletions", "changed_files")),
    )


def file_endings(names: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Counts of lower-case extensions: by, value, n."""
    return names.groupBy(*by, extension(F.col(name)).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def mail_stats(mails: DataFrame, by: str) -> DataFrame:
    """Mails, their bytes, attachments and mails with attachments per user. mails: sizeEstimate, attachments (array)."""
    return mails.groupBy(by).agg(F.count(F.lit(1)).alias("total_messages"), F.sum(F.coalesce("sizeEstimate", F.lit(0))).alias("total_size_bytes"), F.sum(length("attachments")).alias("total_attachments"), F.count_if(length("attachments") > 0).alias("messages_with_attachments"))


def calendar_stats(events: DataFrame, by: str) -> DataFrame:
    """Events, those with attendees and those with a place per user. events: attendees (array), location."""
    return events.groupBy(by).agg(F.count(F.lit(1)).alias("total_events"), F.count_if(length("attendees") > 0).alias("with_attendees"), F.count_if(F.coalesce("location", F.lit("")) != "").alias("with_location"))


def drive_stats(files: DataFrame, by: str) -> DataFrame:
    """Files, downloaded, skipped and bytes per user. files: downloaded (boolean), size (text of a number)."""
    got = F.coalesce("downloaded", F.lit(False))
    return files.groupBy(by).agg(F.count(F.lit(1)).alias("total_files"), F.count_if(got).alias("downloaded"), F.count_if(~got).alias("skipped"), F.sum(F.coalesce(F.col("size").try_cast("long"), F.lit(0))).alias("total_size_bytes"))


def manifest(results: DataFrame) -> DataFrame:
    """Items per masker and overall (masker null): total, masked, skipped, failed. results: masker, status.

    A status that begins with ok counts as masked, skipped as skipped, all else as failed.
    """
    status = F.coalesce("status", F.lit(""))
    return results.rollup("masker").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(status.startswith("ok")).alias("masked"), F.count_if(status == "skipped").alias("skipped"), F.count_if(~status.startswith("ok") & (status != "skipped")).alias("failed")
    )


def timing(runs: DataFrame, by: str, seconds: str) -> DataFrame:
    """Mean and sample deviation of run times and items per second per group."""
    return runs.groupBy(by).agg(F.count(F.lit(1)).alias("runs"), F.round(F.avg(seconds), 6).alias("mean_s"), F.round(F.stddev_samp(seconds), 6).alias("stdev_s"), F.round(F.lit(1.0) / F.avg(seconds), 6).alias("per_second"))


def page_stats(pages: DataFrame, by: str) -> DataFrame:
    """Pages, comments and pages with comments, attachments got and failed with their bytes per space.

    pages: comments (array), attachments (array of struct with size and failed).
    """
    got = lambda a: F.filter(a, lambda x: x.isNotNull() & ~F.coalesce(x["failed"], F.lit(False)))
    size = F.aggregate(got(F.col("attachments")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["size"], F.lit(0)))
    zero = F.lit(0)
    return pages.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_pages"), F.sum(length("comments")).alias("total_comments"), F.count_if(length("comments") > 0).alias("pages_with_comments"), F.sum(F.coalesce(F.size(got(F.col("attachments"))), zero)).alias("total_attachments"),
        F.sum(length("attachments") - F.coalesce(F.size(got(F.col("attachments"))), zero)).alias("failed_attachments"), F.sum(F.coalesce(size, zero)).alias("total_attachment_size_bytes"),
    )


def day_stats(days: DataFrame) -> DataFrame:
    """Days exported, rows and bytes of day tables. days: day, rows, bytes; days without rows were not exported."""
    return days.where("rows is not null").agg(F.count(F.lit(1)).alias("days_exported"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"))


def comment_stats(items: DataFrame, by: str) -> DataFrame:
    """Comments and items with comments per target."""
    return items.groupBy(by).agg(F.sum(length("comments")).alias("total"), F.count_if(length("comments") > 0).alias("items_with_comments"))


def nested(**values: Column) -> Column:
    """A statistics document of dotted paths (written with two underscores) and values."""
    tree: dict = {}
    for path, value in values.items():
        *way, last = path.split("__")
        at = tree
        for name in way:
            at = at.setdefault(name, {})
        at[last] = value

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(n) for n, v in node.items()])

    return build(tree)
