"""A queryable catalog from nested statistics documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Columns of the catalog tables with their place in the statistics; names that start with total or count default to 0.
TABLES: dict[str, dict[str, str]] = {
    "github_repos": {
        "target_slug": "target_slug", "exported_at": "exported_at", "private": "repo.private", "stars": "repo.stars", "forks": "repo.forks", "open_issues": "repo.open_issues", "watchers": "repo.watchers", "total_contributors": "contributors.total", "total_commits": "commits.total", "commit_unique_authors": "commits.unique_authors",
        "total_prs": "pull_requests.total", "prs_open": "pull_requests.open", "prs_closed": "pull_requests.closed", "prs_merged": "pull_requests.merged", "total_reviews": "pull_requests.total_reviews", "total_review_comments": "pull_requests.total_review_comments", "total_comments": "pull_requests.total_comments", "total_additions": "pull_requests.total_additions", "total_deletions": "pull_requests.total_deletions", "total_changed_files": "pull_requests.total_changed_files",
    },
    "jira_projects": {
        "exported_at": "exported_at", "total_tickets": "tickets.total", "by_type": "tickets.by_type", "by_status": "tickets.by_status", "by_status_category": "tickets.by_status_category", "by_priority": "tickets.by_priority", "total_comments": "comments.total", "tickets_with_comments": "comments.tickets_with_comments",
        "total_attachments": "attachments.total", "total_attachment_size_bytes": "attachments.total_size_bytes", "attachments_by_mime_type": "attachments.by_mime_type", "total_changelog_entries": "changelog.total",
    },
    "slack_channels": {
        "channel_name": "channel.name", "is_private": "channel.is_private", "num_members": "channel.num_members", "exported_at": "exported_at", "total_messages": "messages.total", "thread_parents": "messages.thread_parents", "total_thread_replies": "messages.total_thread_replies", "with_reactions": "messages.with_reactions", "total_reactions": "messages.total_reactions",
        "by_subtype": "messages.by_subtype", "total_files": "files.total", "files_downloaded": "files.downloaded", "files_by_extension": "files.by_extension",
    },
    "google_users": {
        "target_slug": "target_slug", "exported_at": "exported_at", "gmail_messages": "gmail.total_messages", "gmail_size_bytes": "gmail.total_size_bytes", "gmail_attachments": "gmail.total_attachments", "gmail_messages_with_attachments": "gmail.messages_with_attachments", "gmail_attachments_by_extension": "gmail.attachments_by_extension",
        "calendar_events": "calendar.total_events", "calendar_with_attendees": "calendar.with_attendees", "calendar_with_location": "calendar.with_location", "drive_files": "drive.total_files", "drive_downloaded": "drive.downloaded", "drive_skipped": "drive.skipped", "drive_size_bytes": "drive.total_size_bytes", "drive_by_mime_type": "drive.by_mime_type",
    },
    "confluence_spaces": {
        "exported_at": "exported_at", "total_pages": "pages.total", "by_status": "pages.by_status", "total_comments": "comments.total", "pages_with_comments": "comments.pages_with_comments", "total_attachments": "attachments.total", "total_attachment_size_bytes": "attachments.total_size_bytes", "attachments_by_media_type": "attachments.by_media_type",
    },
}
#: Exporter of each table, and the count maps of file types: (exporter, category, place).
EXPORTERS = {"github": "github_repos", "jira": "jira_projects", "slack": "slack_channels", "google_workspace": "google_users", "confluence": "confluence_spaces"}
FILE_MAPS = [
    ("jira", "attachments", "attachments.by_mime_type"), ("slack", "files", "files.by_extension"), ("google_workspace", "gmail_attachments", "gmail.attachments_by_extension"), ("google_workspace", "drive", "drive.by_mime_type"), ("confluence", "attachments", "attachments.by_media_type"),
]


def _place(stats: DataFrame, path: str) -> tuple[Column, str] | None:
    """Column of a dotted path and its type; None where the schema has none."""
    kind = stats.schema
    for p in path.split("."):
        if not hasattr(kind, "fieldNames") or p not in kind.fieldNames():
            return None
        kind = kind[p].dataType
    return F.col(path), kind.typeName()


def table(stats: DataFrame, name: str) -> DataFrame:
    """One catalog table of the statistics documents of its exporter: target and its columns.

    Numbers missing in a document are 0, count maps empty, other fields null; a
    field no document has is there with its default.
    """
    columns = [F.col("target")]
    for out, path in TABLES[name].items():
        found = _place(stats, path)
        text = out in ("target_slug", "exported_at")
        if found is None:
            c = F.lit("") if text else F.create_map().cast("map<string,int>") if "by_" in out else F.lit(None).cast("string") if out in ("private", "is_private", "channel_name", "num_members") else F.lit(0).cast("long")
        elif found[1] == "map":
            c = F.coalesce(found[0].cast("map<string,int>"), F.create_map().cast("map<string,int>"))
        elif found[1] in ("long", "integer", "double") and out != "num_members":
            c = F.coalesce(found[0], F.lit(0))
        else:
            c = F.coalesce(found[0], F.lit("")) if text else found[0]
        columns.append(c.alias(out))
    return stats.select(*columns)


def languages(stats: DataFrame) -> DataFrame:
    """Languages of repositories: target, language, bytes, percentage."""
    return stats.select("target", F.explode("languages").alias("language", "info")).select("target", "language", F.coalesce("info.bytes", F.lit(0)).alias("bytes"), F.coalesce("info.percentage", F.lit(0.0)).alias("percentage"))


def file_types(stats: dict[str, DataFrame]) -> DataFrame:
    """Counts of file types over all exporters: exporter, target, category, file_type, count.

    stats: statistics documents by exporter; exporters that are missing or have no such map add nothing.
    """
    parts = []
    for exporter, category, path in FILE_MAPS:
        if exporter in stats and _place(stats[exporter], path):
            parts.append(stats[exporter].select(F.lit(exporter).alias("exporter"), "target", F.lit(category).alias("category"), F.explode(F.col(path)).alias("file_type", "count")))
    if not parts:
        raise ValueError("no exporter with file types among: " + ", ".join(stats))
    return reduce(DataFrame.unionByName, parts)


def summary(stats: dict[str, DataFrame], sums: dict[str, list[str]]) -> DataFrame:
    """Targets and sums of numbers per exporter as rows: exporter, measure, value; exporters without documents are left out."""
    parts = []
    for exporter, paths in sums.items():
        if exporter not in stats:
            continue
        totals = stats[exporter].agg(F.count(F.lit(1)).alias("targets"), *[F.sum(F.coalesce(F.col(p), F.lit(0))).alias(p.replace(".", "_")) for p in paths])
        names = ["targets", *[p.replace(".", "_") for p in paths]]
        parts.append(totals.select(F.lit(exporter).alias("exporter"), F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(n), F.coalesce(F.col(n), F.lit(0)).cast("long")) for n in names]))).alias("measure", "value")).where("measure <> 'targets' or value > 0"))
    return reduce(DataFrame.unionByName, parts)


def totals(parts: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of several tables, one under the other: part, n."""
    return reduce(DataFrame.unionAll, [df.groupBy(F.lit(name).alias("part")).agg(F.count(F.lit(1)).alias("n")) for name, df in parts.items()])


def ranked(rows: DataFrame, by: str, amount: Column) -> DataFrame:
    """Sums per group with their place by falling sum, ties by group: place, by, total. The groups are few: they are ranked together."""
    sums = rows.groupBy(by).agg(F.sum(amount).alias("total"))
    return sums.select(F.row_number().over(Window.orderBy(F.col("total").desc_nulls_last(), by)).alias("place"), by, "total")
