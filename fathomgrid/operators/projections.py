"""Raw documents of exported services to flat records: schemas of what arrives, and projections of it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions import text
from fathomgrid.operators.documents import read_mail
from fathomgrid.operators.shaping import changelog, page_body

# The parts of raw documents that are read; other fields are ignored.
_USER = "struct<displayName:string,emailAddress:string,accountId:string>"
_NAMED = "struct<name:string>"
TICKET = (
    "key string, id string, self string, changelog struct<histories:array<struct<created:string,author:struct<displayName:string>,items:array<struct<field:string,fromString:string,toString:string>>>>>, "
    f"fields struct<summary:string,description:string,issuetype:{_NAMED},status:struct<name:string,statusCategory:{_NAMED}>,priority:{_NAMED},resolution:{_NAMED},project:struct<key:string,name:string>,created:string,updated:string,resolutiondate:string,duedate:string,"
    f"assignee:{_USER},reporter:{_USER},creator:{_USER},labels:array<string>,components:array<{_NAMED}>,fixVersions:array<{_NAMED}>,versions:array<{_NAMED}>,sprint:{_NAMED},parent:struct<key:string,fields:struct<summary:string>>,"
    f"timeoriginalestimate:string,timeestimate:string,timespent:string,votes:struct<votes:long>,watches:struct<watchCount:long>,attachment:array<struct<id:string,filename:string,size:long,mimeType:string,created:string,author:{_USER},content:string>>>"
)
CONTRIBUTOR = "login string, id long, type string, contributions long, html_url string"
_SIGNED = "struct<name:string,email:string,date:string>"
COMMIT = (
    f"sha string, html_url string, commit struct<message:string,author:{_SIGNED},committer:{_SIGNED}>, author struct<login:string>, committer struct<login:string>, parents array<struct<sha:string>>, "
    "stats struct<additions:long,deletions:long,total:long>, files array<struct<filename:string,status:string,additions:long,deletions:long,patch:string>>"
)
REPOSITORY = (
    "full_name string, description string, private boolean, default_branch string, created_at string, updated_at string, pushed_at string, stargazers_count long, forks_count long, open_issues_count long, watchers_count long, "
    "topics array<string>, license string, languages map<string,long>"
)
_BODY = "struct<storage:struct<value:string>,atlas_doc_format:struct<value:string>,view:struct<value:string>>"
PAGE = f"id string, title string, spaceId string, status string, createdAt string, authorId string, parentId string, parentType string, position long, version struct<number:long>, body {_BODY}"
PAGE_COMMENT = f"id string, authorId string, createdAt string, version struct<number:long>, body {_BODY}"
MAIL = "id string, threadId string, labelIds array<string>, snippet string, internalDate string, sizeEstimate long, raw string"
DRIVE = "id string, name string, mimeType string, size string, modifiedTime string, owners array<struct<displayName:string,emailAddress:string>>"


def parsed(raw: DataFrame, column: str, schema: str) -> DataFrame:
    """Raw JSON documents by a schema in `doc`, the column aside; broken documents have nulls only."""
    return raw.withColumn("doc", F.from_json(column, schema)).drop(column)


def _names(array: Column) -> Column:
    return F.coalesce(F.transform(array, lambda x: x["name"]), F.array().cast("array<string>"))


def ticket(doc: Column) -> list[Column]:
    """Columns of a flat ticket record. Missing parts of a raw document give nulls, missing lists empty ones, missing counts 0."""
    f = doc["fields"]
    people = []
    for role in ("assignee", "reporter", "creator"):
        people += [f[role][n].alias(role + end) for n, end in (("displayName", ""), ("emailAddress", "_email"), ("accountId", "_account_id"))]
    attachments = F.transform(f["attachment"], lambda a: F.struct(a["id"].alias("id"), a["filename"].alias("filename"), a["size"].alias("size"), a["mimeType"].alias("mime_type"), a["created"].alias("created"), a["author"]["displayName"].alias("author"), a["author"]["emailAddress"].alias("author_email"), a["content"].alias("content_url")))
    changes = changelog(doc["changelog"]["histories"])
    return [
        doc["key"].alias("key"), doc["id"].alias("id"), doc["self"].alias("self"), f["summary"].alias("summary"), f["description"].alias("description_adf"), f["issuetype"]["name"].alias("issue_type"), f["status"]["name"].alias("status"), f["status"]["statusCategory"]["name"].alias("status_category"),
        f["priority"]["name"].alias("priority"), f["resolution"]["name"].alias("resolution"), f["project"]["key"].alias("project_key"), f["project"]["name"].alias("project_name"), f["created"].alias("created"), f["updated"].alias("updated"), f["resolutiondate"].alias("resolved"), f["duedate"].alias("due_date"), *people,
        F.coalesce(f["labels"], F.array().cast("array<string>")).alias("labels"), _names(f["components"]).alias("components"), _names(f["fixVersions"]).alias("fix_versions"), _names(f["versions"]).alias("affected_versions"), f["sprint"]["name"].alias("sprint"), f["parent"]["key"].alias("parent_key"), f["parent"]["fields"]["summary"].alias("parent_summary"),
        *[F.coalesce(f[raw], F.lit("")).alias(out) for raw, out in (("timeoriginalestimate", "original_estimate"), ("timeestimate", "remaining_estimate"), ("timespent", "time_spent"))], F.coalesce(f["votes"]["votes"], F.lit(0)).alias("votes"), F.coalesce(f["watches"]["watchCount"], F.lit(0)).alias("watchers"),
        F.coalesce(attachments, F.slice(attachments, 1, 0)).alias("attachments"), changes.alias("changelog"),
    ]


def contributor(doc: Column) -> list[Column]:
    return [doc["login"].alias("login"), doc["id"].alias("id"), doc["type"].alias("type"), doc["contributions"].alias("contributions"), doc["html_url"].alias("profile_url")]


def repository(doc: Column) -> list[Column]:
    """Metadata of a repository with the share of each language as a map of bytes and percentage."""
    plain = ("full_name", "description", "private", "default_branch", "created_at", "updated_at", "pushed_at", "stargazers_count", "forks_count", "open_issues_count", "watchers_count")
    total = F.aggregate(F.map_values(doc["languages"]), F.lit(0).cast("long"), lambda a, b: a + b)
    share = F.transform_values(doc["languages"], lambda _, b: F.struct(b.alias("bytes"), text.percentage(b, total).alias("percentage")))
    return [*[doc[n].alias(n) for n in plain], F.coalesce(doc["topics"], F.array().cast("array<string>")).alias("topics"), doc["license"].alias("license"), share.alias("language_breakdown")]


def page(doc: Column, space_key: Column, body_format: Column) -> list[Column]:
    """Columns of a wiki page; its body is the first that is there of stored, document and shown form."""
    named = {"id": "id", "title": "title", "spaceId": "space_id", "status": "status", "createdAt": "created_at", "authorId": "author_id", "parentId": "parent_id", "parentType": "parent_type", "position": "position"}
    return [*[doc[raw].alias(out) for raw, out in named.items()], doc["version"]["number"].alias("version"), page_body(doc["body"]).alias("body"), space_key.alias("space_key"), body_format.alias("body_format")]


def page_comment(doc: Column) -> list[Column]:
    return [doc["id"].alias("id"), doc["authorId"].alias("author_id"), doc["createdAt"].alias("created_at"), doc["version"]["number"].alias("version"), page_body(doc["body"]).alias("body")]


def mail_entry(doc: Column) -> list[Column]:
    """Index entry of a mail: ids, labels, snippet, times, size, and the names of the attachments in the raw message."""

    @F.pandas_udf("array<string>")
    def attachments(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda raw: read_mail(raw)["attachments"])

    return [
        doc["id"].alias("id"), doc["threadId"].alias("threadId"), F.coalesce(doc["labelIds"], F.array().cast("array<string>")).alias("labelIds"), F.coalesce(doc["snippet"], F.lit("")).alias("snippet"), doc["internalDate"].alias("internalDate"), doc["sizeEstimate"].alias("sizeEstimate"),
        attachments(text.base64url(doc["raw"])).alias("attachments"),
    ]


def drive_entry(doc: Column, downloaded: Column, reason: Column) -> list[Column]:
    """Index entry of a stored file: what it is, its owners, whether it was downloaded and if not why."""
    plain = ("id", "name", "mimeType", "size", "modifiedTime")
    return [*[doc[n].alias(n) for n in plain], F.coalesce(doc["owners"], F.slice(doc["owners"], 1, 0)).alias("owners"), downloaded.alias("downloaded"), F.when(F.coalesce(reason, F.lit("")) != "", reason).alias("skip_reason")]


def top_contributors(rows: DataFrame) -> DataFrame:
    """Contributors of a repository by falling contributions, ties by login."""
    return rows.orderBy(F.col("contributions").desc_nulls_last(), "login")


# The order in which each kind of item is listed.
LISTING_ORDER = {"pull_requests": ("updated_at", True), "tickets": ("created", True), "calendar": ("start", False), "drive": ("modifiedTime", True), "pages": ("created_at", True)}


def listed(rows: DataFrame, kind: str, most: int = 0) -> DataFrame:
    """Items of a kind in the order in which its service lists them; of a limit the first ones, 0 for all."""
    column, falling = LISTING_ORDER[kind]
    ordered = rows.orderBy(F.col(column).desc_nulls_last() if falling else F.col(column).asc_nulls_last())
    return ordered.limit(most) if most else ordered
