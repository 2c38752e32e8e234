"""User directories of the services: who counts as a person, in one form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Raw directory documents by service, and the account that is no person.
SCHEMAS = {
    "github": "login string, name string, email string",
    "jira": "accountId string, accountType string, displayName string, emailAddress string, active boolean",
    "slack": "id string, name string, deleted boolean, is_bot boolean, profile struct<email:string,real_name:string,display_name:string>",
    "google": "primaryEmail string, suspended boolean, name struct<givenName:string,familyName:string,fullName:string>",
}
NO_PERSON = "USLACKBOT"
USER = ("email", "name", "first_name", "last_name", "github_login", "slack_user_id", "slack_username", "slack_display_name", "jira_account_id", "jira_display_name")


class EmptyDirectory(RuntimeError):
    """A directory without any person: a roster built without it would miss people."""


def _record(service: str, **fields: Column) -> list[Column]:
    blank = F.lit("")
    return [F.coalesce(fields.get(n, blank), blank).alias(n) for n in USER] + [F.array(F.lit(service)).alias("sources")]


def users(raw: DataFrame, service: str, column: str = "content") -> DataFrame:
    """People of a directory of raw JSON documents, in the form of person records; broken documents are nobody.

    Jira: accounts of people, no apps. Chat: neither bots, nor the service's own
    account, nor deleted ones. Mail: those not suspended.
    """
    d = raw.select(F.from_json(column, SCHEMAS[service]).alias("d")).where("d is not null").select("d.*")
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    if service == "github":
        return d.where("login <> ''").select(*_record("github", email=F.col("email"), name=F.col("name"), github_login=F.col("login")))
    if service == "jira":
        return d.where("accountType = 'atlassian' and accountId <> ''").select(*_record("jira", email=F.col("emailAddress"), name=F.col("displayName"), jira_account_id=F.col("accountId"), jira_display_name=F.col("displayName")))
    if service == "slack":
        people = d.where(no("is_bot") & no("deleted") & (F.col("id") != NO_PERSON))
        return people.select(*_record("slack", email=F.col("profile.email"), name=F.col("profile.real_name"), slack_user_id=F.col("id"), slack_username=F.col("name"), slack_display_name=F.col("profile.display_name")))
    n = F.col("name")
    return d.where(no("suspended") & (F.col("primaryEmail") != "")).select(*_record("google", email=F.col("primaryEmail"), name=n["fullName"], first_name=n["givenName"], last_name=n["familyName"]))


def all_users(directories: dict[str, DataFrame], column: str = "content") -> DataFrame:
    """People of all directories, one under the other. A directory without people is an error, as a failed listing looks the same."""
    parts = {s: users(raw, s, column) for s, raw in directories.items()}
    empty = [s for s, p in parts.items() if p.isEmpty()]
    if empty:
        raise EmptyDirectory(f"no people in {', '.join(empty)}")
    return reduce(DataFrame.unionByName, parts.values())
