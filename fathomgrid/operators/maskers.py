"""Registry of maskers: which items of a source are masked how, and where they go."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.functions import hashing, rewriting, text
from fathomgrid.operators import masking
from fathomgrid.sources.landed import is_office, should_process

Rules = dict[str, Callable[[Column], Column]]


@dataclass
class Masker:
    """A source's masker: key prefix, rules by kind of item, how its keys are rewritten."""

    source: str
    prefix: str
    rules: Callable[[str], Rules]
    other: Callable[[Column], Column] | None = None
    literals: list[tuple[str, str]] = field(default_factory=list)

    def wants(self, key: Column) -> Column:
        return key.startswith(self.prefix) & should_process(key)

    def rewrite(self, key: Column) -> Column:
        """Keys with the masked domain in place of the real one."""
        return text.literal_chain(key, self.literals)

    def mask(self, items: DataFrame, domain: str) -> DataFrame:
        """Items by the source's rules; rules for columns that are not there are left out."""
        rules = {k: r for k, r in self.rules(domain).items() if k.split(".")[0] in items.columns}
        return masking.mask_columns(items, rules, self.other)


def _review_rules(domain: str) -> Rules:
    login, scan, at = hashing.login, hashing.text, F.lit(domain)
    many = lambda c: F.transform(c, login)
    rules: Rules = {"author": login, "assignees": many, "requested_reviewers": many, "title": scan, "body": scan, "author_id": lambda c: F.when(c != 0, F.lit(0).cast("long")).otherwise(c), "html_url": hashing.profile_url}
    rules |= {"reviews.reviewer": login, "review_comments.author": login, "comments.author": login, "reviews.body": scan, "review_comments.body": scan, "comments.body": scan}
    return rules | {"commits.author_name": hashing.person, "commits.author_email": lambda c: hashing.email(c, at), "commits.author_login": login, "commits.message": scan}


def _page_rules(_: str) -> Rules:
    account = lambda c: hashing.account(c, hashing.CONFLUENCE_SALT)
    scan = lambda c: hashing.text(c, hashing.CONFLUENCE_SALT)
    return {"author_id": account, "title": scan, "body": scan, "comments.author_id": account, "comments.body": scan}


def _calendar_rules(domain: str) -> Rules:
    at = F.lit(domain)
    return {"summary": hashing.text, "description": hashing.text, "location": hashing.text, "attendees.email": lambda c: hashing.email(c, at), "attendees.displayName": hashing.person, "organizer.email": lambda c: hashing.email(c, at), "organizer.displayName": hashing.person}


@dataclass(frozen=True)
class Scanner:
    """What happens to values: typed ones become stand-ins, free texts are scanned, addresses of pages get the masked domain."""

    domains: tuple[tuple[str, str], ...] = ()
    kinds: tuple[str, ...] | None = None

    def structured(self, kind: str) -> Callable[[Column], Column]:
        made = {"PERSON": lambda c: hashing.person(c, hashing.STORE_SALT), "GITHUB_LOGIN": lambda c: hashing.login(c, hashing.STORE_SALT), "EMAIL_ADDRESS": self.email}
        return made.get(kind, lambda c: F.when(c == "", c).when(c.isNotNull(), hashing.stand_in(kind, c)))

    def email(self, c: Column) -> Column:
        at = hashing.domain_part(c)
        for real, masked in self.domains:
            at = F.when(F.lower(at) == real.lower(), masked).otherwise(at)
        return hashing.email(c, at, hashing.STORE_SALT)

    def names(self) -> list[tuple[str, str]]:
        return [p for real, masked in self.domains for p in dict.fromkeys([(real, masked), (real.capitalize(), masked.capitalize())])]

    def url(self, c: Column) -> Column:
        return text.literal_chain(c, self.names())

    def scan(self, c: Column) -> Column:
        return rewriting.scan_nested(c, self.names(), self.kinds)


# Changes of tickets whose old and new value are people.
PEOPLE_FIELDS = ("assignee", "reporter", "creator", "Reviewer", "Approver")


def scanned_reviews(s: Scanner) -> Rules:
    """Change requests: people by login, texts scanned, ids 0, page addresses rewritten, commits as below."""
    login = s.structured("GITHUB_LOGIN")
    many = lambda c: F.transform(c, login)
    rules: Rules = {"author": login, "assignees": many, "requested_reviewers": many, "author_id": lambda c: F.when(c != 0, F.lit(0).cast("long")).otherwise(c), "title": s.scan, "body": s.scan, "html_url": s.url}
    rules |= {"reviews.reviewer": login, "reviews.body": s.scan, "review_comments.author": login, "review_comments.body": s.scan, "comments.author": login, "comments.body": s.scan}
    return rules | {f"commits.{k}": r for k, r in scanned_commits(s).items()}


def scanned_commits(s: Scanner) -> Rules:
    rules: Rules = {"message": s.scan}
    for role in ("author", "committer"):
        rules |= {f"{role}_name": s.structured("PERSON"), f"{role}_email": s.structured("EMAIL_ADDRESS"), f"{role}_login": s.structured("GITHUB_LOGIN")}
    return rules


def scanned_contributors(s: Scanner) -> Rules:
    return {"login": s.structured("GITHUB_LOGIN"), "id": lambda c: F.lit(0).cast("long"), "profile_url": s.url}


def scanned_tickets(s: Scanner) -> Rules:
    """Tickets: people by name, address and account, page addresses, texts and rich text scanned, old and new values of changes by their field."""
    person, mail, account = s.structured("PERSON"), s.structured("EMAIL_ADDRESS"), s.structured("JIRA_ACCOUNT_ID")

    def change(e: Column) -> Column:
        people = e["field"].isin(*PEOPLE_FIELDS)
        value = lambda n: F.when(people, person(e[n])).otherwise(s.scan(e[n]))
        return F.when(e.isNotNull(), e.withField("author", person(e["author"])).withField("from", value("from")).withField("to", value("to")))

    rules: Rules = {"self": s.url, "summary": s.scan, "description_text": s.scan, "description_adf": s.scan, "parent_summary": s.scan, "custom_fields": lambda c: F.transform_values(c, lambda _, v: s.scan(v)), "changelog": lambda c: F.transform(c, change)}
    for role in ("assignee", "reporter", "creator"):
        rules |= {role: person, f"{role}_email": mail, f"{role}_account_id": account}
    rules |= {"comments.author": person, "comments.author_email": mail, "comments.author_account_id": account, "comments.body_text": s.scan, "comments.rendered_body": s.scan, "comments.body_adf": s.scan}
    return rules | {"attachments.author": person, "attachments.author_email": mail, "attachments.content_url": s.url}


def scanned_pages(s: Scanner) -> Rules:
    account = s.structured("JIRA_ACCOUNT_ID")
    return {"author_id": account, "title": s.scan, "body": s.scan, "comments.author_id": account, "comments.body": s.scan}


def scanned_messages(s: Scanner) -> Rules:
    """Chat messages: users of the message, its reactions, replies and files; its text scanned."""
    user = s.structured("SLACK_USER_ID")
    each = {n: user for n in ("user", "parent_user_id", "replies.user", "_replies.user", "files.user")}
    return {**each, "reactions.users": lambda c: F.transform(c, user), "text": s.scan, "_replies.text": s.scan}


#: Rules by kind of item; kinds that are not here have every text scanned, at any depth.
SCANNED: dict[str, Callable[[Scanner], Rules]] = {
    "review": scanned_reviews, "commit": scanned_commits, "contributor": scanned_contributors, "ticket": scanned_tickets, "page": scanned_pages, "message": scanned_messages,
}


def scan_items(items: DataFrame, kind: str, scanner: Scanner) -> DataFrame:
    """Items of a kind with people replaced and texts scanned, in one projection without Python. Columns without a rule stay; kinds without rules (repository metadata, channels, calendars) are scanned whole."""
    items = storage.spread(items)
    if kind not in SCANNED:
        return masking.mask_columns(items, {}, scanner.scan)
    rules = {k: r for k, r in SCANNED[kind](scanner).items() if k.split(".")[0] in items.columns}
    return masking.mask_columns(items, rules)


def route(key: Column) -> Column:
    """How a landed file is masked by its name: copied as it is, as mail, as document, as table, as an item of a kind, or scanned whole."""
    name = F.substring_index(key, "/", -1)
    low = F.lower(key)
    kinds = {"/tickets/": "ticket", "/messages/": "message", "/pages/": "page", "/pull_requests/": "review", "/commits/": "commit"}
    out = F.when(low.endswith(".json"), "scanned")
    for part, kind in kinds.items():
        out = F.when(low.endswith(".json") & F.contains(key, F.lit(part)), kind).otherwise(out)
    out = F.when(name == "contributors.json", "contributor").when(name.isin("repo_metadata.json", "channel_info.json"), "scanned").otherwise(out)
    out = F.when(low.endswith(".eml"), "mail").when(is_office(key), "document").when(low.endswith(".parquet"), "table").otherwise(out)
    return F.when(name.isin("_stats.json", "_index.json"), "copied").otherwise(F.coalesce(out, F.lit("left out")))


#: Maskers by source; others can be added.
MASKERS: dict[str, Masker] = {
    m.source: m
    for m in (
        Masker("github", "github/", _review_rules), Masker("jira", "jira/", lambda d: masking.ticket_rules(d)), Masker("slack", "slack/", lambda _: masking.message_rules()), Masker("confluence", "confluence/", _page_rules), Masker("google", "google/", _calendar_rules),
    )
}


def mask(items: dict[str, DataFrame], domain: str) -> dict[str, DataFrame]:
    """Items of several sources by their maskers; an unknown source is an error, not a silent copy."""
    unknown = set(items) - set(MASKERS)
    if unknown:
        raise ValueError(f"no masker for {', '.join(sorted(unknown))}; there are {', '.join(MASKERS)}")
    return {s: MASKERS[s].mask(df, domain) for s, df in items.items()}
