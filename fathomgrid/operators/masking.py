"""Masking of nested records by expressions built from their schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomgrid.functions import hashing, text

Rule = Callable[[Column], Column]


def map_strings(kind: T.DataType, value: Column, rule: Rule, depth: int | None = None) -> Column:
    """The value with a rule applied to every text in it, keys of maps kept.

    depth bounds how many structs deep the rule reaches; None is unbounded. A
    null struct becomes a struct of nulls, null arrays and maps stay null.
    """
    if isinstance(kind, T.StringType):
        return rule(value)
    if isinstance(kind, T.StructType):
        if depth is not None and depth <= 0:
            return value
        less = None if depth is None else depth - 1
        return F.struct(*[map_strings(f.dataType, value.getField(f.name), rule, less).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: map_strings(kind.elementType, x, rule, depth))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: map_strings(kind.valueType, v, rule, depth))
    return value


def mask_columns(df: DataFrame, rules: dict[str, Rule], other: Rule | None = None) -> DataFrame:
    """Columns with their own rule, or the rule of other texts at any depth, in one projection.

    A rule may name a nested field with dots; arrays on the way are passed
    through. Columns without rule stay as they are.
    """
    nested: dict[str, dict[str, Rule]] = {}
    for path, rule in rules.items():
        head, _, rest = path.partition(".")
        nested.setdefault(head, {})[rest] = rule
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        own = nested.get(f.name)
        if own is not None:
            out.append(_rewrite(f.dataType, c, own, other).alias(f.name))
        elif other is not None:
            out.append(map_strings(f.dataType, c, other).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def _rewrite(kind: T.DataType, value: Column, rules: dict[str, Rule], other: Rule | None) -> Column:
    if "" in rules:
        return rules[""](value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _rewrite(kind.elementType, x, rules, other))
    if isinstance(kind, T.StructType):
        fields = []
        for f in kind.fields:
            own = {p.partition(".")[2]: r for p, r in rules.items() if p.partition(".")[0] == f.name}
            c = value.getField(f.name)
            fields.append((_rewrite(f.dataType, c, own, other) if own else map_strings(f.dataType, c, other) if other else c).alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def ticket_rules(domain: str, salt: str = hashing.JIRA_SALT) -> dict[str, Rule]:
    """Rules of tickets with their comments, attachments and changelog: people by hash, texts by hash, ids kept."""
    at = F.lit(domain)
    rules: dict[str, Rule] = {}
    for role in ("assignee", "reporter", "creator"):
        rules |= {role: lambda c: hashing.person(c, salt), f"{role}_email": lambda c: hashing.email(c, at, salt), f"{role}_account_id": lambda c: hashing.account(c, salt)}
    for field in ("summary", "description_text", "parent_summary"):
        rules[field] = lambda c: hashing.text(c, salt)
    rules |= {
        "comments.author": lambda c: hashing.person(c, salt), "comments.author_email": lambda c: hashing.email(c, at, salt), "comments.author_account_id": lambda c: hashing.account(c, salt),
        "comments.body_text": lambda c: hashing.text(c, salt), "comments.body_adf": lambda c: hashing.text(c, salt), "comments.rendered_body": lambda c: hashing.text(c, salt),
        "attachments.author": lambda c: hashing.person(c, salt), "attachments.author_email": lambda c: hashing.email(c, at, salt), "changelog.author": lambda c: hashing.person(c, salt),
    }
    return rules


def message_rules(salt: str = hashing.STORE_SALT) -> dict[str, Rule]:
    """Rules of chat messages: users in the message, its reactions, replies and files."""
    user = lambda c: hashing.account(c, salt)
    return {"user": user, "parent_user_id": user, "reactions.users": lambda c: F.transform(c, user), "_replies.user": user, "replies.user": user, "files.user": user, "text": lambda c: hashing.text(c, salt)}


# Which keys and fields of web-analytics events are identifiers.
RANDOM_KEYS, REDACTED_KEYS = ("gclid", "transaction_id"), ("term",)
TRACKING, PLACE, DEVICE = ("gclid", "dclid", "srsltid"), ("city", "region", "metro"), ("vendor_id", "advertising_id")
CAMPAIGN = tuple("customer_id ad_group_id campaign_id advertiser_id creative_id insertion_order_id line_item_id partner_id site_id rendering_id placement_id account_id".split())


def _new_id(value: Column, keyed: str | None) -> Column:
    """A random id, or with a key the same id for the same value."""
    return F.md5(F.uuid()) if keyed is None else F.md5(F.concat(F.lit(keyed), F.coalesce(value, F.lit(""))))


def _bound(rule: Callable[[T.StructType, Column], Column], kind: T.DataType) -> Rule:
    return lambda value: rule(kind, value)  # type: ignore[arg-type]


def _fields(kind: T.StructType, value: Column, named: dict[str, Rule], rest: Rule, keep_null: bool = False) -> Column:
    made = F.struct(*[(named[f.name](value[f.name]) if f.name in named else rest(value[f.name]) if isinstance(f.dataType, T.StringType) else value[f.name]).alias(f.name) for f in kind.fields])
    return F.when(value.isNotNull(), made) if keep_null else made


def mask_events(events: DataFrame, keyed: str | None = None, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """Web-analytics events with identifiers replaced and page addresses rewritten, in one projection.

    keyed: None gives random ids, a text gives ids that are the same for the
    same value. user_pseudo_id is replaced also where null, other ids only where
    set. Lists other than event_params and user_properties pass through;
    structs are rewritten one level deep. A null struct becomes one of nulls.
    """
    address: Rule = lambda c: text.chain(c, text.URL_CHAIN if rules is None else rules)
    fresh: Rule = lambda c: F.when(c.isNotNull(), _new_id(c, keyed))
    redacted: Rule = lambda c: F.when(c.isNotNull(), F.lit("(redacted)"))

    def parameter(kind: T.StructType, p: Column) -> Column:
        value_kind: T.StructType = kind["value"].dataType  # type: ignore[assignment]
        s = p["value"]["string_value"]
        masked = F.when(p["key"].isin(*RANDOM_KEYS), _new_id(s, keyed)).when(p["key"].isin(*REDACTED_KEYS), redacted(s)).otherwise(address(s))
        value = F.struct(*[(masked if f.name == "string_value" else p["value"][f.name]).alias(f.name) for f in value_kind.fields])
        return F.struct(p["key"].alias("key"), value.alias("value"))

    out = []
    for f in events.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if f.name == "user_pseudo_id":
            made = _new_id(c, keyed)
        elif f.name == "user_id":
            made = fresh(c)
        elif f.name in ("event_params", "user_properties") and isinstance(kind, T.ArrayType):
            made = F.transform(c, _bound(parameter, kind.elementType))
        elif f.name == "geo" and isinstance(kind, T.StructType):
            made = _fields(kind, c, dict.fromkeys(PLACE, redacted), lambda x: x)
        elif f.name == "device" and isinstance(kind, T.StructType):
            made = _fields(kind, c, dict.fromkeys(DEVICE, fresh), address)
        elif f.name == "collected_traffic_source" and isinstance(kind, T.StructType):
            made = _fields(kind, c, dict.fromkeys(TRACKING, fresh), address)
        elif f.name == "session_traffic_source_last_click" and isinstance(kind, T.StructType):
            inner = [(_fields(g.dataType, c[g.name], dict.fromkeys(CAMPAIGN, fresh), address) if isinstance(g.dataType, T.StructType) else address(c[g.name]) if isinstance(g.dataType, T.StringType) else c[g.name]).alias(g.name) for g in kind.fields]
            made = F.struct(*inner)
        elif isinstance(kind, T.StructType):
            made = _fields(kind, c, {}, address)
        elif isinstance(kind, T.StringType):
            made = address(c)
        else:
            made = c
        out.append(made.alias(f.name))
    return events.select(*out)
