"""Identity tables: lookups, get-or-create, merging of person records, domain maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomgrid import storage
from fathomgrid.functions import hashing

#: Attributes of a person record in the order in which they are kept.
FIELDS = ["email", "name", "first_name", "last_name", "github_login", "slack_user_id", "slack_display_name", "slack_username", "jira_account_id", "jira_display_name", "confluence_account_id"]

# Mail providers and services whose domains are nobody's company.
GENERIC = (
    "gmail.com googlemail.com outlook.com hotmail.com live.com yahoo.com yahoo.co.in aol.com icloud.com protonmail.com proton.me zoho.com yandex.com mail.com rediffmail.com msn.com example.com example.org resource.calendar.google.com"
).split()
SERVICES = (
    "google.com github.com github.io slack.com atlassian.net atlassian.com hubspot.com amazonaws.com amazonses.com amazon.com microsoft.com office365.com office.com salesforce.com zendesk.com intercom.io stripe.com twilio.com sendgrid.net mailchimp.com mandrill.com bounces.google.com googlegroups.com"
).split()


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def lookup(rows: DataFrame, entries: DataFrame, kind: str, value: Column, fallback: Column, out: str) -> DataFrame:
    """Rows with the masked value of (kind, lower-case value) in `out`, else the fallback; null stays null.

    entries: entity_type, real_value, masked_value; of entries that differ in
    case only the smallest masked value counts, so no row is multiplied. Spark
    broadcasts the entries when their measured size allows, else both sides
    are shuffled by the value.
    """
    known = entries.where(F.col("entity_type") == kind).groupBy(F.lower("real_value").alias("_key")).agg(F.min("masked_value").alias("_masked"))
    return rows.withColumn("_key", F.lower(value)).join(known, "_key", "left").withColumn(out, F.when(value.isNotNull(), F.coalesce("_masked", fallback))).drop("_key", "_masked")


def get_or_create(entries: DataFrame, seen: DataFrame) -> DataFrame:
    """Entries for values that have none yet: entity_type, real_value, masked_value.

    seen: entity_type, real_value. A value counts once whatever its case, in
    the spelling that sorts first; null and blank values make no entry.
    """
    new = seen.where(~blank(F.col("real_value"))).groupBy("entity_type", F.lower("real_value").alias("_key")).agg(F.min("real_value").alias("real_value"))
    known = entries.select("entity_type", F.lower("real_value").alias("_key")).distinct()
    fresh = new.join(known, ["entity_type", "_key"], "left_anti")
    made = hashing.stand_in("", F.col("real_value"))
    for kind in ("PHONE_NUMBER", "IP_ADDRESS", "CREDIT_CARD", "IBAN_CODE", "US_SSN", "MEDICAL_LICENSE", "IN_PAN", "IN_AADHAAR", "IN_UPI_ID", "IN_IFSC", "IN_BANK_ACCOUNT", "IN_GST", "GEO_COORDINATE", "JIRA_ACCOUNT_ID"):
        made = F.when(F.col("entity_type") == kind, hashing.stand_in(kind, F.col("real_value"))).otherwise(made)
    other = F.concat(F.lit("["), F.col("entity_type"), F.lit("-"), hashing.salted(F.col("real_value"), hashing.STORE_SALT, 8), F.lit("]"))
    typed = F.col("entity_type").isin("PHONE_NUMBER", "IP_ADDRESS", "CREDIT_CARD", "IBAN_CODE", "US_SSN", "MEDICAL_LICENSE", "IN_PAN", "IN_AADHAAR", "IN_UPI_ID", "IN_IFSC", "IN_BANK_ACCOUNT", "IN_GST", "GEO_COORDINATE", "JIRA_ACCOUNT_ID")
    person = F.col("entity_type") == "PERSON"
    return fresh.select("entity_type", "real_value", F.when(person, hashing.invented_name(F.col("real_value"))).when(typed, made).otherwise(other).alias("masked_value"))


def _first(field: str, order: Column) -> Column:
    """The value of the first record, by order, in which it is not blank."""
    return F.coalesce(F.min_by(field, F.when(~blank(F.col(field)), order)), F.lit("")).alias(field)


def merge_records(records: DataFrame, group: str, order: str) -> DataFrame:
    """One record per group: each field from the first record that has it, each source once in order of appearance.

    Values combine before the shuffle; what is gathered per group is bounded by
    the number of distinct sources, however many records the group has.
    """
    present = [f for f in FIELDS if f in records.columns]
    fields = records.groupBy(group).agg(*[_first(f, F.col(order)) for f in present], F.count(F.lit(1)).alias("records"))
    seen = records.select(group, F.col(order).alias("_o"), F.explode("sources").alias("_s")).where(F.col("_s").isNotNull()).groupBy(group, "_s").agg(F.min("_o").alias("_o"))
    sources = seen.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_s"))), lambda x: x["_s"]).alias("sources"))
    return fields.join(sources, group, "left").withColumn("sources", F.coalesce("sources", F.array().cast("array<string>")))


def local_forms(mail: Column) -> Column:
    """The local part of an address, lower case, as it is and without dots and underscores, each once."""
    local = F.lower(F.split_part(mail, F.lit("@"), F.lit(1)))
    return F.array_distinct(F.array(local, F.translate(local, "._", "")))


def resolve_persons(records: DataFrame, order: str) -> DataFrame:
    """The person each record belongs to, `person`: its group's lower-case address, or `_orphan_` with its order.

    Records with an address group by it, lower case. Others join the person of
    the same name, else whose address has their login before the @, plain or
    without dots and underscores, else so their name without spaces. Where
    several persons fit, the one with the last address counts. Records without
    match stay alone; they never join each other.
    """
    keyed = records.withColumn("_mail", F.lower("email"))
    with_mail = keyed.where(~blank(F.col("email")))
    people = with_mail.groupBy("_mail").agg(_first("name", F.col(order)), F.min(order).alias("_at"))
    by_name = people.where(~blank(F.col("name"))).groupBy(F.lower("name").alias("k1")).agg(F.max_by("_mail", "_at").alias("m1"))
    locals_ = people.where(F.contains("_mail", F.lit("@"))).select(F.explode(local_forms(F.col("_mail"))).alias("k"), "_mail", "_at")
    by_local = locals_.groupBy("k").agg(F.max_by("_mail", "_at").alias("m"))
    orphans = keyed.where(blank(F.col("email")))
    named = F.when(~blank(F.col("name")), F.lower("name"))
    login = F.when(~blank(F.col("github_login")), F.lower("github_login"))
    matched = (
        orphans.withColumn("k1", named).withColumn("k2", login).withColumn("k3", F.replace(named, F.lit(" "), F.lit("")))
        .join(by_name, "k1", "left").join(by_local.select(F.col("k").alias("k2"), F.col("m").alias("m2")), "k2", "left").join(by_local.select(F.col("k").alias("k3"), F.col("m").alias("m3")), "k3", "left")
    )
    alone = F.concat(F.lit("_orphan_"), F.col(order).cast("string"))
    return with_mail.select(*records.columns, F.col("_mail").alias("person")).unionByName(matched.select(*records.columns, F.coalesce("m1", "m2", "m3", alone).alias("person")))


def merge_persons(records: DataFrame, order: str) -> DataFrame:
    """One record per resolved person; see resolve_persons and merge_records."""
    return merge_records(resolve_persons(records, order), "person", order)


def incremental_roster(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Roster ids by lower-case address: existing ones kept, new ones numbered on after the highest.

    existing: id (`user-0001`), email; found: email. New addresses are numbered
    in order of the address within range partitions, so no task sorts them all.
    """
    old = existing.groupBy(F.lower("email").alias("email")).agg(F.min("id").alias("id"))
    new = found.where(~blank(F.col("email"))).select(F.lower("email").alias("email")).distinct().join(old.select("email"), "email", "left_anti")
    start = existing.agg(F.max(F.regexp_extract("id", r"(\d+)$", 1).try_cast("long"))).first()[0] or 0
    return old.select("id", "email").unionByName(numbered(new, "email", start).select(F.format_string("user-%04d", "n").alias("id"), "email"))


def numbered(rows: DataFrame, by: str, start: int = 0) -> DataFrame:
    """Rows with consecutive numbers `n` from start + 1 in order of a column, without sorting in one task.

    Rows are range-partitioned, counted by partition, and numbered inside; the
    counts are one small row per partition.
    """
    spark = rows.sparkSession
    parts, _ = storage.materialise(rows.repartitionByRange(F.col(by)).withColumn("_p", F.spark_partition_id()), "numbered")
    counts = parts.groupBy("_p").count().orderBy("_p").collect()
    base, at = [], start
    for r in counts:
        base.append((r[0], at))
        at += r[1]
    offsets = F.broadcast(spark.createDataFrame(base or [(0, start)], "_p int, _base long"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(by))
    return parts.join(offsets, "_p").withColumn("n", inside + F.col("_base")).drop("_p", "_base")


def discovered_domains(domains: DataFrame, known: list[str] | None = None) -> DataFrame:
    """Company domains worth a stand-in: domain, masked and company (null when its first label is short).

    Generic providers, known domains, services and what is below them, domains
    of fewer than two or more than three labels and those with a first label
    under three letters are left out.
    """
    d = F.lower("domain")
    service = F.lit(False)
    for s in SERVICES:
        service = service | (d == s) | d.endswith("." + s)
    labels = F.split(d, r"\.")
    fit = ~d.isin(*GENERIC, *(known or [])) & ~service & F.size(labels).between(2, 3) & (F.length(labels[0]) >= 3)
    return domains.where(F.col("domain").isNotNull()).select(d.alias("domain")).distinct().where(fit).select(
        "domain", F.concat(F.lit("fakecompany."), F.array_join(F.slice(labels, 2, 2), ".")).alias("masked"), F.when(F.length(labels[0]) >= 6, labels[0]).alias("company")
    )


def map_addresses(rows: DataFrame, column: str, domain_map: DataFrame, out: str) -> DataFrame:
    """Addresses with a hashed local part at the mapped domain; unknown domains stay, values without @ are hashed."""
    domains = domain_map.groupBy(F.lower("real_domain").alias("_domain")).agg(F.min("masked_domain").alias("_mapped"))
    value = F.col(column)
    found = rows.withColumn("_domain", F.lower(hashing.domain_part(value))).join(domains, "_domain", "left")
    return found.withColumn(out, hashing.email(value, F.coalesce("_mapped", hashing.domain_part(value)), hashing.ROSTER_SALT)).drop("_domain", "_mapped")


#: Attributes by which a roster finds a person: whether case matters, and the masked attribute that stands in.
LOOKUPS = {"email": (False, "email"), "name": (False, "name"), "github_login": (False, "github_login"), "slack_user_id": (True, "slack_user_id"), "jira_account_id": (True, "jira_account_id")}


def roster_index(roster: DataFrame, by: str) -> DataFrame:
    """Entries of a roster by an attribute: key and the masked attribute; of several entries of a key the last by id counts.

    roster: id, real and masked (maps of attributes). Names are found by the
    whole name and, where no entry has it, by given and family name; account
    ids of tickets also by the one of the wiki.
    """
    exact, masked = LOOKUPS[by]
    fold = (lambda c: c) if exact else F.lower
    real = F.col("real")
    full = F.concat_ws(" ", real["first_name"], real["last_name"])
    ways = [(real[by], 1)]
    if by == "name":
        ways.append((F.when(~blank(real["first_name"]) & ~blank(real["last_name"]), full), 0))
    if by == "jira_account_id":
        ways.append((real["confluence_account_id"], 1))
    rows = roster.select("id", F.col("masked")[masked].alias("masked"), F.explode(F.array(*[F.struct(fold(c).alias("key"), F.lit(p).alias("rank")) for c, p in ways])).alias("k")).select("id", "masked", "k.*")
    return rows.where(~blank(F.col("key"))).groupBy("key").agg(F.max(F.struct("rank", "id", "masked")).alias("e")).select("key", "e.masked")


def roster_lookup(rows: DataFrame, roster: DataFrame, by: str, value: Column, out: str) -> DataFrame:
    """Rows with the stand-in of a person found in a roster, else a keyed hash; blank values pass, chat ids that are unknown too."""
    exact, _ = LOOKUPS[by]
    made = {"email": lambda c: hashing.email(c, hashing.domain_part(c), hashing.ROSTER_SALT), "name": lambda c: hashing.person(c, hashing.ROSTER_SALT), "github_login": lambda c: hashing.login(c, hashing.ROSTER_SALT), "slack_user_id": lambda c: c, "jira_account_id": lambda c: hashing.account(c, hashing.ROSTER_SALT)}
    index = roster_index(roster, by).withColumnsRenamed({"key": "_key", "masked": "_masked"})
    found = rows.withColumn("_key", value if exact else F.lower(value)).join(index, "_key", "left")
    return found.withColumn(out, F.when(blank(value), value).otherwise(F.coalesce(F.when(~blank(F.col("_masked")), F.col("_masked")), made[by](value)))).drop("_key", "_masked")


def entry_counts(entries: DataFrame) -> DataFrame:
    """Distinct values, whatever their case, of each entity type: entity_type, n."""
    return entries.where(~blank(F.col("real_value"))).groupBy("entity_type").agg(F.count_distinct(F.lower("real_value")).alias("n"))
