"""Column expressions for keys, blanks and the times that exports carry as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space around a value, inside a character class.
SPACE = r"\s\u0085\u00a0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"


def stripped(c: Column) -> Column:
    """Without surrounding white space of any kind; null stays null."""
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def blank_to_null(c: Column) -> Column:
    """Null where the value is null, empty or only white space; else the value itself."""
    return F.when(stripped(c) != "", c)


def normal_key(c: Column) -> Column:
    """Normal form of a key: trimmed, upper case; null for blank ones."""
    s = F.upper(stripped(c))
    return F.when(s != "", s)


def flexible_time(c: Column) -> Column:
    """Timestamp of a time given as text, independent of the session's zone.

    Reads ISO times with Z, +hhmm or +hh:mm, ISO times without zone (taken as
    UTC) and epoch milliseconds. Anything else, blank or null gives null.
    """
    s = stripped(c)
    iso = F.regexp_replace(s, r"([+-]\d{2})(\d{2})$", "$1:$2")
    zoned = F.when(iso.rlike(r"([zZ]|[+-]\d{2}:\d{2})$"), iso).otherwise(F.concat(iso, F.lit("Z")))
    return F.when(s.rlike(r"^-?\d{9,17}$"), F.timestamp_millis(s.try_cast("bigint"))).when(
        s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}"), zoned.try_cast("timestamp")
    ).when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(s, F.lit("T00:00:00Z")).try_cast("timestamp"))


def latest_by(order: list[Column], *values: Column) -> Column:
    """Aggregate: the values of the row with the greatest order, nulls lowest.

    Partial results combine before the shuffle, so a key that holds a third of
    all rows costs one row per task.
    """
    return F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *values))
