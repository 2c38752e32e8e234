"""Scalar text functions as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rewriting of tracked page addresses, in order.
URL_CHAIN = [
    ("/doctor/[a-zA-Z0-9_-]+", "/doctor/redacted"),
    ("/consult/[^/?#]+", "/consult/redacted"),
    ("/feedback/upload/[0-9]+", "/feedback/upload/0"),
    ("practice_id=[0-9]+", "practice_id=0"),
    ("[cf]_sid=[0-9]+", "sid=0"),
    ("gad_source=[^&]+", "gad_source=0"),
]


def url_chain(domain: str, masked: str, brand: str, masked_brand: str) -> list[tuple[str, str]]:
    """The rules of page addresses, then those of a site: its name with hyphens as in caches, with and without www, its brand in titles, its domain."""
    hyphens, other = domain.replace(".", "-"), masked.replace(".", "-")
    return [*URL_CHAIN, (f"www-{hyphens}", f"www-{other}"), (hyphens, other), (brand, masked_brand), (re.escape(domain), masked)]


# Style that only slows detection, removed before it.
STYLE_CHAIN = [
    (r"(?s)<style[^>]*>.*?</style>", ""),
    (r"(?s)<script[^>]*>.*?</script>", ""),
    (r'\sstyle="[^"]*"', ""),
    (r"\sstyle='[^']*'", ""),
    (r'\sclass="[^"]*"', ""),
]


def chain(value: Column, rules: list[tuple[str, str]]) -> Column:
    """Regular replacements one after the other, each of all occurrences."""
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, value)


def literal_chain(value: Column, rules: list[tuple[str, str]]) -> Column:
    """Literal replacements one after the other; the rules are a small, known list."""
    return reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), rules, value)


def cased(word: str, stand_in: str) -> list[tuple[str, str]]:
    """A word as it is, capitalised and in upper case, each with its stand-in."""
    return list(dict.fromkeys([(word, stand_in), (word.capitalize(), stand_in.capitalize()), (word.upper(), stand_in.upper())]))


def file_name(name: Column, longest: int = 200) -> Column:
    """A name safe for stores: separators and control characters as _, dots and spaces around removed, cut before a short extension."""
    safe = F.regexp_replace(name, r"[/\\?#\x00-\x1f\x7f]", "_")
    safe = F.regexp_replace(safe, r"^[. ]+|[. ]+$", "")
    safe = F.when(safe == "", "unnamed").otherwise(safe)
    ending = F.regexp_extract(safe, r"(\.[^.]*)$", 1)
    stem = F.substring(safe, F.lit(1), F.lit(longest) - F.length(ending))
    cut = F.when((ending != "") & (F.length(ending) < 20), F.concat(stem, ending)).otherwise(F.substring(safe, 1, longest))
    return F.when(F.length(safe) > longest, cut).otherwise(safe)


def extension(name: Column) -> Column:
    """Lower-case extension with its dot, `.unknown` without one."""
    return F.when(F.contains(name, F.lit(".")), F.lower(F.concat(F.lit("."), F.substring_index(name, ".", -1)))).otherwise(".unknown")


def human_bytes(n: Column) -> Column:
    """Bytes with one decimal in the largest unit below 1024."""
    steps = [("B", 1.0), ("KB", 1024.0), ("MB", 1024.0**2), ("GB", 1024.0**3)]
    out = F.format_string("%.1f TB", n / F.lit(1024.0**4))
    for unit, size in reversed(steps):
        out = F.when(n < size * 1024, F.format_string(f"%.1f {unit}", n / F.lit(size))).otherwise(out)
    return F.when(n.isNotNull(), out)


def duration(seconds: Column) -> Column:
    """Seconds, minutes or hours with one decimal."""
    return (
        F.when(seconds < 60, F.format_string("%.1fs", seconds)).when(seconds < 3600, F.format_string("%.1f min", seconds / F.lit(60.0)))
        .when(seconds >= 3600, F.format_string("%.1f hrs", seconds / F.lit(3600.0)))
    )


def retry_after(header: Column, now: Column) -> Column:
    """Seconds to wait of a header that holds seconds or a date, null for anything else."""
    date = F.regexp_replace(header, r"^[A-Za-z]+, *", "")
    at = F.to_unix_timestamp(F.try_to_timestamp(date, F.lit("d MMM yyyy HH:mm:ss z")))
    return F.coalesce(header.try_cast("double"), F.when(at.isNotNull(), F.greatest(F.lit(0), at - F.to_unix_timestamp(now))).cast("double"))


def reset_wait(reset: Column, now: Column) -> Column:
    """Seconds until a reset with a margin of 5, at least 60; 300 where it is unknown."""
    return F.when(reset.isNull(), 300).otherwise(F.greatest(reset - now + 5, F.lit(60)))


def base64url(value: Column) -> Column:
    """Bytes of base64 with the alphabet of addresses; missing padding is added."""
    v = F.translate(value, "-_", "+/")
    return F.unbase64(F.rpad(v, ((F.length(v) + 3) / 4).cast("int") * 4, "="))


def slug(value: Column) -> Column:
    """owner/repo as owner__repo, addresses with _at_."""
    return F.replace(F.replace(value, F.lit("/"), F.lit("__")), F.lit("@"), F.lit("_at_"))


def unslug(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("_at_"), F.lit("@")), F.lit("__"), F.lit("/"))


def first_last(name: Column) -> tuple[Column, Column]:
    """Given name and the rest, split at the first white space."""
    parts = F.split(F.trim(name), r"\s+", 2)
    return F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))


def short_login(first: Column, last: Column) -> Column:
    """First letter and family name, lower case."""
    return F.lower(F.concat(F.substring(first, 1, 1), last))


def percentage(part: Column, total: Column) -> Column:
    """Share in percent with two decimals; a total of 0 counts as 1."""
    return F.round(part / F.when(total == 0, F.lit(1)).otherwise(total) * 100, 2)


def mail_key(key: Column, address: Callable[[Column], Column], literals: list[tuple[str, str]]) -> Column:
    """A key whose second part is the slug of an address, with the address rewritten; other keys with the literal names replaced."""
    parts = F.split(key, "/", 3)
    slug_part = F.get(parts, F.lit(1))
    masked = F.replace(address(F.replace(slug_part, F.lit("_at_"), F.lit("@"))), F.lit("@"), F.lit("_at_"))
    mapped = (F.size(parts) == 3) & F.contains(slug_part, F.lit("_at_"))
    return F.when(mapped, F.concat_ws("/", F.get(parts, F.lit(0)), masked, F.get(parts, F.lit(2)))).otherwise(literal_chain(key, literals))


def holds_domain(value: Column, domains: list[str]) -> Column:
    """Whether a text names one of a few domains, whatever the case."""
    out = F.lit(False)
    for d in domains:
        out = out | F.contains(F.lower(value), F.lit(d.lower()))
    return out


def day_key(date: Column, back: int = 0) -> Column:
    """A day, or one some days before, as yyyyMMdd."""
    return F.date_format(F.date_sub(date, back), "yyyyMMdd")
