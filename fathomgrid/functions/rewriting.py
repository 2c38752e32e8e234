"""Replacing found values in texts: scans, HTML, mentions, labels, typed lookups."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from fathomgrid.functions import hashing, text
from fathomgrid.functions.recognizers import PATTERNS, recognise, resolve, splice

StandIn = Callable[[str, str], str]
#: HTML shorter than this is scanned as plain text.
HTML_FROM = 1000


def scan_text(value: str | None, stand_in: StandIn, literals: list[tuple[str, str]] = [], threshold: float = 0.5, kinds: tuple[str, ...] | None = None) -> str | None:  # noqa: B006
    """A text with every recognised value replaced, then the literal names; null and texts under three characters pass."""
    if value is None or len(value) < 3:
        return value
    spans = resolve([s for s in recognise(value, threshold) if kinds is None or s.kind in kinds], text=value)
    out = splice(value, spans, [stand_in(s.kind, value[s.start : s.end]) for s in spans])
    for old, new in literals:
        out = out.replace(old, new)
    return out


def scan_html(value: str | None, stand_in: StandIn, literals: list[tuple[str, str]] = []) -> str | None:  # noqa: B006
    """HTML with values found outside style and script replaced everywhere in it, the longest first."""
    if value is None or len(value) <= HTML_FROM:
        return scan_text(value, stand_in, literals)
    bare = value
    for pattern, new in text.STYLE_CHAIN:
        bare = re.sub(pattern, new, bare)
    found = {bare[s.start : s.end]: s.kind for s in resolve(recognise(bare), text=bare)}
    out = value
    for v in sorted(found, key=len, reverse=True):
        out = out.replace(v, stand_in(found[v], v))
    for old, new in literals:
        out = out.replace(old, new)
    return out


def scan(column: Column, stand_in: StandIn, literals: list[tuple[str, str]] = [], html: bool = False, kinds: tuple[str, ...] | None = None) -> Column:  # noqa: B006
    """Scanned texts of a column in Arrow batches; a text that can't be scanned gets its literal names replaced only."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(v: str | None) -> str | None:
            try:
                return scan_html(v, stand_in, literals) if html else scan_text(v, stand_in, literals, kinds=kinds)
            except Exception:  # the row must not be lost
                for old, new in literals:
                    v = v.replace(old, new) if v else v
                return v

        for b in batches:
            yield b.map(one)

    return run(column)


def labels(column: Column, threshold: float = 0.0, allowed: tuple[str, ...] = ()) -> Column:
    """Recognised values as labels such as [EMAIL_ADDRESS], without leaving the JVM; patterns in order of score.

    threshold: the least score of a pattern; allowed: values that stay, whatever their case.
    """
    keep = [a.lower() for a in allowed]
    for p in sorted(PATTERNS, key=lambda p: -p.score):
        if p.score < threshold:
            continue
        if keep:
            column = replaced(column, p.regex, _label(p.kind, keep))
        else:
            column = F.regexp_replace(column, "(?i)" + p.regex, f"[{p.kind}]")
    return column


def _label(kind: str, keep: list[str]) -> Callable[[Column], Column]:
    return lambda m: F.when(F.lower(m).isin(*keep), m).otherwise(f"[{kind}]")


def replaced(column: Column, pattern: str, rule: Callable[[Column], Column]) -> Column:
    """A text with every match of a pattern, case ignored, replaced by a rule: split at the matches, rewritten, joined again.

    Stays in the JVM and may stand inside lambdas over arrays of structs.
    """
    pattern = "(?i)" + pattern

    def whole(v: Column) -> Column:
        made = F.transform(F.regexp_extract_all(v, F.lit(pattern), F.lit(0)), lambda m: rule(m))  # noqa: PLW0108 - rules may have more parameters
        return F.array_join(F.flatten(F.zip_with(F.split(v, pattern), F.concat(made, F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")

    return F.get(F.transform(F.array(column), whole), F.lit(0))  # binds the text once, however many patterns follow each other


def scan_nested(column: Column, literals: list[tuple[str, str]] = [], kinds: tuple[str, ...] | None = None, threshold: float = 0.5) -> Column:  # noqa: B006
    """A text with the values of all patterns replaced by their stand-ins, by falling score, then the literal names.

    Null and texts under three characters pass. Where values of two patterns
    overlap the one with the higher score goes first.
    """
    out = column
    for p in sorted(PATTERNS, key=lambda p: -p.score):
        if p.score >= threshold and (kinds is None or p.kind in kinds):
            out = replaced(out, p.regex, partial(hashing.stand_in, p.kind))
    return F.when(F.length(column) < 3, column).otherwise(text.literal_chain(out, literals))


#: Stands between texts that are scanned as one; no pattern matches it or reaches over it.
SEPARATOR = "\n\x1e\x1e\x1e\n"


def scan_batch(values: list[str | None], stand_in: StandIn, literals: list[tuple[str, str]] = []) -> list[str | None]:  # noqa: B006
    """Texts scanned in one go: joined, scanned, split. Where the parts no longer agree in number each is scanned alone."""
    long = [i for i, v in enumerate(values) if v is not None and len(v) >= 3]
    out = list(values)
    parts = (scan_text(SEPARATOR.join(values[i] for i in long), stand_in, literals) or "").split(SEPARATOR) if long else []  # type: ignore[misc]
    if len(parts) != len(long):
        parts = [scan_text(values[i], stand_in, literals) or "" for i in long]
    for i, p in zip(long, parts):
        out[i] = p
    return out


def mentions(column: Column, salt: str = hashing.GITHUB_SALT) -> Column:
    """A text with the @logins in it hashed: split at the mentions, rewritten, joined again.

    An @ right after a letter or digit belongs to an address and stays.
    """
    pattern = r"(?<![A-Za-z0-9_.+-])@[A-Za-z0-9_-]+"
    found = F.regexp_extract_all(column, F.lit(pattern), F.lit(0))
    between = F.split(column, pattern)
    masked = F.transform(found, lambda m: F.concat(F.lit("@"), hashing.login(F.substring(m, F.lit(2), F.length(m)), salt)))
    return F.array_join(F.flatten(F.zip_with(between, F.concat(masked, F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
