"""Patterns of typed values in text: as SQL expressions, and as spans with overlaps resolved."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payment handles.
UPI = [
    "okaxis", "oksbi", "okicici", "okhdfcbank", "okkotak", "ybl", "paytm", "upi", "apl", "ibl", "axisbank", "sbi",
    "icici", "hdfcbank", "kotak", "indus", "citi", "boi", "pnb", "unionbank", "canara", "bob", "airtel", "jio",
    "freecharge", "phonepe", "gpay",
]


class Pattern(NamedTuple):
    kind: str
    regex: str
    score: float


# Recognised kinds with their pattern and score. The patterns need no look-around except where noted, so that other engines read them too.
PATTERNS = [
    Pattern("PHONE_NUMBER", r"(?<!\d)\+?91[\s-]?[6-9]\d{9}(?!\d)", 0.8),
    Pattern("IN_PAN", r"\b[A-Z]{5}[0-9]{4}[A-Z]\b", 0.7),
    Pattern("IN_AADHAAR", r"\b[2-9]\d{3}\s?\d{4}\s?\d{4}\b", 0.6),
    Pattern("IN_UPI_ID", r"\b[a-zA-Z0-9._-]+@(?:" + "|".join(UPI) + r")\b", 0.8),
    Pattern("IN_IFSC", r"\b[A-Z]{4}0[A-Z0-9]{6}\b", 0.7),
    Pattern("IN_BANK_ACCOUNT", r"(?:account|a/c|acct)[^\d]{0,10}(\d{9,18})\b", 0.5),
    Pattern("IN_GST", r"\b\d{2}[A-Z]{5}\d{4}[A-Z]\d[A-Z][A-Z0-9]\b", 0.8),
    Pattern("GEO_COORDINATE", r"\b-?\d{1,3}\.\d{4,},\s?-?\d{1,3}\.\d{4,}\b", 0.6),
    Pattern("EMAIL_ADDRESS", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", 1.0),
    Pattern("IP_ADDRESS", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", 0.6),
    Pattern("CREDIT_CARD", r"\b(?:\d[ -]?){13,16}\b", 0.6),
    Pattern("US_SSN", r"\b\d{3}-\d{2}-\d{4}\b", 0.6),
    Pattern("IBAN_CODE", r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b", 0.6),
]
BY_KIND = {p.kind: p for p in PATTERNS}


def matches(text: Column, kind: str) -> Column:
    """All matches of a kind's pattern, case ignored, in order."""
    return F.regexp_extract_all(text, F.lit("(?i)" + BY_KIND[kind].regex), F.lit(0))


def luhn_cards(text: Column) -> Column:
    """Card numbers in a text whose check digit is right, digits only."""
    digits = F.transform(matches(text, "CREDIT_CARD"), lambda c: F.regexp_replace(c, "[^0-9]", ""))
    return F.filter(digits, lambda c: F.coalesce(F.call_function("luhn_check", c), F.lit(False)))


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def recognise(text: str, threshold: float = 0.5, least: int = 3) -> list[Span]:
    """All spans of all patterns with enough score and length, unresolved."""
    found = []
    for p in _COMPILED:
        if p[2] >= threshold:
            found += [Span(p[0], m.start(), m.end(), p[2]) for m in p[1].finditer(text) if m.end() - m.start() >= least]
    return found


_COMPILED = [(p.kind, re.compile(p.regex, re.I | re.M | re.S), p.score) for p in PATTERNS]


def resolve(spans: list[Span], ignored: frozenset[str] = frozenset(), text: str = "") -> list[Span]:
    """Spans without overlap: by start, then the longest, then the best score, from left to right.

    A span whose lower-case text is to be ignored goes without taking its place.
    """
    kept: list[Span] = []
    last = 0
    for s in sorted(spans, key=lambda s: (s.start, s.start - s.end, -s.score)):
        if s.start < last or text[s.start : s.end].lower() in ignored:
            continue
        kept.append(s)
        last = s.end
    return kept


def splice(text: str, spans: list[Span], stand_ins: list[str]) -> str:
    """The text with each span replaced."""
    out, at = [], 0
    for s, v in zip(spans, stand_ins):
        out += [text[at : s.start], v]
        at = s.end
    return "".join(out) + text[at:]


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def spans(text: Column, threshold: float = 0.5) -> Column:
    """Resolved spans of a text column as an array of kind, start, end and score; none for null and short texts."""

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda t: [s._asdict() for s in resolve(recognise(t, threshold), text=t)] if t and len(t) >= 3 else [])

    return find(text)


def dictionary_spans(text: str, automaton: object, longest: bool = False) -> list[Span]:
    """Entries of a dictionary in a text: the one that ends first wins, or with `longest` the longest from the left.

    automaton: an Aho-Corasick automaton over lower-case entries with
    (kind, length) values. The text is compared in lower case character by
    character, so positions hold for letters whose lower case is longer.
    """
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    hits = [Span(kind, end - n + 1, end + 1, 0.95) for end, (kind, n) in automaton.iter(low)]  # type: ignore[attr-defined]
    if longest:
        return resolve(hits)
    kept, last = [], 0
    for s in hits:
        if s.start >= last:
            kept.append(s)
            last = s.end
    return kept


def resolved(found: Column) -> Column:
    """An array of spans (start, end, score and more) without overlap: by start, then the longest, then the best score, from left to right. Stays in the JVM."""
    order = F.array_sort(found, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).when(a["end"] != b["end"], b["end"] - a["end"]).when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(0))
    begin = F.struct(F.slice(found, 1, 0).alias("kept"), F.lit(0).alias("last"))
    step = lambda s, x: F.when(x["start"] >= s["last"], F.struct(F.concat(s["kept"], F.array(x)).alias("kept"), x["end"].alias("last"))).otherwise(s)
    return F.aggregate(order, begin, step)["kept"]


#: Kinds of entries that a roster recognises in texts, and the least length of a value.
ROSTER_KINDS, ROSTER_LEAST = ("PERSON", "EMAIL_ADDRESS", "GITHUB_LOGIN", "SLACK_USER_ID", "JIRA_ACCOUNT_ID"), 4


def roster_entries(entries: DataFrame) -> DataFrame:
    """Entries that a roster recognises: kind, value (lower case), once each, of the kind that comes first by id.

    entries: id, entity_type, real_value.
    """
    kept = entries.where(F.col("entity_type").isin(*ROSTER_KINDS) & (F.length("real_value") >= ROSTER_LEAST))
    return kept.groupBy(F.lower("real_value").alias("value")).agg(F.min_by("entity_type", "id").alias("kind")).select("kind", "value")


def sweep_entries(entries: DataFrame, names: list[str], domains: list[str]) -> DataFrame:
    """Entries safe to replace in raw bytes: real_value, masked_value. People and addresses of six characters or more, trimmed, without marks of markup, no company or domain, people of letters only."""
    v = F.col("real_value")
    usual = F.col("entity_type").isin("PERSON", "EMAIL_ADDRESS") & (F.length(v) >= 6) & (v == F.trim(v)) & ~v.rlike(r"[<>&;{}\[\]%#]") & ~F.lower(v).isin(*[x.lower() for x in (*names, *domains)])
    return entries.where(usual & (F.contains(v, F.lit("@")) | v.rlike(r"^[A-Za-z][A-Za-z .'-]+$"))).select("real_value", "masked_value")


def dictionary_hits(texts: DataFrame, keys: list[str], text: str, entries: list[tuple[str, str]]) -> DataFrame:
    """Entries (kind, value) found in texts, case ignored, without overlap: the keys, kind, start, end.

    The entries travel to the tasks as one automaton: give a list of bounded size.
    """
    shared = texts.sparkSession.sparkContext.broadcast(entries)
    schema = ", ".join(f"{k} {dict(texts.dtypes)[k]}" for k in keys) + ", kind string, start int, end int"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for kind, value in shared.value:
            if value and value.lower() not in automaton:
                automaton.add_word(value.lower(), (kind, len(value)))
        if len(automaton):
            automaton.make_automaton()
        for b in it:
            rows = [(i, s) for i, t in enumerate(b.column(len(keys)).to_pylist()) if t and len(automaton) for s in dictionary_spans(t, automaton)]
            kept = b.take(pa.array([i for i, _ in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[: len(keys)], pa.array([s.kind for _, s in rows], pa.string()), pa.array([s.start for _, s in rows], pa.int32()), pa.array([s.end for _, s in rows], pa.int32())], names=[*keys, "kind", "start", "end"])

    return texts.select(*keys, text).mapInArrow(batches, schema)
