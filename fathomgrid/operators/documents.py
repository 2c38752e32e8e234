"""Mail messages and office documents as bytes: their parts as rows, and their masked form."""

from __future__ import annotations

import email
import email.policy
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from email.utils import formataddr, getaddresses
from fnmatch import fnmatch
from html import unescape
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Headers with addresses, and headers that are left alone.
ADDRESS_HEADERS = frozenset("from to cc bcc reply-to sender delivered-to return-path x-original-to x-forwarded-to envelope-to".split())
SKIPPED_HEADERS = frozenset(
    "content-type content-transfer-encoding content-disposition mime-version content-id content-length received received-spf authentication-results arc-authentication-results arc-message-signature arc-seal dkim-signature domainkey-signature "
    "date x-mailer x-priority message-id references in-reply-to x-google-dkim-signature x-gm-message-state x-google-smtp-source x-received x-ses-outgoing feedback-id".split()
)
#: Elements that hold text in office documents, by the ending of the file.
_TEXT = re.compile(r"(<(?:w:t|a:t|t)(?:\s[^<>]*)?>)([^<]*)(</(?:w:t|a:t|t)>)")
_PARAGRAPH = re.compile(r"<(w:p|a:p|si)(?:\s[^<>]*)?>.*?</\1>", re.S)

MAIL = "struct<subject:string,sender:string,recipients:array<string>,date:string,attachments:array<string>,text:string,html:string,error:string>"


def read_mail(raw: bytes | None) -> dict:
    """Headers, bodies and attachment names of a message; `error` says why nothing could be read."""
    out: dict = dict.fromkeys(("subject", "sender", "date", "text", "html", "error")) | {"recipients": [], "attachments": []}
    if not raw:
        return out | {"error": "empty"}
    try:
        message = email.message_from_bytes(bytes(raw), policy=email.policy.default)
        out |= {"subject": message["subject"] and str(message["subject"]), "sender": message["from"] and str(message["from"]), "date": message["date"] and str(message["date"])}
        out["recipients"] = [a for _, a in getaddresses([str(message[h]) for h in ("to", "cc", "bcc") if message[h]])]
        for part in message.walk():
            if part.get_filename():
                out["attachments"].append(part.get_filename())
            elif part.get_content_type() == "text/plain" and out["text"] is None:
                out["text"] = part.get_content()
            elif part.get_content_type() == "text/html" and out["html"] is None:
                out["html"] = part.get_content()
    except Exception as e:  # a broken message must not end the job
        out["error"] = f"{type(e).__name__}: {e}"[:200]
    return out


def mail_parts(content: Column) -> Column:
    """Parts of messages given as bytes."""

    @F.pandas_udf(MAIL)
    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([read_mail(x) for x in b], columns=["subject", "sender", "recipients", "date", "attachments", "text", "html", "error"])

    return parts(content)


def mask_addresses(header: str, address: Callable[[str], str], name: Callable[[str], str]) -> str:
    """An address header with every address and display name replaced."""
    return ", ".join(formataddr((name(n) if n else "", address(a) if a else "")) for n, a in getaddresses([header]))


def mask_mail(raw: bytes, scan: Callable[[str], str], address: Callable[[str], str], name: Callable[[str], str], literals: list[tuple[str, str]] = []) -> bytes:  # noqa: B006
    """A message with masked address headers, other headers and text bodies scanned, then the literal names swept from the raw bytes; attachments stay."""
    message = email.message_from_bytes(bytes(raw), policy=email.policy.default)
    for header in list(dict.fromkeys(k.lower() for k in message.keys())):
        if header in SKIPPED_HEADERS:
            continue
        values = [str(v) for v in message.get_all(header, [])]
        del message[header]
        for v in values:
            message[header] = mask_addresses(v, address, name) if header in ADDRESS_HEADERS else scan(v)
    for part in message.walk():
        if part.get_content_type() in ("text/plain", "text/html") and not part.get_filename():
            part.set_content(scan(part.get_content()), subtype=part.get_content_subtype())
    return sweep(message.as_bytes(), literals)


def header_kind(name: Column) -> Column:
    """How a mail header is treated: `address`, `skipped` or `scanned`."""
    low = F.lower(name)
    return F.when(low.isin(*sorted(ADDRESS_HEADERS)), "address").when(low.isin(*sorted(SKIPPED_HEADERS)), "skipped").otherwise("scanned")


def sweep(raw: bytes, literals: list[tuple[str, str]]) -> bytes:
    """Raw bytes of a mail with domains and company names replaced wherever they stand; only names of fixed form are safe there."""
    for old, new in literals:
        raw = raw.replace(old.encode(), new.encode())
    return raw


def spread(text: str, lengths: list[int]) -> list[str]:
    """A replaced text over the runs it came from: by their lengths where it is as long as they were, else all in the first."""
    if len(text) == sum(lengths):
        out, at = [], 0
        for n in lengths:
            out.append(text[at : at + n])
            at += n
        return out
    return [text, *[""] * (len(lengths) - 1)] if lengths else []


def mask_office(raw: bytes, scan: Callable[[str], str]) -> bytes:
    """A document package with the texts of every paragraph scanned as one and spread over its runs; other entries as they are."""

    def paragraph(m: re.Match) -> str:
        runs = _TEXT.findall(m.group(0))
        old = [unescape(r[1]) for r in runs]
        whole = "".join(old)
        new = scan(whole) if whole else whole
        if new == whole:
            return m.group(0)
        parts = iter(spread(new, [len(x) for x in old]))
        return _TEXT.sub(lambda t: t.group(1) + escape(next(parts)) + t.group(3), m.group(0))

    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(bytes(raw))) as source, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as target:
        for entry in source.infolist():
            data = source.read(entry)
            if entry.filename.endswith(".xml"):
                text = data.decode("utf-8", "surrogateescape")
                changed = _PARAGRAPH.sub(paragraph, text)
                if entry.filename.startswith("docProps/"):
                    changed = re.sub(r"(<(?:dc|cp):[a-zA-Z]+[^<>]*>)([^<]+)(</)", lambda m: m.group(1) + escape(scan(unescape(m.group(2)))) + m.group(3), changed)
                data = changed.encode("utf-8", "surrogateescape")
            target.writestr(entry, data)
    return out.getvalue()


def package(parts: dict[str, str]) -> bytes:
    """A document package of texts by entry name."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in parts.items():
            z.writestr(name, content)
    return out.getvalue()


def package_entries(raw: bytes | None, pattern: str = "*") -> list[tuple[str, int]]:
    """Names and sizes of a package's entries that fit a pattern; none for what is no package."""
    try:
        with zipfile.ZipFile(io.BytesIO(bytes(raw or b""))) as z:
            return [(e.filename, e.file_size) for e in z.infolist() if fnmatch(e.filename, pattern)]
    except zipfile.BadZipFile:
        return []


def masked_bytes(content: Column, kind: Column, scan: Callable[[str], str], address: Callable[[str], str], name: Callable[[str], str]) -> Column:
    """Masked form of messages (kind eml) and office documents (docx, xlsx, pptx); null where a document can't be read."""

    @F.pandas_udf("binary")
    def mask(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def one(raw: bytes | None, what: str | None) -> bytes | None:
            if raw is None:
                return None
            try:
                return mask_mail(raw, scan, address, name) if what == "eml" else mask_office(raw, scan)
            except Exception:  # the row is reported as failed, the job goes on
                return None

        for contents, kinds in batches:
            yield pd.Series([one(c, k) for c, k in zip(contents, kinds)])

    return mask(content, kind)
