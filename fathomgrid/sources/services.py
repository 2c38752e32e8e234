"""Items of paged services: one row per item as raw JSON, pages followed in the tasks.

A service is a function that returns one page (a decoded JSON value) for a
target and the parameters of the page. It may call a network client or read
landed responses; here only the way from page to page is known.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid.runtime import retry

Fetch = Callable[[str, dict[str, Any]], Any]


@dataclass(frozen=True)
class Paging:
    """How a service pages.

    way: `number` (pages counted from 1 until an empty one), `token` (the page
    names the next one in `next`), `cursor` (the same, and a page that is not
    ok ends the list), `link` (the next page's address) or `offset` (items
    counted until `total`). items and next are dotted paths into the page; no
    items path means the page is the list.
    """

    way: str
    items: str = ""
    next: str = ""
    total: str = "total"
    ok: str = "ok"


# Paging of the services.
SERVICES = {
    "github": Paging("number"), "jira": Paging("token", "issues", "nextPageToken"), "jira_comments": Paging("offset", "comments"), "slack": Paging("cursor", "messages", "response_metadata.next_cursor"),
    "gmail": Paging("token", "messages", "nextPageToken"), "calendar": Paging("token", "items", "nextPageToken"), "drive": Paging("token", "files", "nextPageToken"), "confluence": Paging("link", "results", "_links.next"),
}


def _at(value: Any, path: str) -> Any:
    for name in path.split(".") if path else []:
        value = value.get(name) if isinstance(value, dict) else None
    return value


def items(fetch: Fetch, target: str, paging: Paging, most: int = 0) -> Iterator[Any]:
    """Items of a target over all its pages, or the first `most`; a page without items ends the list by number and offset."""
    number, token, taken = 1, None, 0
    while True:
        page = fetch(target, {"page": number, "after": token, "start": taken})
        if paging.way == "cursor" and not _at(page, paging.ok):
            return
        found = _at(page, paging.items) or []
        for item in found:
            yield item
            taken += 1
            if most and taken >= most:
                return
        number += 1
        if paging.way == "number":
            more = bool(found)
        elif paging.way == "offset":
            more = bool(found) and taken < (_at(page, paging.total) or 0)
        else:
            token = _at(page, paging.next)
            more = bool(token)
        if not more:
            return


def read(targets: DataFrame, fetch: Fetch, paging: Paging, most: int = 0, attempts: int = 5, base: float = 2.0) -> DataFrame:
    """Rows target, pos, content, error of all items of all targets (column target).

    Targets are spread over the tasks and read one page at a time. A page that
    fails is asked for again; a target that keeps failing has a last row with
    its error and no content, and the others go on. Repeated targets are read once.
    """
    schema = "target string, pos long, content string, error string"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = retry(attempts=attempts, base=base)(fetch)

        def rows(target: str) -> Iterator[tuple]:
            pos = 0
            try:
                for item in items(again, target, paging, most):
                    yield target, pos, json.dumps(item, ensure_ascii=False), None
                    pos += 1
            except Exception as e:  # a broken target must not stop the rest
                yield target, pos, None, f"{type(e).__name__}: {e}"[:500]

        for b in it:
            for target in b.column(0).to_pylist():
                chunk: list[tuple] = []
                for row in rows(target):
                    chunk.append(row)
                    if len(chunk) == 1000:
                        yield _batch(chunk)
                        chunk = []
                yield _batch(chunk)

    return targets.select(F.col("target").cast("string")).where("target is not null").distinct().mapInArrow(batches, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["target", "pos", "content", "error"])
