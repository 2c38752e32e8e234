"""A Python data source for landed items: one document per file, in batches and streams.

spark.dataSource.register(LandedItems); spark.read.format("landed_items").load(folder).
Options: suffix (.json), page (files per partition). The folder is a local path
or any address that Arrow's file systems read. Files are listed on the driver
and read in the tasks. A stream goes by the time at which files landed: an item
that lands later is taken whatever its key.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from fathomgrid.sources.tables import file_system

SCHEMA = "key string, content string"


def _listed(folder: str, suffix: str) -> list[tuple[int, str]]:
    """Landing time and key of the items of a folder, in order; descriptions are no items."""
    system, root = file_system(folder)
    found = []
    for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        name = info.path.rpartition("/")[2]
        if info.is_file and name.endswith(suffix) and not name.startswith("_"):
            found.append((info.mtime_ns or 0, info.path[len(root) + 1 :]))
    return sorted(found)


class Page(InputPartition):
    def __init__(self, keys: list[str]):
        self.keys = keys


class _Landed:
    """Options, and reading of a page."""

    def __init__(self, options: dict):
        self.folder, self.suffix, self.page = options["path"], options.get("suffix", ".json"), int(options.get("page", 1000))

    def pages(self, keys: list[str]) -> list[InputPartition]:
        return [Page(keys[i : i + self.page]) for i in range(0, len(keys), self.page)] or [Page([])]

    def read(self, partition: Page) -> Iterator[tuple]:
        system, root = file_system(self.folder)
        for key in partition.keys:
            with system.open_input_stream(f"{root}/{key}") as f:
                yield key, f.read().decode("utf-8", "replace")


class LandedReader(_Landed, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.pages([k for _, k in _listed(self.folder, self.suffix)])


class LandedStream(_Landed, DataSourceStreamReader):
    """Offsets hold the latest landing time taken and the keys taken of that time, as several files can land in one tick."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"at": 0, "taken": []}

    def latestOffset(self) -> dict:  # noqa: N802
        found = _listed(self.folder, self.suffix)
        if not found:
            return self.initialOffset()
        at = found[-1][0]
        return {"at": at, "taken": [k for t, k in found if t == at]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, last = set(start["taken"]), set(end["taken"])
        new = [k for t, k in _listed(self.folder, self.suffix) if (t > start["at"] or t == start["at"] and k not in before) and (t < end["at"] or t == end["at"] and k in last)]
        return self.pages(new)


class LandedItems(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_items"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return LandedReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ANN001, N802
        return LandedStream(dict(self.options))
