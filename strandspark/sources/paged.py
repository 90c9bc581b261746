"""A paged interface as a data source: landed pages are read by ranges of page numbers, as many tasks as that takes.

    spark.dataSource.register(PagedJson)
    spark.read.format("paged_json").option("path", uri).load()

path holds page-0.json, page-1.json, ...; each page is an object with the count of all rows and an array of rows. The first
page says how many pages there are; no page beyond that is asked for. A page that is missing, is no JSON or has no rows gives
one row with its error instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Range(InputPartition):
    def __init__(self, first: int, end: int) -> None:
        self.first, self.end = first, end


def _page(path: str, k: int) -> dict:
    import pyarrow.fs

    store, base = pyarrow.fs.FileSystem.from_uri(path)
    with store.open_input_stream(f"{base}/page-{k}.json") as source:
        return json.loads(source.read())


class PagedJson(DataSource):
    """Columns page, place (of the row in its page), row (JSON text) and error. Options: path, rows and count (names
    within a page) and pages_per_task."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, place int, row string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.rows, self.count = options["path"], options.get("rows", "rows"), options.get("count", "count")
        self.at_once = max(1, int(options.get("pages_per_task", "16")))

    def partitions(self) -> list[InputPartition]:
        try:
            first = _page(self.path, 0)
            size, total = len(first[self.rows]), int(first[self.count])
        except (OSError, ValueError, KeyError, TypeError):
            return [_Range(0, 1)]  # its error is a row
        pages = max(1, -(-total // size)) if size else 1
        return [_Range(k, min(pages, k + self.at_once)) for k in range(0, pages, self.at_once)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        for k in range(partition.first, partition.end):
            try:
                rows = list(_page(self.path, k)[self.rows])
            except (OSError, ValueError, KeyError, TypeError) as wrong:
                yield (k, None, None, type(wrong).__name__)
                continue
            for place, row in enumerate(rows):
                yield (k, place, json.dumps(row), None)
