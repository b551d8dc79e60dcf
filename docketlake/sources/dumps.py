"""Search dumps as a Spark data source, for batch and for streams.

``spark.read.format("search_dumps").load(folder)`` has a row a result with the scope and position of its page file, dump_<scope>_<position>.json. A scope, given as an option
or by an equality filter, is pushed down to the listing: other scopes' files are not opened. A stream goes on, for each scope, behind the position that it has read;
pages come in the order of their positions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition

from docketlake.session import ship

FIELDS = {"documentId": str, "title": str, "docketId": str, "agencyAcronym": str, "documentType": str, "documentStatus": str, "attachmentCount": int}
SCHEMA = "scope string, position long, documentId string, title string, docketId string, agencyAcronym string, documentType string, documentStatus string, attachmentCount int"
_ARROW = pa.schema([("scope", pa.string()), ("position", pa.int64()), *((f, pa.int32() if t is int else pa.string()) for f, t in FIELDS.items())])


def register(spark: SparkSession) -> None:
    """Makes the source known to the session, and lets filters reach it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SearchDumps)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def pages(path: str, scope: str | None = None) -> list[tuple[str, int, str]]:
    """(scope, position, name) of the page files, by scope and position."""
    store, folder = _file_system(path)
    named = re.compile(r"dump_(.+)_(\d+)\.json")
    found = [(m[1], int(m[2]), f.base_name) for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if (m := named.fullmatch(f.base_name))]
    return sorted(x for x in found if scope is None or x[0] == scope)


def results(content: bytes) -> list[dict]:
    """The results of a page in either form: a list, or in the older one a single object too."""
    page = json.loads(content)
    if isinstance(page.get("documents"), list):
        return page["documents"]
    found = ((page.get("searchresult") or {}).get("documents") or {}).get("document") or []
    return found if isinstance(found, list) else [found]


class Page(InputPartition):
    def __init__(self, path: str, scope: str, position: int, name: str):
        self.path, self.scope, self.position, self.name = path, scope, position, name


def _read(page: Page | None) -> Iterator[pa.RecordBatch]:
    if page is None:  # no page at all
        return
    store, folder = _file_system(page.path)
    with store.open_input_stream(f"{folder}/{page.name}") as f:
        found = results(f.read())
    as_is = lambda v, t: None if v is None else t(v) if t is int else v if isinstance(v, str) else json.dumps(v)
    yield pa.RecordBatch.from_pylist([{"scope": page.scope, "position": page.position} | {f: as_is(r.get(f), t) for f, t in FIELDS.items()} for r in found], _ARROW)


class _Batch(DataSourceReader):
    def __init__(self, path: str, scope: str | None):
        self.path, self.scope, self.none = path, scope, False

    def pushFilters(self, filters):  # noqa: N802
        """Takes equality of the scope; gives the rest back."""
        for x in filters:
            if isinstance(x, EqualTo) and x.attribute == ("scope",):
                self.none = self.none or self.scope not in (None, x.value)
                self.scope = x.value
            else:
                yield x

    def partitions(self) -> list[Page]:
        found = [] if self.none else pages(self.path, self.scope)
        if not found and not self.none:
            raise FileNotFoundError(f"no dump_{self.scope or '*'}_*.json in {self.path}")
        return [Page(self.path, *p) for p in found]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, path: str, scope: str | None):
        self.path, self.scope = path, scope

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return {s: p for s, p, _ in pages(self.path, self.scope)}  # the last of a scope is its largest

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return [Page(self.path, s, p, n) for s, p, n in pages(self.path, self.scope) if start.get(s, -1) < p <= end.get(s, -1)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        return _read(partition)

    def commit(self, end: dict) -> None:
        """Nothing to be let go: pages stay where they are."""


class SearchDumps(DataSource):
    """Options: path, and scope (all scopes where it is not given). No page of a scope is an error in a batch; a stream waits for it."""

    @classmethod
    def name(cls) -> str:
        return "search_dumps"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options["path"], self.options.get("scope"))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _Stream(self.options["path"], self.options.get("scope"))
