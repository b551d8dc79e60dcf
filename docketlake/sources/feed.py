"""The search feed as a Spark data sink for streams: a batch's lines and the ids to be flagged appear together, once, or not at all.

Tasks write what they have under names of their own to a folder of what is pending; one stream writes to a path at a time. A commit moves the files of the tasks that
counted to the batch's place and then marks the batch as done; a batch that is done already is dropped, so none is fed twice. An abort, and every
commit, removes what else is pending.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from docketlake.session import ship
from docketlake.sources.dumps import _file_system


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(SearchFeed)


@dataclass
class Written(WriterCommitMessage):
    """The files of one task, by what they are: lines or ids."""

    lines: list[str]
    ids: list[str]


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str, batch: int):
        self.path, self.batch = path.rstrip("/"), batch

    @staticmethod
    def _pending(folder: str) -> str:
        return f"{folder}/_pending"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows are (doc_id, value: a record's lines, null where it is not fed). A task that fails takes its files with it."""
        store, folder = _file_system(self.path)
        store.create_dir(self._pending(folder), recursive=True)
        told, name = Written([], []), uuid.uuid4().hex
        lines: list[str] = []

        def flush(least: int) -> None:
            while len(lines) >= least and lines:
                told.lines.append(f"{name}-{len(told.lines)}.txt")
                with store.open_output_stream(f"{self._pending(folder)}/{told.lines[-1]}") as f:
                    f.write("".join(x + "\n" for x in lines[: self.batch]).encode())
                del lines[: self.batch]

        ids = None
        try:
            for rows in iterator:
                if ids is None:
                    told.ids.append(f"{name}.parquet")
                    ids = pq.ParquetWriter(f"{self._pending(folder)}/{told.ids[-1]}", pa.schema([rows.schema.field("doc_id")]), filesystem=store)
                ids.write_batch(rows.select(["doc_id"]))
                lines += [v for v in rows.column("value").to_pylist() if v is not None]
                flush(self.batch)
            flush(1)
        except BaseException:
            for x in [*told.lines, *told.ids]:
                if store.get_file_info(f"{self._pending(folder)}/{x}").type != fs.FileType.NotFound:
                    store.delete_file(f"{self._pending(folder)}/{x}")
            raise
        finally:
            if ids is not None:
                ids.close()
        return told

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        store, folder = _file_system(self.path)
        done = f"{folder}/_done/{batchId}"
        if store.get_file_info(done).type == fs.FileType.NotFound:
            for kind, place in (("lines", folder), ("ids", f"{folder}-processed")):
                to = f"{place}/batch={batchId}"
                store.create_dir(to, recursive=True)
                store.delete_dir_contents(to)  # of a commit that broke off
                for m in messages:
                    for x in getattr(m, kind) if m else []:
                        store.move(f"{self._pending(folder)}/{x}", f"{to}/{x}")
            store.create_dir(f"{folder}/_done", recursive=True)
            with store.open_output_stream(done):
                pass
        self.abort(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        store, folder = _file_system(self.path)
        if store.get_file_info(self._pending(folder)).type != fs.FileType.NotFound:
            store.delete_dir(self._pending(folder))


class SearchFeed(DataSource):
    """Options: path, and batch (records a file, 200)."""

    @classmethod
    def name(cls) -> str:
        return "search_feed"

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:  # noqa: N802
        return _Writer(self.options["path"], int(self.options.get("batch", 200)))
