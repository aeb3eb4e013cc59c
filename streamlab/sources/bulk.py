"""A Spark sink for systems that take rows in bulks: text files, written by tasks and published by a commit.

``df.write.format("bulk_text")`` and ``writeStream`` write the column ``value`` as lines. A task sends its rows in
bulks to a staged file of its own attempt; only files that the driver's commit is told of are moved to their place.
So a failed task or job leaves nothing, a retried or doubled attempt adds nothing, and a micro-batch that runs again
replaces what it wrote before.

Options: ``path`` (any folder that pyarrow's file systems reach from all executors) and ``bulk`` (rows at a time).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

# Rows that the target systems take at a time.
DOCUMENTS_BULK = 10
POINTS_BULK = 2000

STAGED = "_staged"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Sent(WriterCommitMessage):
    """What a task wrote: its staged file, rows and bulks."""

    staged: str
    rows: int
    bulks: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is a file's."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _delete(files: fs.FileSystem, folder: str) -> None:
    if files.get_file_info(folder).type == fs.FileType.Directory:
        files.delete_dir(folder)


class _Bulks:
    """Staging in tasks, publishing on the driver; one object is one job."""

    def __init__(self, path: str, bulk: int, overwrite: bool):
        self.path, self.bulk, self.overwrite = path, bulk, overwrite
        self.job = uuid.uuid4().hex
        # Made here and not by tasks: one that is still running when its job is given up finds no folder.
        files, root = _open(path)
        files.create_dir(f"{root}/{STAGED}/{self.job}", recursive=True)

    def send(self, batches: Iterator[pa.RecordBatch]) -> Sent:
        files, root = _open(self.path)
        name = f"{root}/{STAGED}/{self.job}/{uuid.uuid4().hex}.txt"
        rows = bulks = 0
        waiting: list[str] = []
        with files.open_output_stream(name) as out:

            def flush() -> None:
                nonlocal rows, bulks
                if waiting:
                    out.write("".join(f"{v}\n" for v in waiting).encode())
                    rows, bulks = rows + len(waiting), bulks + 1
                    waiting.clear()

            for batch in batches:
                for value in batch.column("value").to_pylist():
                    if value is not None:
                        waiting.append(value)
                        if len(waiting) == self.bulk:
                            flush()
            flush()
        return Sent(name, rows, bulks)

    def publish(self, messages: list, folder: str, prefix: str, clear: bool) -> None:
        """Moves the files of the attempts that count; files in ``folder`` go first if ``clear``."""
        files, root = _open(self.path)
        if clear:
            for info in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if info.type == fs.FileType.File:
                    files.delete_file(info.path)
        files.create_dir(folder, recursive=True)
        for n, message in enumerate(messages):
            if message is not None and message.rows:
                files.move(message.staged, f"{folder}/{prefix}{n:05d}.txt")

    def discard(self) -> None:
        files, root = _open(self.path)
        _delete(files, f"{root}/{STAGED}/{self.job}")


class BulkWriter(_Bulks, DataSourceArrowWriter):
    """One job; append adds files of a new name, overwrite replaces the folder's files once all tasks are done."""

    def write(self, iterator):
        return self.send(iterator)

    def commit(self, messages):
        self.publish(messages, _open(self.path)[1], f"part-{self.job}-", self.overwrite)
        self.discard()

    def abort(self, messages):
        self.discard()


class BulkStreamWriter(_Bulks, DataSourceStreamArrowWriter):
    """Each micro-batch owns the folder ``batch=N``."""

    def write(self, iterator):
        return self.send(iterator)

    def commit(self, messages, batchId):
        files, root = _open(self.path)
        self.publish(messages, f"{root}/batch={batchId}", "part-", True)
        files.delete_dir_contents(f"{root}/{STAGED}/{self.job}")  # the next micro-batch stages there

    def abort(self, messages, batchId):
        self.discard()


class BulkText(DataSource):
    """Rows with the text column ``value``; a null value is no row, as a line cannot be null."""

    @classmethod
    def name(cls):
        return "bulk_text"

    def _arguments(self, schema: StructType) -> tuple[str, int]:
        if schema.fieldNames() != ["value"] or not isinstance(schema["value"].dataType, StringType):
            raise ValueError("bulk_text writes one text column named value")
        path, bulk = self.options.get("path"), int(self.options.get("bulk", POINTS_BULK))
        if not path or bulk < 1:
            raise ValueError("bulk_text needs a path and bulks of at least one row")
        return path.rstrip("/"), bulk

    def writer(self, schema, overwrite):
        return BulkWriter(*self._arguments(schema), overwrite)

    def streamWriter(self, schema, overwrite):
        return BulkStreamWriter(*self._arguments(schema), overwrite)


def register_bulk_text(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(BulkText)
