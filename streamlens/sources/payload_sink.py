"""Payload files as a committing sink (S13, S14), batch and stream.

``spark.dataSource.register(PayloadFiles)`` adds the format ``payload_files``:
rows of (name, data), one file each below the option ``path``.

Tasks write below ``path/_staging`` only, each attempt in a folder of its own.
The commit puts a job's folders together there and makes them visible by one
rename, to ``batch=<id>`` of a stream or ``job=<id>`` of a batch write (a rename
of a folder is atomic on HDFS and local disks; object stores copy).  A failed
task, a lost executor's attempt or an aborted job leaves no visible file, and a
micro-batch that is delivered again finds its folder there and changes nothing.

Rows without data are left out.  A name must be a file name without a path
(``media.stored_name`` makes one that keeps records apart); a repeated name of
one task is one file.  ``path`` must be shared by driver and executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from streamlens.sources.files import filesystem

_STAGING = "_staging"


@dataclass
class Staged(WriterCommitMessage):
    """What one task has written: the number of its folder and of its files."""
    folder: str
    files: int


class _Files:
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, rows: Iterator) -> Staged:
        fs, base = filesystem(self.path)
        folder, files = uuid.uuid4().hex, 0
        at = f"{base}/{_STAGING}/{folder}"
        fs.create_dir(at, recursive=True)
        try:
            for name, data in rows:
                if data is None:
                    continue
                if not name or "/" in name or "\\" in name or name.startswith((".", "_")):
                    raise ValueError(f"not a plain file name: {name!r}")
                with fs.open_output_stream(f"{at}/{name}") as out:
                    out.write(bytes(data))
                files += 1
        except BaseException:
            fs.delete_dir(at)
            raise
        return Staged(folder, files)

    def publish(self, messages: list, name: str) -> None:
        from pyarrow import fs as arrow
        fs, base = filesystem(self.path)
        if fs.get_file_info(f"{base}/{name}").type != arrow.FileType.NotFound:
            self.discard(messages)  # delivered again
            return
        ready = f"{base}/{_STAGING}/ready-{uuid.uuid4().hex}"
        fs.create_dir(ready, recursive=True)
        for m in messages:
            if m is not None and m.files:
                fs.move(f"{base}/{_STAGING}/{m.folder}", f"{ready}/{m.folder}")  # one rename a task
        fs.move(ready, f"{base}/{name}")
        self.discard([m for m in messages if m is not None and not m.files])

    def discard(self, messages: list) -> None:
        from pyarrow import fs as arrow
        fs, base = filesystem(self.path)
        for m in messages:
            if m is not None and fs.get_file_info(f"{base}/{_STAGING}/{m.folder}").type != arrow.FileType.NotFound:
                fs.delete_dir(f"{base}/{_STAGING}/{m.folder}")


class BatchWriter(_Files, DataSourceWriter):
    def commit(self, messages: list) -> None:
        self.publish(messages, f"job={uuid.uuid4().hex}")

    def abort(self, messages: list) -> None:
        self.discard(messages)


class StreamWriter(_Files, DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, f"batch={batchId}")

    def abort(self, messages: list, batchId: int) -> None:
        self.discard(messages)


class PayloadFiles(DataSource):
    """The data source; option ``path`` is the folder."""

    @classmethod
    def name(cls) -> str:
        return "payload_files"

    def schema(self) -> str:
        return "name string, data binary"

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options["path"])

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options["path"])
