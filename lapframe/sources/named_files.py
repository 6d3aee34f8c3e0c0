"""A data source that writes text files under names that its rows give.

Spark's own writers choose the names of files. Landed weather documents, centerlines and elevation
profiles are told apart by theirs, so this sink takes the name from a column.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """The files that one task has written, and where they wait."""

    folder: str
    names: list[str]


class NamedFilesWriter(DataSourceArrowWriter):
    """Tasks write aside; the commit moves files into place.

    What a task writes waits below ``_staging``, which Spark's readers skip, in a folder of that attempt. So a task
    that runs twice, or dies, shows nothing, and a failed job leaves the target as it was. The commit only moves
    files: it handles names, never contents. A file that stands under a name already is replaced.
    """

    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _open(self.path)
        folder = f"{root}/_staging/{self.job}/{uuid.uuid4().hex}"
        names: list[str] = []
        current, out = None, None
        try:
            for batch in iterator:
                for name, value in zip(batch.column(0), batch.column(1)):
                    name, value = name.as_py(), value.as_py()
                    if out is None or name != current:
                        if out is not None:
                            out.close()
                        _check(name)
                        system.create_dir(f"{folder}/{len(names)}", recursive=True)
                        out = system.open_output_stream(f"{folder}/{len(names)}/part")
                        names.append(name)
                        current = name
                    if value is not None:
                        out.write(value.encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        done = [m for m in messages if m is not None]
        names = [n for m in done for n in m.names]
        if len(names) != len(set(names)):
            raise ValueError("rows of one file lie apart; bring them together and sort them by its name")
        for folder in {n.rpartition("/")[0] for n in names}:
            system.create_dir(f"{root}/{folder}", recursive=True)
        for message in done:
            for i, name in enumerate(message.names):
                system.move(f"{message.folder}/{i}/part", f"{root}/{name}")
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, root = _open(self.path)
        folder = f"{root}/_staging/{self.job}"
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


def _check(name: str | None) -> None:
    """Names are paths below the target that Spark's readers will show."""
    parts = (name or "").split("/")
    if any(not p or p[0] in "._" for p in parts):
        raise ValueError(f"{name!r} does not name a file below the folder")


class NamedFiles(DataSource):
    """``df.write.format("named_files").mode("append").save(folder)`` with the columns name and line, in this order."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        if overwrite:
            raise ValueError("named files are replaced one by one; use the mode append")
        return NamedFilesWriter(self.options["path"])
