"""A sink of files that are named by what they hold."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, given as a URI or as a path, and the folder's path there."""
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


@dataclass
class Written(WriterCommitMessage):
    files: int


class ContentWriter(DataSourceWriter):
    """Writes each row's body and its gzip, which is the same bytes for the same body. Files get
    their names when they are whole; one that is there is left alone, so tasks may be repeated
    and run twice at once."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        system, base = store(self.folder)
        n = 0
        for row in iterator:
            data = row["body"].encode()
            for name, content in ((row["name"], data), (row["name"] + ".gz", gzip.compress(data, 9, mtime=0))):
                path = f"{base}/{name}"
                if system.get_file_info(path).type == fs.FileType.NotFound:
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    part = f"{path}.{uuid.uuid4().hex}.part"
                    with system.open_output_stream(part, compression=None) as out:
                        out.write(content)
                    system.move(part, path)
                    n += 1
        return Written(n)

    def commit(self, messages: list) -> None:
        pass

    def abort(self, messages: list) -> None:
        pass


class ContentFiles(DataSource):
    """Rows (name, body) as files below the option `folder`."""

    @classmethod
    def name(cls) -> str:
        return "content_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if sorted(schema.names) != ["body", "name"]:
            raise ValueError("content_files takes rows of name and body")
        return ContentWriter(self.options["folder"])
