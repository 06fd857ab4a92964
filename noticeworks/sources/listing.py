"""A data source that lists files: path, length and modification time, without opening any of them.

The folders below the root are listed by the driver and dealt out; tasks list what lies in them. Any store that pyarrow
knows can be listed: a plain path, or file://, hdfs://, s3:// or gs:// addresses.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow.fs import FileInfo, FileSelector, FileSystem, FileType
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Folders that one task lists, unless the option says otherwise.
FOLDERS = 500


@dataclass
class Folders(InputPartition):
    paths: list[str]


def opened(root: str) -> tuple[FileSystem, str]:
    # The one-slash form is how Spark shows local paths.
    return FileSystem.from_uri(root.replace("file:/", "file:///", 1) if root.startswith("file:/") and root[6:7] != "/" else root)


def _shown(info: FileInfo) -> bool:
    """Whether it is a file that Spark's own sources would show: names with ``_`` or ``.`` in front are left out."""
    return info.type == FileType.File and not info.base_name.startswith(("_", "."))


class Listing(DataSource):
    """``spark.read.format("file_listing").load(root)`` after ``spark.dataSource.register(Listing)``; option ``folders``:
    how many of them a task lists."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return "path string, length long, modificationTime timestamp"

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options["path"], int(self.options.get("folders", FOLDERS)))


class ListingReader(DataSourceReader):
    def __init__(self, root: str, folders: int):
        self.root, self.folders = root, folders

    def partitions(self) -> list[Folders]:
        fs, root = opened(self.root)
        entries = fs.get_file_info(FileSelector(root))
        folders = sorted(x.path for x in entries if x.type == FileType.Directory)
        files = [x.path for x in entries if _shown(x)]
        dealt = [Folders(folders[k : k + self.folders]) for k in range(0, len(folders), self.folders)]
        return [*dealt, Folders(files)] if files or not dealt else dealt

    def read(self, partition: Folders) -> Iterator[tuple]:
        fs, _ = opened(self.root)
        for info in fs.get_file_info(partition.paths):
            yield from self._below(fs, info)

    def _below(self, fs: FileSystem, info: FileInfo) -> Iterator[tuple]:
        if info.type == FileType.File:
            yield info.path, info.size, info.mtime
        elif info.type == FileType.Directory:
            for found in fs.get_file_info(FileSelector(info.path, recursive=True)):
                if _shown(found):
                    yield found.path, found.size, found.mtime
