"""Files found by listing folders, on executors, as a data source: one partition per share of the folders.

Spark's own file sources leave out files of zero length; this one lists every file. The planner lists folders one at a time, widest level
first, until there are enough of them to share out; what lies below them is listed by the tasks. So neither the planner nor
a task sees more than its share of the tree, whatever the depth of the folders.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, modificationTime timestamp, length bigint"
_FIELDS = pa.schema(
    [("path", pa.string()), ("modificationTime", pa.timestamp("us", tz="UTC")), ("length", pa.int64())]
)
# Folders the planner looks for, and rows of a batch.
FOLDERS = 256
BATCH = 10_000


def file_system(root: str) -> tuple[fs.FileSystem, str, str]:
    """File system of a path or URI, the path in it, and what its paths begin with in Spark's spelling."""
    scheme, colon, rest = root.partition(":/")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else root).strip("/"), "file:"
    found, path = fs.FileSystem.from_uri(root)
    return found, path.rstrip("/"), root[: len(root.rstrip("/")) - len(path.strip("/"))].rstrip("/") + "/" * (path[:1] != "/")


def reachable(root: str) -> bool:
    """Whether Python's file systems know this kind of path; others are left to Spark's own sources."""
    try:
        file_system(root)
    except (OSError, ValueError, pa.ArrowException, ImportError):
        return False
    return True


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


def _entries(files: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """What a folder holds, but for hidden entries. A folder that is gone by now holds nothing."""
    listed = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return [one for one in listed if not _hidden(one.base_name)]


def shares(files: fs.FileSystem, root: str, wanted: int) -> list[tuple[str, bool]]:
    """Folders that together hold the tree: each with everything below it, or only with its own files."""
    waiting, opened = deque([root]), []
    while waiting and len(waiting) < wanted:
        folder = waiting.popleft()
        opened.append((folder, False))
        waiting.extend(sorted(one.path for one in _entries(files, folder) if one.type == fs.FileType.Directory))
    return opened + [(folder, True) for folder in waiting]


def walk(files: fs.FileSystem, folder: str, below: bool) -> Iterator[fs.FileInfo]:
    """Files of a folder, and of those below it; one folder is held at a time."""
    waiting = [folder]
    while waiting:
        for one in _entries(files, waiting.pop()):
            if one.type == fs.FileType.File:
                yield one
            elif one.type == fs.FileType.Directory and below:
                waiting.append(one.path)


@dataclass
class Share(InputPartition):
    folders: list[tuple[str, bool]]

    def __init__(self, folders: list[tuple[str, bool]]):
        self.folders = folders


class FileListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.pattern = options.get("pattern", "*")
        self.wanted = int(options.get("folders", FOLDERS))
        after = options.get("modifiedafter") or options.get("modifiedAfter")
        self.after = datetime.fromisoformat(after).replace(tzinfo=timezone.utc) if after else None

    def partitions(self) -> list[InputPartition]:
        files, path, _ = file_system(self.root)
        found = shares(files, path, self.wanted)
        # Neighbouring folders go to different tasks: sites differ in size.
        return [Share(found[k :: self.wanted]) for k in range(min(self.wanted, len(found)))]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        files, _, prefix = file_system(self.root)
        held: list[fs.FileInfo] = []
        for folder, below in partition.folders:
            for one in walk(files, folder, below):
                if fnmatchcase(one.base_name, self.pattern) and (self.after is None or one.mtime > self.after):
                    held.append(one)
                if len(held) >= BATCH:
                    yield self._rows(held, prefix)
                    held = []
        if held:
            yield self._rows(held, prefix)

    @staticmethod
    def _rows(found: list[fs.FileInfo], prefix: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([f"{prefix}{one.path}" for one in found], pa.string()),
                pa.array([one.mtime_ns // 1000 for one in found], pa.int64()).cast(_FIELDS.field(1).type),
                pa.array([one.size for one in found], pa.int64()),
            ],
            schema=_FIELDS,
        )


class FileListing(DataSource):
    """``spark.read.format("file_listing").option("pattern", "*.txt").load(root)``."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FileListingReader:
        return FileListingReader(dict(self.options))


def list_files(spark: SparkSession, root: str, pattern: str = "*", modified_after: str | None = None, folders: int = FOLDERS):
    """``path, modificationTime, length`` of every file below ``root`` whose name matches, empty ones too.

    Entries whose name starts with a dot or an underscore are left out, as by Spark's readers. ``modified_after`` is in UTC.
    """
    spark.dataSource.register(FileListing)
    reader = spark.read.format(FileListing.name()).option("pattern", pattern).option("folders", folders)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(root)
