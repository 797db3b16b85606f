"""A data source of JSON array files: a row per element, and a named error row per bad file.

Batch and stream read the same rows: ``file, position, element`` (the element as JSON text) and
``error``, null but for a file that can't be read, is not JSON, or holds no array; such a file
gives one row and no elements. The stream's offset is the time and path of the newest file
taken; files that appear later with an older time are not seen.

Paths are local, or of a store that Arrow's file systems reach (``hdfs://``, ``s3://``, ``gs://``).
A task holds one file at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file string, position int, element string, error string"
#: Bytes of files in one task.
TASK_BYTES = 32 << 20


@dataclass
class Files(InputPartition):
    """Files of one task."""

    paths: list[str]


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)


def listed(folder: str, suffix: str) -> list[tuple[int, str, int]]:
    """(time, path, size) of the files of a folder tree, hidden ones left out, oldest first."""
    store, root = store_of(folder)
    infos = store.get_file_info(fs.FileSelector(root, recursive=True))
    hidden = lambda path: any(p.startswith(("_", ".")) for p in path[len(root):].split("/"))
    return sorted((i.mtime_ns or 0, i.path, i.size) for i in infos if i.type == fs.FileType.File and i.path.endswith(suffix) and not hidden(i.path))


def dealt(files: list[tuple[int, str, int]], limit: int) -> list[Files]:
    """Files in tasks of about ``limit`` bytes."""
    out, held = [], 0
    for _, path, size in files:
        if not out or held + size > limit:
            out.append(Files([]))
            held = 0
        out[-1].paths.append(path)
        held += size
    return out


def elements(folder: str, path: str) -> Iterator[tuple]:
    """The rows of one file."""
    store, _ = store_of(folder)
    try:
        with store.open_input_file(path) as file:
            held = json.loads(file.readall().decode("utf-8-sig"))
        if not isinstance(held, list):
            raise ValueError(f"holds {type(held).__name__}, not an array")
    except (OSError, ValueError, RecursionError) as error:
        yield path, None, None, f"{type(error).__name__}: {error}"
        return
    for k, element in enumerate(held):
        yield path, k, json.dumps(element, ensure_ascii=False), None


class _Reading:
    def __init__(self, options: dict):
        self.folder, self.suffix = options["path"], options.get("suffix", ".json")
        self.limit = int(options.get("taskBytes", TASK_BYTES))

    def read(self, partition: Files) -> Iterator[tuple]:
        for path in partition.paths:
            yield from elements(self.folder, path)


class ArrayFileReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Files]:
        return dealt(listed(self.folder, self.suffix), self.limit) or [Files([])]


class ArrayFileStream(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = listed(self.folder, self.suffix)
        return {"time": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        place = lambda o: (o["time"], o["path"])
        return dealt([f for f in listed(self.folder, self.suffix) if place(start) < f[:2] <= place(end)], self.limit) or [Files([])]

    def commit(self, end: dict) -> None:
        pass


class ArrayFiles(DataSource):
    """``spark.read.format("array_files").load(folder)``; options ``suffix`` and ``taskBytes``."""

    @classmethod
    def name(cls) -> str:
        return "array_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArrayFileReader:
        return ArrayFileReader(self.options)

    def streamReader(self, schema) -> ArrayFileStream:
        return ArrayFileStream(self.options)
