"""Source files below a folder as a Spark data source: ``spark.read.format("source_tree").option("root", uri)``.

Columns: file (relative to the root), content. Folders are listed one by one, in tasks but for the first levels, and a skipped folder is never
listed, nor a file in it opened. Rows come in path order, part by part. Options: ``extension``, ``exclude`` (needles, with commas),
``partitions`` (so many, about).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Folders that a scan passes by, besides dotted ones.
SKIPPED = ("__pycache__", "target", "node_modules", "tests", "test")


def _filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/").rstrip("/")
    return fs.FileSystem.from_uri(uri.rstrip("/")) if "://" in uri else (fs.LocalFileSystem(), uri.rstrip("/"))


class _Part(InputPartition):
    def __init__(self, entries: list[tuple[str, bool]]):
        self.entries = entries


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.parts = options["root"], int(options.get("partitions", 8))
        self.extension, self.exclude = options.get("extension", ""), [x for x in options.get("exclude", "").split(",") if x]

    def entries(self, fs, folder: str) -> list[tuple[str, bool]]:
        """(path, whether it is a folder) of what counts in a folder, in order."""
        from pyarrow.fs import FileSelector, FileType

        found = fs.get_file_info(FileSelector(folder, allow_not_found=True))
        kept = [(i.path, i.type == FileType.Directory) for i in found if not i.base_name.startswith(".") and i.base_name not in SKIPPED]
        return sorted((p, d) for p, d in kept if d or p.endswith("." + self.extension if self.extension else ""))

    def partitions(self) -> list[_Part]:
        fs, root = _filesystem(self.root)
        level = self.entries(fs, root)
        # folder by folder, as few levels as make enough parts
        while len(level) < self.parts and any(d for _, d in level):
            level = [x for p, d in level for x in (self.entries(fs, p) if d else [(p, d)])]
        step = max(1, -(-len(level) // self.parts))
        return [_Part(level[i : i + step]) for i in range(0, len(level), step)] or [_Part([])]

    def walk(self, fs, entries: list[tuple[str, bool]]) -> Iterator[str]:
        for path, folder in entries:
            if folder:
                yield from self.walk(fs, self.entries(fs, path))
            else:
                yield path

    def read(self, partition: _Part):
        fs, root = _filesystem(self.root)
        for path in self.walk(fs, partition.entries):
            if not any(x in path for x in self.exclude):
                with fs.open_input_stream(path) as f:
                    yield path[len(root) + 1 :], f.read()


class SourceTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "source_tree"

    def schema(self) -> str:
        return "file string, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
