"""Files in the shared folder that tasks write and read by range."""

from __future__ import annotations

import os


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class AtomicFile:
    """A file that stands under its name only when it's whole: a second attempt of a task replaces the first."""

    def __init__(self, uri: str, attempt: int):
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.part = f"{self.path}.{attempt}.part"
        self.out = self.fs.open_output_stream(self.part)
        self.size = 0

    def write(self, data) -> None:
        self.out.write(data)
        self.size += memoryview(data).nbytes

    def close(self) -> None:
        from pyarrow import fs

        self.out.close()
        if self.fs.get_file_info(self.path).type != fs.FileType.NotFound:
            self.fs.delete_file(self.path)
        self.fs.move(self.part, self.path)
