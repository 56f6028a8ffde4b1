"""Files in the shared folder, written and read by tasks through Arrow's file systems."""

from __future__ import annotations

import uuid
from typing import BinaryIO

import pyarrow.fs as pafs


def _split(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class Output:
    """A file that a task writes under a name of its own attempt.

    Only names that a task has returned are ever read, and Spark takes the rows of one attempt of each task, so files of
    lost or repeated attempts are never seen.
    """

    def __init__(self, folder: str, suffix: str) -> None:
        fs, base = _split(folder)
        fs.create_dir(base, recursive=True)
        name = uuid.uuid4().hex + suffix
        self.path = f"{folder.rstrip('/')}/{name}"
        self.stream = fs.open_output_stream(f"{base.rstrip('/')}/{name}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> str:
        self.stream.close()
        return self.path


def open_input(path: str) -> BinaryIO:
    fs, name = _split(path)
    return fs.open_input_file(name)
