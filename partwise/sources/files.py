"""Opening files in a task: local and mounted paths, and whatever pyarrow.fs knows."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from typing import BinaryIO

from partwise.limits import READ_BUFFER

# Schemes a task can read; what pyarrow.fs has besides plain files.
READABLE_SCHEMES = ["file", "s3", "s3a", "s3n", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss"]

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.\-]*:")


def local_path(url: str) -> str | None:
    """Path of a file URL or plain path, else None."""
    if not _SCHEME.match(url):
        return url
    if not url.lower().startswith("file:"):
        return None
    rest = url[len("file:") :]
    if rest.startswith("//"):
        rest = rest[2:].removeprefix("localhost")
    return rest


def filesystem_of(url: str):
    """(pyarrow file system, path in it, what comes before such a path in a URL)."""
    from pyarrow import fs

    path = local_path(url)
    if path is not None:
        return fs.LocalFileSystem(), path, ""
    scheme = url.split("://", 1)[0]
    filesystem, name = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", url))
    prefix = f"{scheme}://"
    if scheme == "hdfs":  # its paths do not hold the host
        prefix += url.split("://", 1)[1].split("/", 1)[0]
    return filesystem, name, prefix


def open_read(url: str) -> BinaryIO:
    path = local_path(url)
    if path is not None:
        return open(path, "rb")
    filesystem, name, _ = filesystem_of(url)
    return filesystem.open_input_file(name)


def read_range(f: BinaryIO, start: int, end: int, buffer: int = READ_BUFFER) -> Iterator[bytes]:
    """The bytes of [start, end), less where the file ends before."""
    f.seek(start)
    left = end - start
    while left > 0:
        data = f.read(min(buffer, left))
        if not data:
            return
        left -= len(data)
        yield data


# What opening a file may end with where there is no such file to read: a folder, or rights that changed, too.
NOT_READABLE = (FileNotFoundError, IsADirectoryError, NotADirectoryError, PermissionError)


class Reader:
    """Keeps the last file open: the ranges of one object come one after the other."""

    def __init__(self) -> None:
        self._url: str | None = None
        self._file: BinaryIO | None = None

    def open(self, url: str) -> BinaryIO:
        if url != self._url:
            self.close()
            self._file = open_read(url)
            self._url = url
        return self._file

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._url = self._file = None


def partial_path(path: str) -> str:
    """Hidden name of a file that is not complete yet."""
    folder, name = os.path.split(path)
    return os.path.join(folder, f".{name}.partial")
