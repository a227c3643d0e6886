"""Files in tasks: chunk by chunk, on whatever file system pyarrow finds for a path."""

from __future__ import annotations

import hashlib
import io
from typing import Any

import pyarrow.fs as pafs

CHUNK = 1 << 22


def of(uri: str) -> tuple[pafs.FileSystem, str]:
    """A path's file system, and the path in it. ``file:/x``, as Spark spells local paths, too."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


class Hashed(io.RawIOBase):
    """A file that is written in order, with the digest and the length of what was."""

    def __init__(self, out: Any) -> None:
        super().__init__()
        self.out, self.hash, self.length = out, hashlib.sha256(), 0

    def writable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.length

    def write(self, data: Any) -> int:
        self.out.write(data)
        self.hash.update(data)
        self.length += memoryview(data).nbytes
        return memoryview(data).nbytes

    def close(self) -> None:
        if not self.closed:
            self.out.close()
        super().close()


def digest(fs: pafs.FileSystem, path: str) -> tuple[str, int]:
    """sha256 and bytes of a file, a chunk at a time."""
    found, length = hashlib.sha256(), 0
    with fs.open_input_stream(path, buffer_size=0) as f:
        while chunk := f.read(CHUNK):
            found.update(chunk)
            length += len(chunk)
    return found.hexdigest(), length


def copy(fs: pafs.FileSystem, path: str, to: pafs.FileSystem, target: str) -> tuple[str, int]:
    """Copies a file, a chunk at a time; sha256 and bytes of what was written."""
    with fs.open_input_stream(path, buffer_size=0) as f, Hashed(to.open_output_stream(target)) as out:
        while chunk := f.read(CHUNK):
            out.write(chunk)
        return out.hash.hexdigest(), out.length


def remove(fs: pafs.FileSystem, path: str) -> None:
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_file(path)
