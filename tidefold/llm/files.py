"""Binary files in the shared folder, written from tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path below it for a local path or a URI that pyarrow knows."""
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """One file under its final name once it is closed.

    A task writes under a name of its own and renames at the end; the bytes depend on the rows
    only, so a repeated or speculative task replaces a file by an equal one and nobody reads
    half of it.
    """

    def __init__(self, folder: str, name: str):
        self.fs, base = locate(folder)
        self.fs.create_dir(base, recursive=True)
        self.final = f"{base}/{name}"
        self.temporary = f"{base}/_{name}.{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.temporary)
        self.n_bytes = 0

    def write(self, data) -> None:
        self.stream.write(data)
        self.n_bytes += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.final)
