"""Bytes of files, read and written inside tasks: by the operating system on a
mounted file system, on any other store through its Arrow file system."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyarrow import fs

BLOCK_BYTES = 4 << 20


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified name, and the path in it. Special characters
    of a local name stand as they are."""
    local = re.fullmatch(r"file:(?://[^/]*)?(/.*)", uri, re.DOTALL)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(uri)


def blocks(file, begin: int, end: int) -> Iterator[bytes]:
    """The bytes from `begin` to before `end` of an open file, in blocks."""
    file.seek(begin)
    while begin < end:
        data = file.read(min(BLOCK_BYTES, end - begin))
        if not data:
            raise OSError("a file is shorter than it was when it was listed")
        begin += len(data)
        yield data


def line_start(file, position: int, length: int) -> int:
    """Where the first line that begins at or after `position` begins; the length of
    the file if none does."""
    if position <= 0:
        return 0
    at = position - 1
    for data in blocks(file, at, length):
        found = data.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(data)
    return length
