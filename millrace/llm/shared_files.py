"""Whole files in the shared folder, written by tasks and read as streams.

A task writes to a name of its own and then renames, so a task that runs again, or twice at once,
leaves one complete file.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import NativeFile, fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def make_folder(path: str) -> None:
    system, inner = located(path)
    system.create_dir(inner, recursive=True)


@contextlib.contextmanager
def new_file(path: str) -> Iterator[NativeFile]:
    """A file that appears under its name only when complete."""
    system, inner = located(path)
    folder, _, name = inner.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        yield out
    system.move(draft, inner)


def open_file(path: str) -> NativeFile:
    system, inner = located(path)
    return system.open_input_stream(inner, compression=None)


def read_exactly(stream, size: int) -> bytes:
    """``size`` bytes, or none at the very end; anything between is an error."""
    parts, left = [], size
    while left:
        part = stream.read(left)
        if not part:
            break
        parts.append(part)
        left -= len(part)
    data = b"".join(parts)
    if data and len(data) < size:
        raise ValueError("the file ends within a record")
    return data
