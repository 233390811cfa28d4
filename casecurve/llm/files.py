"""Files that tasks write into the shared folder and read back.

A task writes under a name of its own attempt and returns that name with its rows. Only names in rows that
were committed are ever read, so a task that is lost and run again, or run twice, leaves at most a file that
nothing refers to.
"""

from __future__ import annotations

import uuid

from pyarrow import NativeFile, fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path; a path without a scheme is a mounted folder."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def created(folder: str, stem: str, suffix: str) -> tuple[str, NativeFile]:
    """A new file's path and its stream."""
    path = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
    system, plain = located(path)
    system.create_dir(plain.rsplit("/", 1)[0], recursive=True)
    return path, system.open_output_stream(plain, compression=None)


def opened(path: str) -> NativeFile:
    """A file that can be read at any place."""
    system, plain = located(path)
    return system.open_input_file(plain)
