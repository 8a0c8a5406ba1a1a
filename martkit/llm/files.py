"""Binary files in the shared folders, opened inside tasks through pyarrow file systems.

A task writes under a name of its own attempt and returns that name as a row; only names in the
manifest that Spark committed count, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import mmap
import uuid
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path) if parsed.scheme else uri
    return fs.FileSystem.from_uri(uri)


def new_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"


def create(uri: str) -> BinaryIO:
    system, path = locate(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_random(uri: str) -> BinaryIO:
    system, path = locate(uri)
    return system.open_input_file(path)


def open_stream(uri: str) -> BinaryIO:
    system, path = locate(uri)
    return system.open_input_stream(path, compression=None)


def map_file(uri: str) -> np.ndarray:
    """The file as a byte array: memory-mapped if the shared folder is mounted, else read."""
    system, path = locate(uri)
    if isinstance(system, fs.LocalFileSystem):
        with open(path, "rb") as f:
            return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), dtype=np.uint8)
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=np.uint8)
