"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlsplit

import numpy as np
import pyarrow.fs as pafs


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def new_file(folder: str, name: str, suffix: str) -> tuple[str, object]:
    """(uri, output stream) of a file that no other attempt of the task writes to.

    The uri goes into the row the task returns.  Only the rows of the attempt that Spark counts are
    ever read, so a lost or doubled attempt leaves at most a file that nobody looks at.
    """
    uri = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}{suffix}"
    fs, path = locate(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    return uri, fs.open_output_stream(path, compression=None)


def open_file(uri: str):
    fs, path = locate(uri)
    return fs.open_input_file(path)


def mapped(uri: str, dtype) -> np.ndarray:
    """The file as an array in mapped memory.

    A folder every machine mounts is mapped in place.  From any other store the file is fetched into
    the task's own temporary folder first and unlinked at once, so it goes with the mapping.
    """
    if urlsplit(uri).scheme in ("", "file"):
        path, fetched = locate(uri)[1], False
    else:
        handle, path = tempfile.mkstemp()
        with open_file(uri) as src, os.fdopen(handle, "wb") as out:
            while piece := src.read(1 << 24):
                out.write(piece)
        fetched = True
    size = os.path.getsize(path)
    array = np.memmap(path, dtype, "r") if size else np.empty(0, dtype)
    if fetched:
        os.unlink(path)
    return array
