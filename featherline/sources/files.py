"""File access for data source tasks, on any store Arrow knows (local, hdfs, s3, gs)."""

from __future__ import annotations

import gzip
import re

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if re.match(r"^[a-z][a-z0-9+.-]*:", path):
        path = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/*", "file:///", path))
        store, inner = fs.FileSystem.from_uri(path)
        return store, inner.rstrip("/")
    return fs.LocalFileSystem(), path.rstrip("/")


def is_data(name: str) -> bool:
    return not name.startswith(("_", ".")) and not name.endswith("$folder$")


def data_files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of every data file below ``path``, or of the one file it names."""
    store, inner = open_store(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = store.get_file_info(fs.FileSelector(inner, recursive=True))
    depth = len(inner) + 1
    return sorted(
        (f.path, f.size)
        for f in found
        if f.type == fs.FileType.File and all(is_data(part) for part in f.path[depth:].split("/"))
    )


def chunks(store: fs.FileSystem, path: str, size: int):
    """The bytes of a file, piece by piece, unzipped when its name ends in ``.gz``."""
    with store.open_input_stream(path, compression=None) as stream:
        source = gzip.GzipFile(fileobj=stream) if path.endswith(".gz") else stream
        while piece := source.read(size):
            yield piece
