"""Parts of raw files, read inside tasks from any store that pyarrow can open."""

import io
import re

import pyarrow as pa
from pyarrow import fs

#: Bytes read at a time, so that small reads are not requests of their own.
STEP = 1 << 20


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path as Spark lists it (`file:/a b`, `hdfs://host/a`, `s3://bucket/a`, `/a`) and the path within it."""
    scheme, authority, rest = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?)?(/.*)", path, re.DOTALL).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), rest
    store, root = fs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    return store, root.rstrip("/") + rest


def can_open(path: str) -> bool:
    """Whether tasks can open files like this one themselves; otherwise only Spark's readers can."""
    try:
        store, within = located(path)
        return store.get_file_info(within).type == fs.FileType.File
    except (pa.ArrowException, OSError, ImportError, AttributeError):
        return False


def opened(path: str) -> io.BufferedReader:
    """A file for reading at any place, STEP bytes at a time."""
    store, within = located(path)
    return io.BufferedReader(store.open_input_file(within), STEP)


def first_line(path: str) -> str:
    """The first line that is not blank, without its end; empty where there is none. No more than the line is read, up to STEP."""
    with opened(path) as file:
        text = io.TextIOWrapper(file, encoding="utf-8", errors="replace", newline=None)
        return next((line.rstrip("\n") for line in text if line.strip()), "")
