"""Memory of Python workers, which Spark keeps for later tasks."""

import ctypes
import sys
from collections.abc import Iterator

import pyarrow as pa


def given_back(batches: Iterator) -> Iterator:
    """The same batches; behind the last one, what Arrow and the C library hold for later use goes back to the system.

    A worker that waits would else hold as much as its largest task had, beside the tasks of stages without Python.
    """
    yield from batches
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)
