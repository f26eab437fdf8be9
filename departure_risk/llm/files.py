"""Binary files in the folder that driver and executors share, on any store pyarrow can open."""

import uuid
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession

from departure_risk.session import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def written(uri: str):
    """A stream for a new file that appears under its name only when complete.

    A task that is run again, or twice at a time, writes another temporary file and replaces the same name
    with the same bytes.
    """
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part, compression=None) as stream:
        yield stream
    store.move(part, path)


def opened(uri: str):
    """A file for reading at any place."""
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)
