"""Binary files that tasks write to and read from the shared folder, whatever store it is in."""
from __future__ import annotations

import uuid
from typing import BinaryIO

from pyspark.sql import SparkSession

from faremeter.sources.scratch import scratch_root


def new_folder(spark: SparkSession, label: str) -> str:
    """The address of a folder of its own in the shared folder; it comes into being with its first file."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


# Names that Spark's file systems have for stores which pyarrow knows by another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def known_address(address: str) -> str:
    """An address as pyarrow's file systems read it."""
    scheme, colon, rest = address.partition(":")
    if scheme in ("", "file") or not colon or "/" in scheme:
        return "file:///" + address.removeprefix("file:").lstrip("/")
    if scheme == "dbfs":
        return "file:///dbfs/" + rest.lstrip("/")
    return f"{_SCHEMES.get(scheme, scheme)}:{rest}"


def _store(address: str):
    """The store of an address and the path in it: local and mounted folders, `hdfs` (with libhdfs on every executor), `s3`,
    `gs` and `abfs`, also under the names that Spark has for them."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(known_address(address))


def create(address: str) -> BinaryIO:
    """A new file for writing. Give every attempt of a task a name of its own and list what counts in a table."""
    store, path = _store(address)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def open_input(address: str):
    """A file for reading at any place."""
    store, path = _store(address)
    return store.open_input_file(path)
