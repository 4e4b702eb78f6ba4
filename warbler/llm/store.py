"""Files and tables that an operator keeps in the cluster's shared folder.

``table`` cuts lineage: it writes a frame as Parquet under ``spark.checkpoint.dir`` and reads it
back, so a lost executor costs one step at most. ``create`` and ``view`` let tasks write and read
plain binary files there through Arrow's file systems (``file:``, ``hdfs:``, ``s3:`` …): an attempt
writes under a name of its own and renames it when whole, so retried or speculative attempts never
leave a partial file under the final name.
"""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from warbler.session import delete_path, scratch_path

#: Removes the shuffle files of a query when it ends. Spark keeps them, in case the frame runs again,
#: until the driver collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The folders made since the innermost ``passing`` began.
_MADE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to clash with no column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def folder(spark: SparkSession, name: str) -> str:
    """A new URI under the shared folder."""
    path = scratch_path(spark, name)
    path = path if "://" in path or path.startswith("file:") else f"file://{path}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, with the same schema. What it took to make
    it is not kept beside it."""
    spark = df.sparkSession
    path = folder(spark, name)
    with _cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _cleaned(spark: SparkSession):
    if not spark.conf.isModifiable(CLEAN_UP):  # other versions
        yield
        return
    was = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, was)


def discard(written: DataFrame) -> None:
    """Removes a table that nothing will read again."""
    for path in {file.rpartition("/")[0] for file in written.inputFiles()}:
        delete_path(written.sparkSession, path)


@contextlib.contextmanager
def passing(spark: SparkSession):
    """Removes the folders that were made inside, when it ends without an error, but those of the
    tables given to the function that it yields."""
    outer, made, kept = _MADE.get(), [], set()

    def keep(written: DataFrame) -> DataFrame:
        kept.update(file.split("/")[-2] for file in written.inputFiles())
        return written

    was = _MADE.set(made)
    try:
        yield keep
    finally:
        _MADE.reset(was)
    for path in made:
        if path.rpartition("/")[2] not in kept:
            delete_path(spark, path)
        elif outer is not None:
            outer.append(path)


def tidy() -> None:
    """Gives memory that this worker has freed back to the system, at the end of a task: workers go
    on from stage to stage."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than GNU's
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _place(uri: str):
    from pyarrow import fs

    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path), True
    system, path = fs.FileSystem.from_uri(uri)
    return system, path, False


@contextlib.contextmanager
def create(uri: str):
    """A binary stream; the file appears at ``uri`` when the block ends without an error."""
    system, path, _ = _place(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.part"
    stream = system.open_output_stream(own, compression=None)
    try:
        yield stream
    except BaseException:
        stream.close()
        system.delete_file(own)
        raise
    stream.close()
    system.move(own, path)


def exists(uri: str) -> bool:
    from pyarrow import fs

    system, path, _ = _place(uri)
    return system.get_file_info(path).type == fs.FileType.File


def open_stream(uri: str):
    """A buffered binary stream over a file."""
    system, path, _ = _place(uri)
    return system.open_input_stream(path, compression=None, buffer_size=1 << 20)


def view(uri: str, dtype) -> np.ndarray:
    """A file of fixed-width little-endian values: memory-mapped where the store is a mounted
    file system, else read as a whole."""
    system, path, mounted = _place(uri)
    if mounted:
        if os.path.getsize(path) == 0:
            return np.empty(0, dtype)
        return np.memmap(path, dtype=dtype, mode="r")
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)
