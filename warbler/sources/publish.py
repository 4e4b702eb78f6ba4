"""Folders that appear whole.

A job writes into a staging folder beside the final path and renames it when it has ended well, so a
failed or stopped overwrite leaves the earlier output as it was. Where the file system renames in one
step (local disks, HDFS), readers see the old folder or the new one; where it copies instead (object
stores), use their committers and the plain writers.

``published`` keeps folders made from an input under the input's fingerprint in the shared folder, for
all applications: whoever finds one need not make it again. The folders by name and fingerprint are
the manifest; a folder is there only whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warbler.session import checkpoint_root, delete_path


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """False if the target is there already (a rename would move the source into it)."""
    system, to = _file_system(spark, target)
    if system.exists(to):
        return False
    system.mkdirs(to.getParent())
    return system.rename(_file_system(spark, source)[1], to)


def beside(path: str, kind: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{uuid.uuid4().hex[:12]}.{kind}"


def replace(spark: SparkSession, path: str, write: Callable[[str], object]) -> str:
    """``write(folder)`` writes what becomes ``path``, in place of what is there, once it has ended
    without an error."""
    staging, old = beside(path, "staging"), beside(path, "old")
    try:
        write(staging)
        moved = exists(spark, path) and rename(spark, path, old)
        if not rename(spark, staging, path):
            if moved:
                rename(spark, old, path)
            raise OSError(f"could not publish {path}")
    except BaseException:
        delete_path(spark, staging)
        raise
    if moved:
        delete_path(spark, old)
    return path


# -- folders by the fingerprint of their input ---------------------------------------------------

#: Raised when what ``published`` folders hold changes its form.
FORMAT = 1


def fingerprint(files: DataFrame, *made_by: object) -> str:
    """A digest of the input's files (path, size, modification time, from their metadata) and of how
    the folder is made. ``files`` is any unchanged scan of them."""
    seen = files.select("_metadata.file_path", "_metadata.file_size",
                        "_metadata.file_modification_time").distinct()
    # As many rows as there are files; their digests go to the driver, added up.
    line = F.concat_ws("|", "file_path", "file_size", "file_modification_time")
    digest = seen.agg(F.count(F.lit(1)), F.sum(F.xxhash64(line).cast("decimal(38,0)")),
                      F.sum(F.xxhash64(F.lit(1), line).cast("decimal(38,0)"))).first()
    return hashlib.sha1(repr((FORMAT, made_by, tuple(map(str, digest)))).encode()).hexdigest()


def published_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/warbler/published"


def published(spark: SparkSession, name: str, key: str, build: Callable[[str], object]) -> str:
    """The folder ``name`` made from the input with fingerprint ``key``; ``build(folder)`` makes it
    where no application has yet. Of applications that build at once, the first to end is kept."""
    final = f"{published_root(spark)}/{name}/{key}"
    if exists(spark, f"{final}/_SUCCESS"):
        return final
    staging = beside(final, "staging")
    try:
        build(staging)
        if not rename(spark, staging, final) and not exists(spark, f"{final}/_SUCCESS"):
            raise OSError(f"could not publish {final}")
    finally:
        if exists(spark, staging):
            delete_path(spark, staging)
    return final


def manifest(spark: SparkSession) -> list[tuple[str, str, str]]:
    """(name, fingerprint, path) of all published folders."""
    system, root = _file_system(spark, published_root(spark))
    if not system.exists(root):
        return []
    out = []
    for kind in system.listStatus(root):
        for entry in system.listStatus(kind.getPath()):
            path = entry.getPath()
            if not path.getName().startswith("."):
                out.append((kind.getPath().getName(), path.getName(), path.toString()))
    return sorted(out)


def withdraw(spark: SparkSession, name: str | None = None) -> int:
    """Removes published folders (of one name); returns their number."""
    gone = [path for kind, _, path in manifest(spark) if name in (None, kind)]
    for path in gone:
        delete_path(spark, path)
    return len(gone)
