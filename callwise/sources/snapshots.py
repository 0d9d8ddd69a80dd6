"""A stored table that is replaced as a whole: readers see the old version or the new one, never anything between.

    root/data/<name>/     the rows of one version, written once and never changed
    root/versions/<n>     a small file that names the data of version n

A commit writes its rows into a folder of their own, then publishes them by renaming a finished pointer file to the next
number. That rename is one step of the file system and fails if the number is taken, so of two writers that began from
the same version one is refused. A writer that dies before the rename leaves a folder that nobody reads; ``expire`` takes
such folders away. Versions may differ in their columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class ConcurrentChange(RuntimeError):
    """The table was changed since the version that a commit began from."""


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list:
    where, files = _files(spark, path)
    return list(files.listStatus(where)) if files.exists(where) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(f.getPath().getName()) for f in _listed(spark, f"{root}/versions") if f.getPath().getName().isdigit())


def latest_version(spark: SparkSession, root: str) -> int:
    """Number of the last published version; 0 before the first."""
    return max(versions(spark, root), default=0)


def _data(spark: SparkSession, root: str, version: int) -> str:
    return f"{root}/data/{spark.read.text(f'{root}/versions/{version}').first()[0]}"


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The last published version, or an earlier one that still exists."""
    version = version or latest_version(spark, root)
    if not version:
        raise ValueError(f"nothing has been committed to {root}")
    return spark.read.parquet(_data(spark, root, version))


def _publish(spark: SparkSession, root: str, version: int, name: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft, files = _files(spark, f"{root}/drafts/{name}")
    out = files.create(draft, False)
    out.write(bytearray(name.encode() + b"\n"))
    out.close()
    target, _ = _files(spark, f"{root}/versions/{version}")
    files.mkdirs(target.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), plain)  # fails if the target exists
    except Exception as e:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(e) or "exists" in str(e):
            raise ConcurrentChange(f"version {version} of {root} has been published by another writer") from None
        raise


def commit(df: DataFrame, root: str, base: int | None = None) -> int:
    """Publish ``df`` as the version after ``base`` (by default the last one now) and return its number.

    Refused when another version has been published since ``base``. The rows may derive from the table itself.
    """
    spark = df.sparkSession
    base = latest_version(spark, root) if base is None else base
    if latest_version(spark, root) != base:
        raise ConcurrentChange(f"{root} is no longer at version {base}")
    name = f"{base + 1}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/data/{name}")
    _publish(spark, root, base + 1, name)
    return base + 1


def change(spark: SparkSession, root: str, step: Callable[[DataFrame], DataFrame], tries: int = 5) -> int:
    """Replace the table by ``step`` of itself; begins again from the newer version when another writer was first."""
    for left in range(tries - 1, -1, -1):
        base = latest_version(spark, root)
        try:
            return commit(step(read_version(spark, root, base)), root, base)
        except ConcurrentChange:
            if not left:
                raise
    raise ValueError("at least one try is needed")


def expire(spark: SparkSession, root: str, keep: int = 2, idle_seconds: float = 86_400.0) -> list[str]:
    """Delete all versions but the last ``keep``, and data that no version names and nobody has written to for a while.

    The time protects writers at work and readers of versions that go. Returns the names of the deleted folders.
    """
    if keep < 1:
        raise ValueError("the last version stays")
    numbers = versions(spark, root)
    named = {_data(spark, root, n).rsplit("/", 1)[1] for n in numbers[-keep:]}
    for n in numbers[:-keep]:
        where, files = _files(spark, f"{root}/versions/{n}")
        files.delete(where, False)
    gone, now = [], spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    for kind in ("data", "drafts"):
        for f in _listed(spark, f"{root}/{kind}"):
            path, name = f.getPath(), f.getPath().getName()
            if name not in named and now - f.getModificationTime() >= 1000 * idle_seconds:
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
                gone.append(name)
    return sorted(gone)
