"""Tables that are replaced in one step.

*Published tables* (``publish`` / ``read_published``). Each write goes to a folder
of its own, ``<path>/versions/<time>-<id>``, and only a write that has ended well
is named in the pointer file ``<path>/_current``. The pointer is replaced by a
single rename where the file system has an atomic one (HDFS, local disks), and by
a single put on object stores. Readers resolve the pointer once and then read a
folder that nobody changes, so a reader sees the old table or the new one, and a
run that fails half-way leaves yesterday's table as it was. Versions that were
replaced stay for readers that still use them, up to ``keep``.

*Folders read by their plain path* (``replace_folder``). The rows land beside the
target first; then the target moves aside and the landed folder takes its place.
What fails in the plan fails before the target is touched, and a failure between
the two moves is undone. On object stores, whose renames copy, use ``publish``.

*Days* (``replace_partitions``). Only the partitions that the rows belong to are
replaced (dynamic partition overwrite): they are staged first and moved when all
tasks are done.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgermatch.sources.files import resolve_path

POINTER = "_current"
#: File systems with an atomic rename.
_RENAMING = ("file", "hdfs", "viewfs")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, without hidden ones; none if it is not there."""
    if not exists(spark, path):
        return []
    names = [s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)) if s.isDirectory()]
    return sorted(n for n in names if n[0] not in "._")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{name}" for name in folders(spark, path)]


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files of a folder by name, without hidden ones, and their modification times in milliseconds."""
    files = [s for s in _fs(spark, path).listStatus(_path(spark, path)) if s.isFile() and s.getPath().getName()[0] not in "._"]
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in files)


def in_name_order(spark: SparkSession, path: str) -> None:
    """Set the modification times of a folder's files along their names, by which a stream takes them.

    The times begin now, a millisecond each. They are past when this returns, so what is written next is later.
    """
    fs, names = _fs(spark, path), [name for name, _ in data_files(spark, path)]
    start = time.time_ns() // 1_000_000
    for k, name in enumerate(names):
        fs.setTimes(_path(spark, f"{path}/{name}"), start + k, -1)
    time.sleep(max(0.0, (start + len(names) + 1) / 1e3 - time.time()))


def _written(df: DataFrame, target: str, fmt: str, partition_by: Sequence[str], options: dict) -> None:
    writer = df.write.format(fmt).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(target)


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), keep: int = 2, **options) -> str:
    """Replace the published table at ``path`` by ``df``; returns the version's own folder."""
    spark, base = df.sparkSession, resolve_path(path).rstrip("/")
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
    _written(df, f"{base}/versions/{name}", fmt, partition_by, options)
    _point(spark, base, name)
    _expire(spark, base, keep)
    return f"{base}/versions/{name}"


def _put(spark: SparkSession, path: str, text: str) -> None:
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _point(spark: SparkSession, base: str, name: str) -> None:
    pointer = f"{base}/{POINTER}"
    if _fs(spark, base).getScheme() not in _RENAMING:
        _put(spark, pointer, name)
        return
    fresh = f"{base}/.{POINTER}-{uuid.uuid4().hex[:12]}"
    _put(spark, fresh, name)
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, base).getUri(), spark._jsc.hadoopConfiguration())
    files.rename(_path(spark, fresh), _path(spark, pointer), options)


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the version that the table at ``path`` stands for now."""
    base = resolve_path(path).rstrip("/")
    pointer = f"{base}/{POINTER}"
    if not exists(spark, pointer):
        raise FileNotFoundError(f"nothing was published at {path}")
    stream = _fs(spark, base).open(_path(spark, pointer))
    try:
        name = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return f"{base}/versions/{name}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the versions that are there, oldest first; failed writes among them."""
    return folders(spark, f"{resolve_path(path).rstrip('/')}/versions")


def _expire(spark: SparkSession, base: str, keep: int) -> None:
    """Remove versions older than the current one, but for the last ``keep``; later ones may still be written."""
    now = current_version(spark, base).rsplit("/", 1)[-1]
    old = [v for v in versions(spark, base) if v < now]
    for name in old[:max(0, len(old) - keep)]:
        remove(spark, f"{base}/versions/{name}")


def read_published(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The published table as it is now: the frame goes on reading this version, whatever is published later."""
    return spark.read.format(fmt).load(current_version(spark, path))


def land(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), **options) -> str:
    """Write ``df`` to a hidden folder beside ``path``, which it may replace by ``take_place``."""
    spark, target = df.sparkSession, resolve_path(path).rstrip("/")
    parent, name = target.rsplit("/", 1)
    landed = f"{parent}/.{name}-next-{uuid.uuid4().hex[:12]}"
    try:
        _written(df, landed, fmt, partition_by, options)
    except Exception:
        remove(spark, landed)
        raise
    return landed


def replace_folder(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), **options) -> str:
    """Replace the folder at ``path``; a plan that fails leaves it as it was. Its files' times follow their names."""
    landed = land(df, path, fmt, partition_by, **options)
    in_name_order(df.sparkSession, landed)
    return take_place(df.sparkSession, landed, path)


def take_place(spark: SparkSession, landed: str, path: str) -> str:
    """Move a landed folder to ``path``, in place of what is there."""
    target = resolve_path(path).rstrip("/")
    parent, name = target.rsplit("/", 1)
    aside = f"{parent}/.{name}-old-{uuid.uuid4().hex[:12]}"
    fs = _fs(spark, target)
    had = fs.exists(_path(spark, target))
    if had and not fs.rename(_path(spark, target), _path(spark, aside)):
        raise OSError(f"could not move {target} aside")
    if not fs.rename(_path(spark, landed), _path(spark, target)):
        if had:
            fs.rename(_path(spark, aside), _path(spark, target))
        raise OSError(f"could not move {landed} to {target}")
    if had:
        fs.delete(_path(spark, aside), True)
    return target


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet", **options) -> str:
    """Replace the partitions that ``df`` has rows of, and no other."""
    target = resolve_path(path)
    (df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").options(**options)
     .partitionBy(*partition_by).save(target))
    return target
