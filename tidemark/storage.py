"""Small files on the cluster's shared storage, through its file system.

For commit records and ledgers: text of a few lines, written whole or not at
all (a temporary file that is renamed)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _store(spark, path)
    return store.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, hidden files left out; a missing one is empty."""
    where, store = _store(spark, folder)
    if not store.exists(where):
        return []
    found = [x.getPath().getName() for x in store.listStatus(where)]
    return sorted(x for x in found if not x.startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str:
    where, store = _store(spark, path)
    stream = store.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces the file at ``path``; a reader sees the old text or the new."""
    where, store = _store(spark, path)
    part, _ = _store(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = store.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if store.exists(where):
        store.delete(where, False)
    if not store.rename(part, where):
        raise OSError(f"could not write {path}")


def remove(spark: SparkSession, path: str) -> None:
    where, store = _store(spark, path)
    store.delete(where, True)
