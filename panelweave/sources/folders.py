"""Files and folders of any store that Spark reads: small texts, listings, and folders that appear whole or not at all."""

from __future__ import annotations

from pyspark.sql import SparkSession


def place(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = place(spark, path)
    return fs.exists(at)


def make(spark: SparkSession, path: str) -> None:
    at, fs = place(spark, path)
    fs.mkdirs(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, in order of name; nothing if there is no such folder."""
    at, fs = place(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path below the folder, length) of every file in a folder and those below it."""
    at, fs = place(spark, path)
    top = fs.makeQualified(at).toString().rstrip("/") + "/"
    found, each = [], fs.listFiles(at, True)
    while each.hasNext():
        status = each.next()
        found.append((status.getPath().toString().removeprefix(top), status.getLen()))
    return sorted(found)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    at, fs = place(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return read_bytes(spark, path).decode()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, so that readers see all of it or none."""
    folder, _, name = path.rpartition("/")
    hidden, fs = place(spark, f"{folder}/.{name}.part")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    at, _ = place(spark, path)
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(hidden, at):
        raise OSError(f"cannot write {path}")


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file that only one of many writers can make; false if it was there."""
    at, fs = place(spark, path)
    return bool(fs.createNewFile(at))


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Move a folder to a name that nothing has; false if something has it."""
    at, fs = place(spark, old)
    to, _ = place(spark, new)
    return not fs.exists(to) and bool(fs.rename(at, to))


def delete(spark: SparkSession, path: str) -> None:
    at, fs = place(spark, path)
    fs.delete(at, True)
