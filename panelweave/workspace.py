"""What jobs share: a folder for intermediate data, and this package on the executors."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="panelweave-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses; what is there goes away with its scope."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _made:
        # Only now, so that it runs before the JVM is ended.
        atexit.register(_discard_from, 0)
    _made.append((spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path))
    return path


_made: list[tuple] = []
_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, where they cannot be relied on to have it installed."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="panelweave-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)


def _discard_from(first: int) -> None:
    gone = _made[first:]
    del _made[first:]
    for jvm, conf, path in gone:
        # A folder may be gone already, and at the end of the process its session as well.
        with contextlib.suppress(Exception):
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


@contextlib.contextmanager
def scope() -> Iterator[None]:
    """Intermediate tables made inside the block are deleted at its end; those made outside, with the process.

    DataFrames that read them must have been written or collected by then.
    """
    first = len(_made)
    try:
        yield
    finally:
        _discard_from(first)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches or jobs read one shuffled intermediate. The written table
    survives the loss of executors and is columnar, so each branch reads only its columns.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
