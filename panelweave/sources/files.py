"""Reading and writing panels, statistics and sequences."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.operators.skew import SEGMENT, cut_hot_groups
from panelweave.spec import PanelSpec

# An entity file is one letter, the entity number and this suffix; NaN marks a missing value.
ENTITY_FILE = r"/[^/](\d+)\.psv$"
ENTITY_FOLDER = r"/file=[^/](\d+)/[^/]*\.psv$"
IN_FOLDER = r"/file=[^/]*/[^/]*$"
MISSING = "NaN"
# How Spark names the folder of a null, and the characters it escapes in the name of a folder.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
UNSAFE = r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]"""
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Settings worth having in a session that scans folders of tiny files: Spark then puts many into one task.
SMALL_FILE_SETTINGS = {"spark.sql.files.openCostInBytes": "32768"}


def entity_from_file(pattern: str = ENTITY_FILE) -> Column:
    """The entity number in the path of the file a row came from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast("bigint")


def read_panel_dir(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    entity: str = "id",
    sep: str = "|",
    glob: str = "*.psv",
    id_pattern: str = ENTITY_FILE,
) -> DataFrame:
    """Scan folders of per-entity text files into one panel, entity column first.

    Hidden files, other suffixes and plain subfolders are skipped. A file whose header differs from ``schema`` fails the job,
    where Spark's default would read its columns by position. Folders by entity (``ENTITY_FOLDER``) are looked up as plain files:
    the driver's time for partitions grows with the square of their number, and the entity is in the path of the file.
    """
    folders = id_pattern == ENTITY_FOLDER
    scan = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", MISSING)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", folders)
        .csv(path)
    )
    if folders:
        scan = scan.where(F.col("_metadata.file_path").rlike(IN_FOLDER))
    return scan.select(entity_from_file(id_pattern).alias(entity), *schema.fieldNames())


def write_panel_dir(
    df: DataFrame, spec: PanelSpec, path: str, sep: str = "|", group_rows: int | None = None
) -> None:
    """Write one folder ``file=p<entity>`` of text files per entity, readable with ``ENTITY_FOLDER``.

    Entities are spread over all shuffle partitions, as opening files is what takes the time; the segments of
    an oversized entity go to different tasks and become several files in its folder. Tasks place their own files: neither
    a rename by the driver nor a change of permissions, which Spark's writer has for each file. A file gets its name when it is
    whole, so a task that runs again replaces it; ``_SUCCESS`` follows when all are there. All executors must reach the folder.
    """
    spark = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(place):
        raise FileExistsError(path)
    place = system.makeQualified(place)
    uri = place.toUri()
    names = [c for c in df.columns if c != spec.entity]
    options = {"sep": sep, "nullValue": MISSING, "timestampNTZFormat": ISO_MICROS, "timestampFormat": ISO_MICROS}
    header = spark.range(1).select(F.to_csv(F.struct(*[F.lit(n).alias(n) for n in names]), options)).first()[0]
    named = df.withColumn("file", F.concat(F.lit("p"), F.col(spec.entity).cast("string")))
    cut = cut_hot_groups(named, [spec.entity], spec.order, group_rows, spec.max_history)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = named.repartition(tasks, "file") if cut is None else cut.repartition(tasks, "file", SEGMENT)
    lines = spread.sortWithinPartitions("file").select("file", F.to_csv(F.struct(*names), options).alias("line"))
    folder = uri.getPath() if uri.getScheme() == "file" else place.toString()
    lines.mapInArrow(_write_groups(folder, header + "\n", _entity_folder), "files long").agg(F.sum("files")).collect()
    system.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS")).close()


def _entity_folder(name: str | None) -> tuple[str, str]:
    """The folder of an entity, named as Spark names a partition, and the file of the task at hand in it."""
    value = NO_VALUE if name is None else re.sub(UNSAFE, lambda found: f"%{ord(found[0]):02X}", name)
    return f"/file={value}", f"part-{TaskContext.get().partitionId():05d}.psv"


def _entity_file(name: str) -> tuple[str, str]:
    return "", f"p{name}.psv"


def _write_groups(path: str, header: str, place: Callable[[str | None], tuple[str, str]]):
    """Rows (name, line) sorted by name: the lines of each name go into the file ``place`` gives, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        current, out, hidden, whole, made = None, None, "", "", 0

        def finish() -> None:
            out.close()
            system.move(hidden, whole)

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for name, group in groupby(rows, key=itemgetter(0)):
                if out is None or name != current:
                    if out is not None:
                        finish()
                    below, file = place(name)
                    if below:
                        system.create_dir(folder + below)
                    current, made = name, made + 1
                    hidden, whole = f"{folder}{below}/.{file}.{uuid.uuid4().hex}", f"{folder}{below}/{file}"
                    out = system.open_output_stream(hidden)
                    out.write(header.encode())
                out.write("".join(f"{line}\n" for _, line in group).encode())
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64())], ["files"])

    return run


def write_entity_files(df: DataFrame, spec: PanelSpec, path: str, sep: str = "|") -> int:
    """Write one file ``p<entity>.psv`` per entity into one flat folder, readable with ``ENTITY_FILE``; gives their number.

    One task streams an entity's rows, sorted by the shuffle, into its file and holds a batch of them at a time. A file gets
    its name when it is whole, so a task that runs again replaces it. All executors must reach the folder, and
    values must not hold ``sep``. A null entity fails. ``write_panel_dir`` is the sink for entities of any size.
    """
    names = [c for c in df.columns if c != spec.entity]
    times = {n for n, kind in df.dtypes if kind in ("timestamp", "timestamp_ntz")}
    texts = [F.date_format(c, ISO_MICROS) if c in times else F.col(c).cast("string") for c in names]
    line = F.concat_ws(sep, *[F.coalesce(t, F.lit(MISSING)) for t in texts])
    name = F.coalesce(F.col(spec.entity).cast("string"), F.raise_error(F.lit("an entity file needs an entity")))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = df.repartition(tasks, spec.entity).sortWithinPartitions(*spec.keys).select(name.alias("entity"), line.alias("line"))
    made = lines.mapInArrow(_write_groups(path, sep.join(names) + "\n", _entity_file), "files long")
    return made.agg(F.sum("files")).first()[0] or 0


def read_panel_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Read a prepared panel from delimited text with a header."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", MISSING)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_panel(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a panel as ``csv`` (with header) or ``parquet``."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", MISSING)
        writer.option("timestampNTZFormat", ISO_MICROS).option("timestampFormat", ISO_MICROS).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def nan_as_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in all floating-point columns; Spark's aggregates skip nulls but not NaN."""
    floating = {c for c, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns])


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """Read a panel written as parquet, by us or by others."""
    return nan_as_null(spark.read.parquet(path))


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Read packed sequences."""
    return spark.read.parquet(path)


def write_predictions(predictions: DataFrame, path: str, column: str = "prediction") -> None:
    """Write JSON predictions as lines of text, one object per line, in as many files as there are tasks."""
    predictions.select(column).write.text(path)


def write_sequences(sequences: DataFrame, path: str) -> None:
    """Persist packed sequences; nested arrays keep their types in parquet."""
    sequences.write.parquet(path)


def save_stats(stats: DataFrame, path: str) -> None:
    """Persist the one row of fitted statistics."""
    stats.coalesce(1).write.parquet(path)


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
