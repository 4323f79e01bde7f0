"""A panel laid out by entity, so that fill, trim and pack need no shuffle.

The table is bucketed by entity and sorted by entity and order, one file a bucket: a window or a grouping by entity finds all of its rows
in one task already. What the layout is stands beside the files, so any session can attach the folder again.

A null entity has a bucket like any other. Entities with more rows than one task may take (``operators.skew``) have no place here, as a
bucket is one task's work; writing them is an error, and the plain layouts cut them. An empty panel makes an empty table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelweave.operators.skew import rows_per_group
from panelweave.sources import folders
from panelweave.spec import PanelSpec

_LAYOUT = "_layout.json"


def write_by_entity(panel: DataFrame, spec: PanelSpec, path: str, buckets: int, group_rows: int | None = None) -> None:
    """Write ``panel`` below ``path`` in ``buckets`` files; choose as many as there are tasks to work on it later."""
    spark = panel.sparkSession
    sizes = panel.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    total, largest = sizes[0] or 0, sizes[1] or 0
    if largest > rows_per_group(panel, total, group_rows):
        raise ValueError(f"an entity has {largest} rows, too many for one task; write the panel without buckets")
    name = f"layout_{uuid.uuid4().hex}"
    # Dealt as buckets are, so that each task writes one file.
    dealt = panel.repartition(buckets, spec.entity).sortWithinPartitions(spec.entity, *spec.order)
    dealt.write.bucketBy(buckets, spec.entity).sortBy(spec.entity, *spec.order).option("path", path).saveAsTable(name)
    told = {"schema": json.loads(panel.schema.json()), "entity": spec.entity, "order": list(spec.order), "buckets": buckets}
    folders.write_text(spark, f"{path}/{_LAYOUT}", json.dumps(told))
    # The folder stays; the name was for writing only.
    spark.sql(f"DROP TABLE {name}")


def attach(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Make a folder of ``write_by_entity`` the table ``name`` of this session's catalog, and read it."""
    told = json.loads(folders.read_text(spark, f"{path}/{_LAYOUT}"))

    def quoted(columns: list[str]) -> str:
        return ", ".join(f"`{c}`" for c in columns)

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(told["schema"]).fields)
    ordered = quoted([told["entity"], *told["order"]])
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({quoted([told['entity']])}) SORTED BY ({ordered}) "
        f"INTO {told['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
