"""A stream whose state is tables: entities of any size, rows that leave while it runs.

The state of a streaming operator is kept by key, and one task has all of a key; an entity with a third of all rows would be one
task's work, and its last vector could not be handed from one time segment to the next, as keys do not see each other. Here each
micro-batch is a small batch job over its new rows and two tables, so the rows of one entity are spread like those of any
table, and an entity with more of them than one task may take is cut into segments of its order, with the last vector carried
from segment to segment (``operators.skew``).

Per micro-batch: rows behind the watermark leave at once as they came, ``late``. All others wait (table ``fresh``) until the watermark,
``lateness`` behind the newest row seen before, has passed them. Rows that it has passed are filled forward and leave, but for the
newest ``delay`` of each entity, which are kept (table ``kept``) with the vector to go on from. ``kept`` is written for the entities that
a micro-batch touches, and into one table again every ``COMPACT`` batches.

Each micro-batch writes its tables into a folder of its own and then a small file that names them. One that is run again after a
failure writes the same folder anew, or does nothing if that file is there, so each row leaves exactly once. Readers take the
folders that are named. Rows of one place in the order count once; a row without a clock is late; a null entity is an entity.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.operators import history
from panelweave.operators.skew import matching
from panelweave.sources import folders
from panelweave.spec import PanelSpec
from panelweave.workspace import materialise

#: Micro-batches after which the tables of kept rows become one again.
COMPACT = 16


@dataclass
class Settling:
    """Fill and delay a stream, with its state and its output below ``path``.

    ``like`` is an empty or full DataFrame with the stream's columns. The first order column is a timestamp.
    """

    spark: SparkSession
    path: str
    like: DataFrame
    spec: PanelSpec
    lateness: int
    delay: int = 5
    group_rows: int | None = None

    # ---- what is known

    def _done(self) -> list[int]:
        return sorted(int(n) for n in folders.names(self.spark, f"{self.path}/done") if n.isdigit())

    def _told(self, batch: int) -> dict:
        return json.loads(folders.read_text(self.spark, f"{self.path}/done/{batch}"))

    def _columns(self) -> list[str]:
        return [*self.spec.keys, *self.spec.features]

    def _typed(self, df: DataFrame) -> DataFrame:
        doubles = [F.col(c).cast("double").alias(c) for c in self.spec.features]
        return df.select(*self.spec.keys, *doubles)

    def _schema(self, *more: T.StructField) -> T.StructType:
        return T.StructType([*[T.StructField(f.name, f.dataType) for f in self._typed(self.like).schema], *more])

    def _read(self, names: list[str], schema: T.StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])

    def _kept(self, names: list[str]) -> DataFrame:
        """The kept rows of every entity, from the last batch that touched it."""
        rows = self._read(names, self._schema(T.StructField("gone", T.BooleanType()), T.StructField("batch", T.LongType())))
        if len(names) < 2:
            return rows
        last = rows.groupBy(self.spec.entity).agg(F.max("batch").alias("batch"))
        return matching(rows, last, [self.spec.entity, "batch"], "left_semi")

    # ---- one micro-batch

    def _settled(self, ready: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows that leave, and the kept rows of the entities of ``ready``; all of ``kept`` comes before ``ready`` in order."""
        touched = ready.select(self.spec.entity).distinct()
        before = matching(kept, touched, [self.spec.entity], "left_semi").drop("batch")
        both = before.unionByName(ready.withColumn("gone", F.lit(False)))
        filled = materialise(history.ffill(both, self.spec, group_rows=self.group_rows), "filled")
        newest = history.keep_last(filled, self.spec, max(self.delay, 1))
        out = history.drop_last(filled, self.spec, self.delay).where("not gone")
        return out.select(*self._columns()), newest.withColumn("gone", F.lit(self.delay == 0))

    def process(self, rows: DataFrame, batch: int) -> None:
        """Take the rows of one micro-batch."""
        done = self._done()
        if batch in done:
            return
        told = self._told(done[-1]) if done else {"newest": None, "waiting": [], "kept": [], "out": []}
        clock = F.unix_micros(F.col(self.spec.order[0]).cast("timestamp"))
        new = materialise(self._typed(rows).withColumn("__clock", clock), "arrived")
        seen = new.agg(F.max("__clock")).first()[0]
        newest = max([x for x in (seen, told["newest"]) if x is not None], default=None)

        def passed(top: int | None) -> Column:
            return F.lit(False) if top is None else F.col("__clock") < F.lit(top - self.lateness * 1_000_000)

        late = passed(told["newest"]) | F.col("__clock").isNull()
        waiting = self._read(told["waiting"], self._schema()).withColumn("__clock", clock)
        fresh = new.where(~late).unionByName(waiting).dropDuplicates(list(self.spec.keys))
        names = {n: f"{n}/batch-{batch}" for n in ("fresh", "kept", "out")}

        def write(df: DataFrame, name: str, *by: str) -> None:
            df.write.mode("overwrite").partitionBy(*by).parquet(f"{self.path}/{names[name]}")

        # Rows that go on waiting have a folder of their own.
        split = F.when(passed(newest), "ready").otherwise("waiting")
        write(fresh.select(*self._columns(), split.alias("part")), "fresh", "part")
        parts = {n: [f"{names['fresh']}/part={n}"] if folders.exists(self.spark, f"{self.path}/{names['fresh']}/part={n}") else [] for n in ("ready", "waiting")}
        out, kept = self._settled(self._read(parts["ready"], self._schema()), self._kept(told["kept"]))

        left = new.where(late).select(*self._columns()).withColumn("late", F.lit(True))
        write(out.withColumn("late", F.lit(False)).unionByName(left), "out")
        kept = kept.withColumn("batch", F.lit(batch).cast("long"))
        if len(told["kept"]) >= COMPACT:
            rest = matching(self._kept(told["kept"]), kept, [self.spec.entity], "left_anti")
            write(materialise(rest.unionByName(kept), "compacted"), "kept")
            told["kept"] = []
        else:
            write(kept, "kept")
        after = {"newest": newest, "waiting": parts["waiting"], "kept": [*told["kept"], names["kept"]], "out": [*told["out"], names["out"]]}
        folders.write_text(self.spark, f"{self.path}/done/{batch}", json.dumps(after))
        # What the batch before has left behind and this one does not name; a repeat of this one needs none of it.
        for old in done[:-1]:
            folders.delete(self.spark, f"{self.path}/fresh/batch-{old}")

    def start(self, stream: DataFrame, **trigger):
        """The running query; its place in the source is kept below ``path`` as well."""
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.path}/progress")
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    # ---- results

    def emitted(self) -> DataFrame:
        """All rows that have left so far, with ``late``."""
        done = self._done()
        return self._read(self._told(done[-1])["out"] if done else [], self._schema(T.StructField("late", T.BooleanType())))

    def remaining(self) -> DataFrame:
        """The rows that would still leave if the stream ended now."""
        done = self._done()
        told = self._told(done[-1]) if done else {"waiting": [], "kept": []}
        out, _ = self._settled(self._read(told["waiting"], self._schema()), self._kept(told["kept"]))
        return out.withColumn("late", F.lit(False))
