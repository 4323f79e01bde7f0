"""Monitoring that adds a batch to what is known, without the rows of the batches before it.

A ``CountStore`` is a table of how often each value occurs, by (batch, column, value), and of missing values by batch. A new batch is
counted once, from its own rows, into a folder of its own, and counts from when a small file names it; a batch that comes again changes
nothing, whether it is a repeated micro-batch of a stream (``start``) or a job that is run twice. Reports are made from the
stored counts, and equal those made from all rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.operators.drift import (
    DISTANCE_THRESHOLD, categorical_drift_of_counts, missing_values, numeric_drift_of_counts,
)
from panelweave.sources import folders

_COUNTS = "batch long, column string, value double, text string, n long"
_MISSING = "batch long, n_rows long, n_missing long, share_missing double, rows_with_missing long, columns_with_missing long"


@dataclass
class CountStore:
    """Counts of the columns of ``kinds`` (``numeric`` or ``categorical``) below ``path``."""

    spark: SparkSession
    path: str
    kinds: dict[str, str]

    def batches(self) -> list[int]:
        """The batches that are in the store."""
        return sorted(int(n) for n in folders.names(self.spark, f"{self.path}/done") if n.isdigit())

    def add(self, rows: DataFrame, batch: int) -> bool:
        """Count one batch; false if it was counted before."""
        if folders.exists(self.spark, f"{self.path}/done/{batch}"):
            return False
        cells = []
        for c, kind in self.kinds.items():
            numeric = kind == "numeric"
            value = F.col(c).cast("double") if numeric else F.lit(None).cast("double")
            text = F.lit(None).cast("string") if numeric else F.col(c).cast("string")
            cells.append(F.struct(F.lit(c).alias("column"), value.alias("value"), text.alias("text")))
        cell = rows.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
        present = cell.where(F.col("value").isNotNull() | F.col("text").isNotNull())
        counts = present.groupBy("column", "value", "text").agg(F.count(F.lit(1)).alias("n"))
        number = F.lit(batch).cast("long").alias("batch")
        counts.select(number, "*").write.mode("overwrite").parquet(f"{self.path}/counts/batch-{batch}")
        missing = missing_values(rows.select(number, *self.kinds), list(self.kinds))
        missing.write.mode("overwrite").parquet(f"{self.path}/missing/batch-{batch}")
        folders.write_text(self.spark, f"{self.path}/done/{batch}", "")
        return True

    def start(self, stream: DataFrame, **trigger):
        """Count every micro-batch of a stream as a batch."""
        writer = stream.writeStream.foreachBatch(lambda rows, batch: self.add(rows, batch) and None)
        return writer.option("checkpointLocation", f"{self.path}/progress").trigger(**(trigger or {"availableNow": True})).start()

    def _read(self, name: str, schema: str) -> DataFrame:
        found = [f"{self.path}/{name}/batch-{b}" for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def missing(self) -> DataFrame:
        """What ``drift.missing_values`` gives, for all batches."""
        return self._read("missing", _MISSING)

    def counts(self) -> DataFrame:
        return self._read("counts", _COUNTS)

    def drift(self, reference: CountStore, group_rows: int | None = None) -> DataFrame:
        """What ``drift.drift_by_batch`` gives for all batches of the store against all of ``reference``: distances."""
        whole = reference.counts().groupBy("column", "value", "text").agg(F.sum("n").alias("r"))
        own, parts = self.counts().withColumnRenamed("n", "c"), []
        numeric = [c for c, kind in self.kinds.items() if kind == "numeric"]
        if numeric:
            of_ref = whole.where(F.col("column").isin(numeric)).select("column", "value", "r")
            of_cur = own.where(F.col("column").isin(numeric)).select("batch", "column", "value", "c")
            # One row a column, twice: the mean, then the distance from it.
            sums = of_ref.groupBy("column").agg((F.sum(F.col("r") * F.col("value")) / F.sum("r")).alias("mean"))
            means = {r["column"]: r["mean"] for r in sums.collect()}
            centre = F.create_map(*[F.lit(x) for c in numeric for x in (c, means.get(c, 0.0))])
            off = F.col("value") - centre[F.col("column")]
            spreads = of_ref.groupBy("column").agg(F.sqrt(F.sum(F.col("r") * off * off) / F.sum("r")).alias("spread"))
            spread = {r["column"]: r["spread"] for r in spreads.collect()}
            known = {c: (means.get(c), spread.get(c)) for c in numeric}
            found = numeric_drift_of_counts(of_ref, of_cur, known, "batch", group_rows, of_ref.count() + of_cur.count())
            parts.append(found.select("batch", "column", F.lit("wasserstein").alias("stattest"), F.col("drift_score").alias("score")))
        if len(numeric) < len(self.kinds):
            of_ref = whole.where(~F.col("column").isin(numeric)).select("column", F.col("text").alias("value"), "r")
            of_cur = own.where(~F.col("column").isin(numeric)).select("batch", "column", F.col("text").alias("value"), "c")
            found = categorical_drift_of_counts(of_ref, of_cur, "batch")
            parts.append(found.select("batch", "column", F.lit("jensenshannon").alias("stattest"), F.col("js").alias("score")))
        report = reduce(DataFrame.unionByName, parts)
        return report.select("*", F.lit(DISTANCE_THRESHOLD).alias("threshold"), (F.col("score") >= DISTANCE_THRESHOLD).alias("drifted"))
