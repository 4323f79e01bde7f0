"""Summaries of columns that merge: moments, bounds and quantile sketches, without the old rows.

A summary is a row for each group and column, so summaries of many batches are a table that ``merge`` reduces. The result
does not depend on the order or number of the parts, up to the rounding of double sums. With ``k``, each row also has a quantile sketch
(KLL), whose size depends on ``k`` and not on the rows: the rank it gives a value is off by at most ``rank_error(k)`` of the rows, with 99%
confidence. Values are never sorted or shuffled; tasks send summaries.

Nulls and NaN are counted as nulls and are in no moment. A group without values has null mean, bounds and sketch. A null group is a
group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelweave.operators.drift import STD_FLOOR
from panelweave.operators.skew import same_keys


def summarise(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int | None = None) -> DataFrame:
    """(by..., column, n, nulls, mean, m2, low, high) of every group and column, and ``sketch`` if ``k`` is given; ``m2`` is
    the sum of squared distances from the mean."""
    made = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        value = F.when(~F.isnan(value), value)
        n = F.count(value)
        parts = [
            n.alias("n"), (F.count(F.lit(1)) - n).alias("nulls"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("m2"),
            F.min(value).alias("low"), F.max(value).alias("high"),
        ]
        if k is not None:
            # An empty sketch cannot be asked.
            parts.append(F.when(n > 0, F.kll_sketch_agg_double(value, F.lit(k))).alias("sketch"))
        made.append(F.struct(F.lit(c).alias("column"), *parts).alias(f"__{i}"))
    wide = df.groupBy(*by).agg(*made)
    return wide.select(*by, F.explode(F.array(*[F.col(f"__{i}") for i in range(len(columns))])).alias("s")).select(*by, "s.*")


def merge(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One summary for each ``by`` and column, from those of its parts."""
    same = Window.partitionBy(*by, "column")
    centre = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(same), F.sum("n").over(same))
    off = F.col("mean") - F.col("__centre")
    merged = [
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.first("__centre").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"),
    ]
    if "sketch" in parts.columns:
        merged.append(F.kll_merge_agg_double("sketch").alias("sketch"))
    found = parts.withColumn("__centre", centre).groupBy(*by, "column").agg(*merged)
    return found if "sketch" not in parts.columns else found.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def as_stats(summary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The one row that ``stats.fit_stats`` gives, from a summary without groups, for imputing and scaling."""
    out = []
    for c in columns:
        own = F.col("column") == c

        def of(name: str, own=own):
            return F.max(F.when(own, F.col(name)))

        out += [F.greatest(F.least(of("mean"), of("high")), of("low")).alias(f"{c}__mean"), of("low").alias(f"{c}__min"), of("high").alias(f"{c}__max"), of("nulls").alias(f"{c}__nulls")]
    return summary.agg(*out)


def rank_error(k: int) -> float:
    """Share of the rows by which a sketch's rank of a value may be off, with 99% confidence."""
    return 2.296 / k**0.9021


def sketch_drift(ref: DataFrame, cur: DataFrame, k: int, by: str = "batch", grid: int = 200) -> DataFrame:
    """Distances between the distributions of columns, from sketches made with ``k``: ``ref`` without groups, ``cur`` by ``by``.

    Gives (by, column, n_ref, n_cur, wasserstein, wasserstein_error, drift_score, ks, ks_error). Both distances are taken at ``grid``
    quantiles of each side. A distribution function is off by ``rank_error(k)`` at most, and rises by 1 / grid between
    quantiles, on either side; so ``ks`` is within ``ks_error`` of the exact statistic, and the area between the functions within that much of
    the range of all values. The errors hold with the confidence of the sketches.
    """
    ranks = F.array(*[F.lit((i + 0.5) / grid) for i in range(grid)])
    renamed, same = same_keys(cur, ref.select("column", *[F.col(c).alias(f"r_{c}") for c in ("n", "m2", "low", "high", "sketch")]), ["column"])
    both = cur.where("n > 0").join(renamed, same).where("r_n > 0")
    both = both.withColumn("q", F.kll_sketch_get_quantile_double("sketch", ranks)).withColumn("r_q", F.kll_sketch_get_quantile_double("r_sketch", ranks))

    def upto(quantiles: str, value):
        return F.size(F.filter(quantiles, lambda x: x <= value))

    apart = F.transform(F.concat("q", "r_q"), lambda v: F.abs(upto("q", v) - upto("r_q", v)))
    error = 2 * rank_error(k) + 2 / grid
    distance = F.aggregate(F.zip_with("q", "r_q", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda t, x: t + x) / grid
    span = F.greatest("high", "r_high") - F.least("low", "r_low")
    spread = F.greatest(F.sqrt(F.col("r_m2") / F.col("r_n")), F.lit(STD_FLOOR))
    return both.select(
        by, "column", F.col("r_n").alias("n_ref"), F.col("n").alias("n_cur"), distance.alias("wasserstein"),
        (error * span).alias("wasserstein_error"), (distance / spread).alias("drift_score"),
        (F.array_max(apart) / grid).alias("ks"), F.lit(error).alias("ks_error"),
    )
