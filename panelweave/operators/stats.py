"""Statistics fitted on training rows, and the transforms driven by them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KINDS = ("mean", "min", "max", "nulls")


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of each column, nulls skipped, in one row."""
    return df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])


def column_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min, max) of each column, nulls skipped."""
    one = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"__lo_{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"__hi_{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col(f"__lo_{i}").alias("min"), F.col(f"__hi_{i}").alias("max")
            )
            for i, c in enumerate(columns)
        ]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def fit_stats(
    df: DataFrame, columns: Sequence[str], where: Column | None = None, share_scan: bool = False
) -> DataFrame:
    """One row with ``<column>__mean``, ``__min``, ``__max`` and ``__nulls`` for each column.

    ``where`` marks the training rows. It is applied inside the aggregates, not as a filter below them, so
    that the plan under the fit stays the plan under the transform and Spark can reuse its shuffle.
    A mean lies between the bounds, so filling nulls with it leaves them unchanged and one pass is enough;
    it is clamped because a sum of many equal doubles may round past them. With ``share_scan`` the fit also
    reads the columns it has no use for: a transform of the same plan then finds the very same shuffle,
    columns included, and Spark runs it once.
    """
    chosen = F.lit(True) if where is None else where
    out = []
    for c in columns:
        value = F.col(c).cast("double")
        if where is not None:
            value = F.when(chosen, value)
        low, high = F.min(value), F.max(value)
        out += [
            F.greatest(F.least(F.avg(value), high), low).alias(f"{c}__mean"),
            low.alias(f"{c}__min"),
            high.alias(f"{c}__max"),
            F.count_if(chosen & F.col(c).isNull()).alias(f"{c}__nulls"),
        ]
    others = [c for c in df.columns if c not in columns]
    if share_scan and others:
        out.append(F.count_if(F.xxhash64(*others) == 0).alias("__unused"))
    return df.agg(*out)


def _attach(df: DataFrame, stats: DataFrame) -> tuple[DataFrame, Callable[[str, str], Column]]:
    """The one row of statistics as a scalar subquery next to every row; it stays lazy and joins nothing."""
    one = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return df.withColumn("__stats", one), lambda c, kind: F.col("__stats")[f"{c}__{kind}"]


def _literals(df: DataFrame, stats: dict) -> tuple[DataFrame, Callable[[str, str], Column]]:
    """Statistics that are already known, as constants; this is the form a stream uses."""

    def value(c: str, kind: str) -> Column:
        v = stats[f"{c}__{kind}"]
        return F.lit(v).cast("bigint" if kind == "nulls" else "double")

    return df, value


def stats_values(stats: DataFrame) -> dict:
    """The single row of statistics as a dictionary; its size depends on the columns only."""
    return stats.first().asDict()


def _fill(c: str, of: Callable[[str, str], Column], how: str) -> Column:
    value = F.col(c).cast("double")
    if how == "mean":
        return F.coalesce(value, of(c, "mean"), F.lit(0.0))
    if how == "zero":
        return F.coalesce(value, F.lit(0.0))
    raise ValueError(f"unknown way to impute: {how!r}")


def _filled_bounds(c: str, of: Callable[[str, str], Column], how: str) -> tuple[Column, Column]:
    """Bounds of the training column after its nulls were filled."""
    low = F.coalesce(of(c, "min"), F.lit(0.0))
    high = F.coalesce(of(c, "max"), F.lit(0.0))
    if how == "zero":
        had_nulls = of(c, "nulls") > 0
        low = F.when(had_nulls, F.least(low, F.lit(0.0))).otherwise(low)
        high = F.when(had_nulls, F.greatest(high, F.lit(0.0))).otherwise(high)
    return low, high


def _replace(df: DataFrame, names: Sequence[str], new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in names])


def impute(
    df: DataFrame, columns: Sequence[str], stats: DataFrame | dict | None = None, how: str = "mean"
) -> DataFrame:
    """Fill nulls with the training mean and what is left with 0, or with 0 alone (``how="zero"``)."""
    if how == "zero":
        return _replace(df, df.columns, {c: _fill(c, None, how) for c in columns})
    if stats is None:
        raise ValueError("imputing by mean needs statistics")
    wide, of = _literals(df, stats) if isinstance(stats, dict) else _attach(df, stats)
    return _replace(wide, df.columns, {c: _fill(c, of, how) for c in columns})


def impute_and_scale(
    df: DataFrame, columns: Sequence[str], stats: DataFrame | dict, how: str = "mean"
) -> DataFrame:
    """Fill nulls, then map the training range of each column to 0..1.

    Values outside that range are not clipped. A constant training column is divided by 1, so it becomes 0
    on the training rows.
    """
    wide, of = _literals(df, stats) if isinstance(stats, dict) else _attach(df, stats)
    new = {}
    for c in columns:
        low, high = _filled_bounds(c, of, how)
        span = F.when(high > low, high - low).otherwise(F.lit(1.0))
        new[c] = (_fill(c, of, how) - low) / span
    return _replace(wide, df.columns, new)


def min_max_scale(df: DataFrame, columns: Sequence[str], stats: DataFrame | dict) -> DataFrame:
    """Scale without filling: nulls stay null."""
    wide, of = _literals(df, stats) if isinstance(stats, dict) else _attach(df, stats)
    new = {}
    for c in columns:
        low, high = _filled_bounds(c, of, "mean")
        span = F.when(high > low, high - low).otherwise(F.lit(1.0))
        new[c] = (F.col(c).cast("double") - low) / span
    return _replace(wide, df.columns, new)
