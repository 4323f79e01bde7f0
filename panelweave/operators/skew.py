"""Ordered work over groups of any size.

A window partitioned by entity puts all rows of that entity into one task. When a single entity
holds a large part of the table this does not scale, so the operators here cut the oversized
groups (and only those) into consecutive segments of their order, work inside the segments and
carry a small summary from one segment to the next.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.workspace import materialise

SEGMENT = "__segment"

# A group of up to this many rows is left to one task: a sort of that size stays in memory.
GROUP_ROWS = 1_000_000

# Keys of oversized groups are sent to every executor up to this number; beyond it they are joined
# without a hint. There are at most (all rows / rows per group) of them.
HOT_KEYS_SENT = 100_000


def rows_per_group(df: DataFrame, total: int, group_rows: int | None) -> int:
    """Rows one task may take from one group: a fair share of the table, but not less than GROUP_ROWS."""
    if group_rows is not None:
        return group_rows
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(GROUP_ROWS, math.ceil(total / tasks))


def cut_hot_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    group_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame | None:
    """Add a segment number to every row, or return None when every group fits one task.

    Rows of groups that fit get segment 0. Rows of oversized groups are dealt into ranges of (keys, order) by a
    sampled sort over all these columns, of whatever type, and each range is a segment: about half of
    ``group_rows`` rows, which follow each other. The ranges are drawn anew whenever they are computed, so these rows
    are written to the shared folder with their segments. A null key is a key like any other. Only row counts and the
    keys of oversized groups reach the driver; there are at most (all rows / rows per group) of them.
    ``at_most`` is a known bound on the rows of any group; a small one saves the counting.
    """
    keys, order = list(keys), list(order)
    if at_most is not None and at_most <= rows_per_group(df, at_most, group_rows):
        return None
    narrow = df.select(*keys, *order)
    total = at_most if at_most is not None and not keys else narrow.count()
    limit = rows_per_group(df, total, group_rows)
    if total <= limit:
        return None

    cold, hot, hot_rows = None, df, total
    if keys:
        sizes = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        found = sizes.where(F.col("__n") > limit)
        listed = found.limit(HOT_KEYS_SENT + 1).collect()
        if not listed:
            return None
        if len(listed) <= HOT_KEYS_SENT:
            hot_rows = sum(row["__n"] for row in listed)
            large = F.broadcast(df.sparkSession.createDataFrame(listed, found.schema).select(*keys))
        else:
            hot_rows = found.agg(F.sum("__n")).first()[0]
            large = found.select(*keys)
        cold = matching(df, large, keys, "left_anti").withColumn(SEGMENT, F.lit(0))
        hot = matching(df, large, keys, "left_semi")

    # Segments of half the limit: the ranges of a sampled sort are not quite even.
    parts = 2 * math.ceil(hot_rows / limit)
    ranged = hot.repartitionByRange(parts, *keys, *order)
    segments = materialise(ranged.withColumn(SEGMENT, F.spark_partition_id() + 1), "segments")
    return segments if cold is None else cold.unionByName(segments)


def same_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``other`` with its keys renamed, and the condition that they equal those of ``df``, null to null."""
    renamed = other.withColumnsRenamed({k: f"__same_{k}" for k in keys})
    return renamed, [F.col(k).eqNullSafe(F.col(f"__same_{k}")) for k in keys]


def matching(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi- or anti-join by key: a null key is a key like any other."""
    renamed, same = same_keys(df, other.select(*keys), keys)
    return df.join(renamed, same, how)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, str],
    following: dict[str, str] | None = None,
    group_rows: int | None = None,
    at_most: int | None = None,
    cut: DataFrame | None = None,
    latest: dict[str, str] | None = None,
) -> DataFrame:
    """Running sums (inclusive) per group, in order, plus the next row's value of some columns and the last known one of others.

    ``totals`` maps an output column to the column it sums; ``following`` maps an output column to
    the column whose value in the next row it takes (null in the last row of the group), ``latest`` to the column whose
    last value so far, nulls left out, it takes. ``cut`` is the result of ``cut_hot_groups`` if the caller already has it.
    """
    keys, order = list(keys), list(order)
    following, latest = following or {}, latest or {}
    partition = keys or [F.lit(0)]
    if cut is None:
        cut = cut_hot_groups(df, keys, order, group_rows, at_most)
    if cut is None:
        w = Window.partitionBy(*partition).orderBy(*order)
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        return df.select(
            "*",
            *[F.sum(c).over(upto).alias(name) for name, c in totals.items()],
            *[F.lead(c).over(w).alias(name) for name, c in following.items()],
            *[F.last(c, ignorenulls=True).over(upto).alias(name) for name, c in latest.items()],
        )

    w = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.select(
        "*",
        *[F.sum(c).over(upto).alias(name) for name, c in totals.items()],
        *[F.lead(c).over(w).alias(name) for name, c in following.items()],
        *[F.last(c, ignorenulls=True).over(upto).alias(name) for name, c in latest.items()],
        F.lead(F.lit(1)).over(w).isNull().alias("__last"),
    )
    # One row per (group, segment): what came before it and what comes right after it.
    summary = cut.groupBy(*keys, SEGMENT).agg(
        *[F.sum(c).alias(f"__sum_{name}") for name, c in totals.items()],
        *[F.min_by(c, F.struct(*order)).alias(f"__head_{name}") for name, c in following.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"__tail_{name}") for name, c in latest.items()],
        F.count(F.lit(1)).alias("__rows"),
    ).where(F.col(SEGMENT) > 0)
    ws = Window.partitionBy(*partition).orderBy(SEGMENT)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *keys,
        SEGMENT,
        *[F.sum(f"__sum_{name}").over(before).alias(f"__before_{name}") for name in totals],
        *[F.lead(f"__head_{name}").over(ws).alias(f"__next_{name}") for name in following],
        *[F.last(f"__tail_{name}", ignorenulls=True).over(before).alias(f"__known_{name}") for name in latest],
    )
    renamed, same = same_keys(inside, offsets, [*keys, SEGMENT])
    joined = inside.join(renamed, same, "left")
    shifted = [
        (F.col(name) + F.coalesce(F.col(f"__before_{name}"), F.lit(0))).alias(name) for name in totals
    ]
    passed = [
        F.when(F.col("__last"), F.col(f"__next_{name}")).otherwise(F.col(name)).alias(name)
        for name in following
    ]
    known = [F.coalesce(name, f"__known_{name}").alias(name) for name in latest]
    return joined.select(*df.columns, *shifted, *passed, *known)
