"""Operators over the ordered history of each entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.operators.skew import SEGMENT, cut_hot_groups, matching, rows_per_group, running_totals, same_keys
from panelweave.spec import PanelSpec
from panelweave.workspace import materialise


def _newest_first(spec: PanelSpec):
    return Window.partitionBy(spec.entity).orderBy(*[F.col(c).desc() for c in spec.order])


def entity_lengths(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows per entity, as (entity, n_rows)."""
    return df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n_rows"))


def entities(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The distinct entities."""
    return df.select(spec.entity).distinct()


def limit_entities(df: DataFrame, spec: PanelSpec, n: int) -> DataFrame:
    """Rows of the ``n`` smallest entity ids, of which null is the smallest. The chosen ids are ``n`` rows, so they are sent to all tasks."""
    chosen = entities(df, spec).orderBy(spec.entity).limit(n)
    if n <= 100_000:
        chosen = F.broadcast(chosen)
    return matching(df, chosen, [spec.entity], "left_semi")


def min_history(df: DataFrame, spec: PanelSpec, n: int = 15) -> DataFrame:
    """Rows of entities with at least ``n`` rows."""
    enough = entity_lengths(df, spec).where(F.col("n_rows") >= n).select(spec.entity)
    return matching(df, entity_list(enough), [spec.entity], "left_semi")


def entity_list(chosen: DataFrame) -> DataFrame:
    """Chosen entities as a written table, to filter a panel by.

    Spark then knows the size of the list before it plans the join: a short list is broadcast and the panel is
    not shuffled at all. For a long one both sides of the join are plain shuffles, which is what AQE needs to
    split the tasks of an oversized entity; an aggregate in between would prevent that.
    """
    return materialise(chosen, "entities")


def ffill(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str] | None = None, group_rows: int | None = None
) -> DataFrame:
    """Replace nulls by the last earlier non-null value of the entity; leading nulls stay."""
    columns = list(columns or spec.features)
    cut = cut_hot_groups(df, [spec.entity], spec.order, group_rows, spec.max_history)
    if cut is not None:
        return _ffill_segments(cut, spec, columns).select(*df.columns)
    upto = Window.partitionBy(spec.entity).orderBy(*spec.order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select(*_filled(df.columns, columns, upto))


def _ffill_segments(cut: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> DataFrame:
    """Fill inside each segment, then fill what is left from the segments before it."""
    w = Window.partitionBy(spec.entity, SEGMENT).orderBy(*spec.order)
    filled = cut.select(
        *_filled(cut.columns, columns, w.rowsBetween(Window.unboundedPreceding, 0)),
        F.lead(F.lit(1)).over(w).isNull().alias("__last"),
    )
    # The last row of a segment holds the last known values up to there.
    ends = filled.where(F.col("__last") & (F.col(SEGMENT) > 0)).select(spec.entity, SEGMENT, *columns)
    before = Window.partitionBy(spec.entity).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        spec.entity,
        SEGMENT,
        *[F.last(c, ignorenulls=True).over(before).alias(f"__carry_{c}") for c in columns],
    )
    renamed, same = same_keys(filled, carried, [spec.entity, SEGMENT])
    joined = filled.join(renamed, same, "left")
    return joined.select(
        *[
            F.coalesce(F.col(c), F.col(f"__carry_{c}")).alias(c) if c in columns else F.col(c)
            for c in cut.columns
        ]
    )


def _filled(all_columns: Sequence[str], fill: Sequence[str], window) -> list[Column]:
    return [F.last(c, ignorenulls=True).over(window).alias(c) if c in fill else F.col(c) for c in all_columns]


def drop_last(df: DataFrame, spec: PanelSpec, k: int = 5) -> DataFrame:
    """Drop the newest ``k`` rows of each entity; entities with at most ``k`` rows vanish.

    Only the keys of the newest ``k`` rows are ranked, which Spark cuts to ``k`` per entity and task before
    shuffling. The panel is then anti-joined on its unique row key, which spreads an oversized entity evenly.
    """
    if k <= 0:
        return df
    newest = (
        df.select(*spec.keys)
        .withColumn("__rank", F.row_number().over(_newest_first(spec)))
        .where(F.col("__rank") <= k)
        .select(*spec.keys)
    )
    return matching(df, newest, spec.keys, "left_anti")


def trim_tail(df: DataFrame, spec: PanelSpec, drop: int = 5, keep: int = 50) -> DataFrame:
    """Drop the newest ``drop`` rows, then keep the newest ``keep`` of the rest.

    The bound on the rank lets Spark cut each entity to ``drop + keep`` rows per task before the shuffle.
    """
    return (
        df.withColumn("__rank", F.row_number().over(_newest_first(spec)))
        .where(F.col("__rank") <= drop + keep)
        .where(F.col("__rank") > drop)
        .drop("__rank")
    )


def keep_last(df: DataFrame, spec: PanelSpec, k: int = 50) -> DataFrame:
    """Keep the newest ``k`` rows of each entity (all if it has fewer)."""
    return trim_tail(df, spec, drop=0, keep=k)


def ffill_trim(
    df: DataFrame, spec: PanelSpec, drop: int = 5, keep: int = 50, group_rows: int | None = None
) -> DataFrame:
    """``trim_tail(ffill(df))`` with one shuffle, one sort and one window when every entity fits a task.

    Values of rows that are cut off the front are carried into the rows that stay.
    """
    cut = cut_hot_groups(df, [spec.entity], spec.order, group_rows, spec.max_history)
    if cut is not None:
        return trim_tail(_ffill_segments(cut, spec, spec.features).select(*df.columns), spec, drop, keep)
    w = Window.partitionBy(spec.entity).orderBy(*spec.order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.col("__n") - F.col("__row")
    return (
        df.select(
            *_filled(df.columns, spec.features, upto),
            F.row_number().over(w).alias("__row"),
            F.count(F.lit(1)).over(whole).alias("__n"),
        )
        .where((after >= drop) & (after < drop + keep))
        .drop("__row", "__n")
    )


def row_numbers(
    df: DataFrame,
    order: Sequence[str],
    name: str = "row_no",
    group_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Number all rows of the table from 0 in a total order, without sorting a large table in one task."""
    counted = running_totals(
        df.withColumn("__one", F.lit(1).cast("bigint")), [], order, {name: "__one"},
        group_rows=group_rows, at_most=at_most,
    )
    return counted.withColumn(name, F.col(name) - 1).drop("__one")


def row_batches(
    df: DataFrame,
    order: Sequence[str],
    size: int = 100,
    max_batches: int | None = 5,
    group_rows: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Consecutive batches of ``size`` rows in a total order, numbered from 0 in column ``batch``.

    The first ``max_batches`` batches are kept; ``max_batches=None`` numbers the whole table.
    """
    if max_batches is not None:
        wanted = size * max_batches
        if wanted <= rows_per_group(df, wanted, group_rows):
            df, at_most = df.orderBy(*order).limit(wanted), wanted
    numbered = row_numbers(df, order, "__row", group_rows, at_most)
    out = numbered.withColumn("batch", F.expr(f"__row div {int(size)}")).drop("__row")
    return out if max_batches is None else out.where(F.col("batch") < max_batches)


def equal_batches(
    df: DataFrame, order: Sequence[str], batches: int = 5, group_rows: int | None = None
) -> DataFrame:
    """The whole table in ``batches`` consecutive batches of equal size."""
    total = df.count()
    size = max(1, -(-total // batches))
    return row_batches(df, order, size, None, group_rows, at_most=total)


def union_panels(*frames: DataFrame) -> DataFrame:
    """Stack panels by column name; a column missing from one of them becomes null there."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
