"""The preparation pipelines, as compositions of panel operators.

All of them take the whole panel and a condition that marks the training rows, so training and test rows
go through the same scan and shuffle. ``stats`` replaces the fit by statistics that were saved earlier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators import history
from panelweave.operators.encode import drop_sparse_columns, one_hot
from panelweave.operators.stats import fit_stats, impute, impute_and_scale
from panelweave.spec import PanelSpec
from panelweave.workspace import materialise


def encode(
    panel: DataFrame, spec: PanelSpec, column: str, categories: list, position: str = "in_place"
) -> tuple[DataFrame, PanelSpec]:
    """One-hot encode a static column with categories fixed on the training rows."""
    names = [f"{column}_{value}" for value in categories]
    return one_hot(panel, column, categories, position), spec.encoded(column, names, position)


def prepare_v1(
    panel: DataFrame,
    spec: PanelSpec,
    train: Column | None = None,
    stats: DataFrame | dict | None = None,
    drop: int = 5,
    keep: int = 50,
    group_rows: int | None = None,
) -> DataFrame:
    """Forward-fill, trim, fill with training means, scale. Without ``train`` every row is fitted on.

    For a fit the trimmed rows, at most ``keep`` an entity, are written once: the fit and whatever reads the result then
    take their own columns from there, and the panel itself is scanned and shuffled once.
    """
    trimmed = history.ffill_trim(panel, spec, drop, keep, group_rows)
    if stats is None:
        trimmed = materialise(trimmed, "trimmed")
        stats = fit_stats(trimmed, spec.features, train)
    return impute_and_scale(trimmed, spec.features, stats)


def prepare_v2(
    panel: DataFrame,
    spec: PanelSpec,
    train: Column | None = None,
    stats: DataFrame | dict | None = None,
    drop: int = 5,
    keep: int = 50,
) -> DataFrame:
    """Fill with training means, scale, then trim. The fit sees the untrimmed rows.

    Filling and scaling work row by row, so they run on the rows that the trim leaves.
    """
    # The fit has no shuffle in common with the trim, so it reads its own columns only.
    fitted = fit_stats(panel, spec.features, train) if stats is None else stats
    return impute_and_scale(history.trim_tail(panel, spec, drop, keep), spec.features, fitted)


def _long_enough(panel: DataFrame, spec: PanelSpec, train: Column, n: int) -> DataFrame:
    """Drop training entities with fewer than ``n`` rows; an entity lies wholly inside or outside of train."""
    lengths = panel.where(train).groupBy(spec.entity).agg(F.count(F.lit(1)).alias("__n"))
    short = history.entity_list(lengths.where(F.col("__n") < n).select(spec.entity))
    return panel.join(short, spec.entity, "left_anti")


def prepare_v3(
    panel: DataFrame, spec: PanelSpec, train: Column, min_rows: int = 15, group_rows: int | None = None
) -> tuple[DataFrame, PanelSpec]:
    """Drop columns that are empty on train, drop short training histories, forward-fill, fill with means."""
    rows, kept = drop_sparse_columns(panel.where(train), [panel], spec.features)
    spec = spec.with_features(*[c for c in spec.features if c in rows.columns])
    filled = history.ffill(_long_enough(kept, spec, train, min_rows), spec, group_rows=group_rows)
    return impute(filled, spec.features, fit_stats(filled, spec.features, train, share_scan=True)), spec


def prepare_v4(
    panel: DataFrame,
    spec: PanelSpec,
    train: Column,
    drop_features: tuple[str, ...] = (),
    min_rows: int = 15,
    group_rows: int | None = None,
) -> tuple[DataFrame, PanelSpec]:
    """Drop short training histories, forward-fill, drop low-value columns, fill with 0, scale."""
    spec = spec.without(*drop_features)
    lean = panel.drop(*drop_features)
    filled = history.ffill(_long_enough(lean, spec, train, min_rows), spec, group_rows=group_rows)
    stats = fit_stats(filled, spec.features, train, share_scan=True)
    return impute_and_scale(filled, spec.features, stats, how="zero"), spec
