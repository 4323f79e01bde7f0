"""Column-level preparation: dropping columns and turning categories into indicators."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns by name; an unknown name is an error rather than a silent no-op."""
    unknown = sorted(set(names) - set(df.columns))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.drop(*names)


def fit_categories(train: DataFrame, column: str, max_categories: int = 1000) -> list[Any]:
    """The non-null values of ``column`` on the training rows, ascending.

    The list becomes columns, so it must be short: more than ``max_categories`` values is an error. ``category_rows`` has no
    such limit.
    """
    found = (
        train.where(F.col(column).isNotNull()).select(column).distinct().limit(max_categories + 1).collect()
    )
    if len(found) > max_categories:
        raise ValueError(f"{column} has more than {max_categories} categories")
    return sorted(row[0] for row in found)


def indicator_names(column: str, categories: Sequence[Any], prefix: str | None = None) -> list[str]:
    return [f"{prefix or column}_{value}" for value in categories]


def category_rows(df: DataFrame, keys: Sequence[str], column: str, prefix: str | None = None) -> DataFrame:
    """The long form of ``one_hot``, for any number of categories: (keys..., category), a row for each indicator that is 1."""
    name = F.concat(F.lit(f"{prefix or column}_"), F.col(column).cast("string"))
    return df.where(F.col(column).isNotNull()).select(*keys, name.alias("category"))


def one_hot(
    df: DataFrame,
    column: str,
    categories: Sequence[Any] | None = None,
    position: str = "in_place",
    prefix: str | None = None,
) -> DataFrame:
    """Replace ``column`` by one 0/1 column per category; a null or unseen value gives zeros everywhere.

    ``position`` puts the indicators where the column was (``in_place``) or after the last column (``end``).
    """
    if position not in ("in_place", "end"):
        raise ValueError(f"unknown position {position!r}")
    if categories is None:
        categories = fit_categories(df, column)
    indicators = [
        F.coalesce(F.col(column) == F.lit(value), F.lit(False)).cast("int").alias(name)
        for value, name in zip(categories, indicator_names(column, categories, prefix))
    ]
    if position == "end":
        return df.select(*[c for c in df.columns if c != column], *indicators)
    out = []
    for c in df.columns:
        out.extend(indicators if c == column else [F.col(c)])
    return df.select(*out)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls and null share of each column, as (column, n_rows, n_null, null_share)."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(c)).alias(f"__{i}") for i, c in enumerate(columns)],
    )
    per_column = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), (F.col("n_rows") - F.col(f"__{i}")).alias("n_null"))
                for i, c in enumerate(columns)
            ]
        )
    )
    return counts.select("n_rows", per_column.alias("p")).select(
        "p.column",
        "n_rows",
        "p.n_null",
        F.coalesce(F.try_divide(F.col("p.n_null"), F.col("n_rows")), F.lit(0.0)).alias("null_share"),
    )


def sparse_columns(train: DataFrame, columns: Sequence[str], max_null_share: float = 1.0) -> list[str]:
    """Columns whose share of nulls on the training rows reaches ``max_null_share``."""
    profile = null_profile(train, columns).where(F.col("null_share") >= max_null_share)
    return [row["column"] for row in profile.select("column").collect()]


def drop_sparse_columns(
    train: DataFrame, others: Sequence[DataFrame], columns: Sequence[str], max_null_share: float = 1.0
) -> list[DataFrame]:
    """Drop the columns that are too empty on ``train`` from ``train`` and from every other panel."""
    gone = sparse_columns(train, columns, max_null_share)
    return [frame.drop(*gone) for frame in (train, *others)]
