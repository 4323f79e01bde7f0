"""Splitting a panel into training, test and validation parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.operators.skew import same_keys


def split_by_id_range(df: DataFrame, entity: str, bounds: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Name the half-open id ranges ``(-inf, b0], (b0, b1], ...``; ids beyond the last bound are dropped."""
    if len(bounds) != len(names) or list(bounds) != sorted(bounds):
        raise ValueError("one name per bound, bounds ascending")
    part = None
    for bound, name in zip(bounds, names):
        test = F.col(entity) <= bound
        part = F.when(test, name) if part is None else part.when(test, name)
    return df.where(F.col(entity) <= bounds[-1]).withColumn("split", part)


def hash_bucket(*columns: str, buckets: int = 100, seed: int | None = None) -> Column:
    """A bucket 0..buckets-1 that depends on the values only, so reruns and other engines agree on it."""
    parts = [F.col(c).cast("string") for c in columns]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    text = F.concat_ws("|", *parts)
    return (F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint") % buckets).cast("int")


def hash_split(
    df: DataFrame, key: Sequence[str] | str, weights: dict[str, int], seed: int | None = None
) -> DataFrame:
    """Add column ``split`` by hashing ``key``; weights are shares of their sum.

    Hash the entity and all of its rows land in one part; hash the row key for a split by row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    bucket = hash_bucket(*keys, buckets=sum(weights.values()), seed=seed)
    part, upper = None, 0
    for name, weight in weights.items():
        upper += weight
        test = F.col("__bucket") < upper
        part = F.when(test, name) if part is None else part.when(test, name)
    return df.withColumn("__bucket", bucket).withColumn("split", part).drop("__bucket")


#: Parts of the range of hashes in which entities are counted and ranked, for each stratum.
_CELLS = 4096


def entity_draw(entity: str) -> Column:
    """A number of 52 bits that orders entities at random, the same in every run and engine."""
    digits = F.substring(F.md5(F.coalesce(F.col(entity).cast("string"), F.lit(""))), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint")


def stratified_parts(entities: DataFrame, entity: str, stratum: str, weights: dict[str, int]) -> DataFrame:
    """``entities`` (one row each) with ``split``: in every stratum each part has its exact share, to within one entity.

    Entities are ordered by hash. Instead of a sort of a whole stratum, a histogram of the hashes tells how many come before
    each of its cells, and the order within a cell is all that is ranked; hashes are even, so cells are. Equal hashes are ordered by
    entity. A null stratum, and a null entity, is one like any other.
    """
    drawn = entities.withColumn("__draw", entity_draw(entity))
    drawn = drawn.withColumn("__cell", F.floor(F.col("__draw") / (16**13 // _CELLS)).cast("int"))
    counts = drawn.groupBy(stratum, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    # At most ``_CELLS`` rows a stratum.
    whole = Window.partitionBy(stratum)
    before = whole.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        stratum, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("__all")
    )
    inside = Window.partitionBy(stratum, "__cell").orderBy("__draw", entity)
    renamed, same = same_keys(drawn, base, [stratum, "__cell"])
    place = F.col("__before") + F.col("__place")
    ranked = drawn.withColumn("__place", F.row_number().over(inside)).join(renamed, same)
    total, upper, part = sum(weights.values()), 0, None
    for name, weight in weights.items():
        upper += weight
        # Half an entity more goes to the parts named first.
        test = place <= F.floor((2 * F.col("__all") * upper + total) / (2 * total))
        part = F.when(test, name) if part is None else part.when(test, name)
    return ranked.withColumn("split", part).select(*entities.columns, "split")


def stratified_split(df: DataFrame, entity: str, label: str, weights: dict[str, int]) -> DataFrame:
    """Add column ``split`` by entity, each part with its exact share of the entities with a positive label, and of those without."""
    entities = df.groupBy(entity).agg(F.coalesce(F.max(F.col(label) == 1), F.lit(False)).alias("__stratum"))
    parts = stratified_parts(entities, entity, "__stratum", weights).select(entity, "split")
    renamed, same = same_keys(df, parts, [entity])
    return df.join(renamed, same).select(*df.columns, "split")
