"""Packing entity histories into fixed-length sequences, and unpacking them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelweave.functions.arrays import pad
from panelweave.spec import PanelSpec


def to_sequences(df: DataFrame, spec: PanelSpec, max_len: int = 50, min_len: int = 15) -> DataFrame:
    """One row per entity with at least ``min_len`` rows: (entity, n_steps, x, y).

    ``x`` holds one feature vector per step and ``y`` the labels, oldest first. Only the first ``max_len``
    rows are packed, which is all that padding keeps; the bound is applied to the rank before the
    shuffle, so no entity is gathered beyond ``max(max_len, min_len)`` rows.
    """
    most = max(max_len, min_len)
    oldest_first = Window.partitionBy(spec.entity).orderBy(*spec.order)
    vector = F.array(*[F.col(c).cast("double") for c in spec.features])
    step = F.struct(F.col("__rank").alias("at"), vector.alias("x"), F.col(spec.label).cast("int").alias("y"))
    packed = (
        df.withColumn("__rank", F.row_number().over(oldest_first))
        .where(F.col("__rank") <= most)
        .groupBy(spec.entity)
        .agg(F.sort_array(F.collect_list(step)).alias("steps"))
        .where(F.size("steps") >= min_len)
        .withColumn("steps", F.slice("steps", 1, max_len))
    )
    return packed.select(
        spec.entity,
        F.size("steps").alias("n_steps"),
        F.transform("steps", lambda s: s["x"]).alias("x"),
        F.transform("steps", lambda s: s["y"]).alias("y"),
    )


def pad_sequences(
    sequences: DataFrame,
    width: int,
    max_len: int = 50,
    side: str = "pre",
    truncate: str = "post",
    label_side: str | None = None,
    label_truncate: str | None = None,
) -> DataFrame:
    """Pad ``x`` with zero vectors of ``width`` and ``y`` with 0 to ``max_len`` steps.

    Labels go to the same side as the vectors unless ``label_side`` says otherwise.
    """
    zero = F.array_repeat(F.lit(0.0), width)
    return sequences.withColumn("x", pad(F.col("x"), max_len, zero, side, truncate)).withColumn(
        "y", pad(F.col("y"), max_len, F.lit(0), label_side or side, label_truncate or truncate)
    )


def validate_shape(sequences: DataFrame, max_len: int, width: int) -> DataFrame:
    """Fail the job when a sequence is not ``max_len`` steps of ``width`` values with as many labels."""
    fits = (
        (F.size("x") == max_len)
        & (F.size("y") == max_len)
        & F.forall("x", lambda v: F.size(v) == width)
    )
    message = F.lit(f"sequence does not have the shape ({max_len}, {width})")
    # A filter, so that a reader who does not select the vectors cannot prune it.
    return sequences.where(F.when(fits, True).otherwise(F.raise_error(message).cast("boolean")))


def flatten_steps(padded: DataFrame, entity: str, max_len: int = 50, side: str = "pre") -> DataFrame:
    """One row per step, padding included: (entity, step, padded, x, y)."""
    n = F.least(F.col("n_steps"), F.lit(max_len))
    exploded = padded.select(entity, n.alias("__n"), F.posexplode(F.arrays_zip("x", "y")).alias("step", "s"))
    is_padding = (
        F.col("step") < F.lit(max_len) - F.col("__n") if side == "pre" else F.col("step") >= F.col("__n")
    )
    return exploded.select(
        entity, "step", is_padding.alias("padded"), F.col("s.x").alias("x"), F.col("s.y").alias("y")
    )


def unpack_features(steps: DataFrame, names: list[str]) -> DataFrame:
    """Replace the vector column ``x`` by one column per feature."""
    rest = [c for c in steps.columns if c != "x"]
    return steps.select(*rest, *[F.get("x", F.lit(i)).alias(name) for i, name in enumerate(names)])
