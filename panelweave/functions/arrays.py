"""Array expressions for fixed-length sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad(steps: Column, length: int, fill: Column, side: str = "pre", truncate: str = "post") -> Column:
    """Bring an array to ``length`` items.

    ``side`` says where ``fill`` goes; ``truncate="post"`` keeps the first items of a longer array,
    ``"pre"`` the last ones.
    """
    if side not in ("pre", "post") or truncate not in ("pre", "post"):
        raise ValueError("side and truncate are 'pre' or 'post'")
    if truncate == "post":
        kept = F.slice(steps, 1, length)
    else:
        kept = F.when(F.size(steps) > length, F.slice(steps, -length, length)).otherwise(steps)
    missing = F.greatest(F.lit(length) - F.size(steps), F.lit(0))
    filler = F.array_repeat(fill, missing)
    return F.concat(filler, kept) if side == "pre" else F.concat(kept, filler)


def dot(vector: Column, weights: list[float], bias: float = 0.0) -> Column:
    """``weights . vector + bias``, summed in the order of the weights."""
    total = F.lit(float(bias))
    for i, w in enumerate(weights):
        total = total + F.get(vector, F.lit(i)) * F.lit(float(w))
    return total


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
