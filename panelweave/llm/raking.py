"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells of source, language and topic, by tokens. Each sweep scales the cells of one margin
after the other to its targets. The ratio of a cell's fitted to its counted share, over the largest ratio, is the
probability with which each of its documents is kept; tokens kept then have the target margins in expectation. Where that
keeps less than the share ``keep`` of all tokens, as one rare cell with a large ratio can bring about, the scale is raised until
``keep`` is reached: probabilities are capped at 1, and what capped cells cannot take goes to the others in proportion, so margins
are then as near to the targets as documents kept once allow. A document is drawn by a digest of its id, so a rerun draws the same.

With a ``tolerance``, sweeps go on past their stated number until the largest relative error of a margin (one number a sweep on the
driver) is at most that. Targets that no weights can meet, as where empty cells stand in the way, would go on for ever: sweeps end
once ten of them lower the error by less than a hundredth, with a warning that names it.

The cells are a table like any other: sweeps are joins and sums of it, written to the shared folder after each margin. Counting
them is the one pass over the documents, summed in each task before the shuffle.

A null category is a category of its own. A category without a target keeps no document; targets without documents are left out and
the others scaled to 1. A null or empty text has no tokens and goes with its cell; a cell without tokens keeps its documents.
An empty table gives no rows.
Documents without an id are drawn by the empty text. Rows repeated under one id are drawn alike. ``draw`` keeps all
columns as they came.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.workspace import materialise

#: Hexadecimal digits of the digest that draws.
_DIGITS = 13
#: Sweeps end without success when so many of them leave more than this share of the error.
_STALL, _LEFT = 10, 0.99


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def length_topic(tokens: Column) -> Column:
    """A stand-in for a topic where documents carry none: their form by length."""
    return F.when(tokens < 100, "short").when(tokens < 1000, "medium").otherwise("long")


def uniform(key: Column) -> Column:
    """A number from 0 up to 1, fixed by the key."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**_DIGITS)


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Targets that are the counted shares of a margin, raised to ``power`` and scaled to 1: below 1, nearer to even."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0")
    raised = sums.select(F.col(margin).alias("name"), F.pow("tokens", F.lit(power)).alias("target"))
    return scaled(raised)


def scaled(targets: DataFrame) -> DataFrame:
    total = targets.agg(F.sum("target"))
    return targets.select("name", (F.col("target") / total.scalar()).alias("target"))


def count_cells(docs: DataFrame, margins: list[str], tokens: Column) -> DataFrame:
    return materialise(docs.groupBy(*margins).agg(F.sum(tokens).alias("tokens")), "cells")


def margin_error(fitted: DataFrame, targets: Mapping[str, DataFrame]) -> float:
    """The largest relative error of a margin of ``weight``, over names with a target."""
    parts = []
    for margin, table in targets.items():
        sums = fitted.groupBy(F.col(margin).alias("name")).agg(F.sum("weight").alias("sum"))
        both = table.withColumnRenamed("name", "aim").join(sums, F.col("aim").eqNullSafe(F.col("name")), "left").where("target > 0")
        parts.append(both.agg(F.max(F.abs(F.coalesce("sum", F.lit(0.0)) / F.col("target") - 1)).alias("error")))
    return reduce(DataFrame.unionAll, parts).agg(F.max("error")).first()[0] or 0.0 if parts else 0.0


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int = 10, tolerance: float | None = None) -> DataFrame:
    """Cells with their fitted ``weight`` (shares of all tokens) after ``sweeps`` rounds over the margins, or as many more as ``tolerance`` takes."""
    fitted = cells.withColumn("weight", F.col("tokens").cast("double"))
    known = {}
    for margin, table in targets.items():
        # Only names that cells have, scaled to 1 again.
        present = cells.where("tokens > 0").select(F.col(margin).alias("name")).distinct()
        known[margin] = materialise(scaled(table.alias("t").join(present.alias("p"), F.col("t.name").eqNullSafe(F.col("p.name"))).select("t.name", "t.target")), "targets")
    errors: list[float] = []
    done = 0
    while True:
        if done >= sweeps:
            if tolerance is None:
                return fitted
            errors.append(margin_error(fitted, known))
            if errors[-1] <= tolerance:
                return fitted
            if len(errors) > _STALL and errors[-1] > _LEFT * errors[-1 - _STALL]:
                warnings.warn(f"margins are off their targets by up to {errors[-1]:.3g} after {done} sweeps, and more sweeps do not help", stacklevel=2)
                return fitted
        for margin, table in known.items():
            sums = fitted.groupBy(margin).agg(F.sum("weight").alias("sum")).withColumnRenamed(margin, "name")
            factors = sums.join(table.withColumnRenamed("name", "aim"), F.col("name").eqNullSafe(F.col("aim")), "left")
            factors = factors.select("name", F.when(F.col("sum") > 0, F.coalesce("target", F.lit(0.0)) / F.col("sum")).otherwise(0.0).alias("factor"))
            joined = fitted.join(factors, F.col(margin).eqNullSafe(F.col("name")))
            # Written at once: each step reads the weights twice, so steps left unwritten would double the plan.
            fitted = materialise(joined.select(*cells.columns, (F.col("weight") * F.col("factor")).alias("weight")), "raked")
        done += 1


def largest_ratio(fitted: DataFrame, keep: float | None = None) -> float:
    """The ratio of weight to tokens from which on a cell is kept whole: the largest one, or one low enough to keep ``keep`` of all tokens."""
    with_tokens = fitted.where("tokens > 0")
    first = with_tokens.agg(F.max(F.col("weight") / F.col("tokens")).alias("top"), F.sum("tokens").alias("tokens")).first()
    top = first["top"] or 1.0
    if keep is None:
        return top
    # Each round caps more cells, on one row at the driver, until the rest takes what is left without a new cap.
    while True:
        capped = F.col("weight") / F.col("tokens") >= top
        parts = with_tokens.where("weight > 0").agg(F.sum(F.when(capped, F.col("tokens"))).alias("whole"), F.sum(F.when(~capped, F.col("weight"))).alias("free")).first()
        left = keep * first["tokens"] - (parts["whole"] or 0) if first["tokens"] else 0
        if not parts["free"] or left <= 0 or parts["free"] / left >= top * (1 - 1e-12):
            # With no cell left to scale, all cells with a target are whole.
            return top
        top = parts["free"] / left


def probabilities(fitted: DataFrame, keep: float | None = None) -> DataFrame:
    """``probability`` of each cell's documents."""
    ratio = F.col("weight") / F.col("tokens") / F.lit(largest_ratio(fitted, keep))
    share = F.when(F.col("tokens") > 0, F.round(F.least(ratio, F.lit(1.0)), 9)).otherwise(1.0)
    return fitted.withColumn("probability", share)


def mixed(docs: DataFrame, targets: Mapping[str, DataFrame | float], sweeps: int = 10, key: str = "doc_id", text: str = "text", keep: float | None = None, tolerance: float | None = None) -> DataFrame:
    """All columns of ``docs``, with ``topic``, ``n_tokens``, ``weight`` (of its cell), ``probability`` and ``kept`` added.

    ``targets`` by margin (``source``, ``lang``, ``topic``): a table of ``name`` and ``target``, or the power that tempers
    the counted shares. A column ``topic`` of ``docs`` is used as it is; without one, length stands in. ``keep`` is the least
    share of all tokens to keep; ``tolerance`` is what ``rake`` makes of it.
    """
    tokens = n_tokens(F.col(text))
    topic = F.col("topic") if "topic" in docs.columns else length_topic(tokens)
    margins = list(targets)
    named = docs.select(F.struct(*docs.columns).alias("row"), *[topic.alias(m) if m == "topic" else F.col(m) for m in margins], tokens.alias("n_tokens"))
    cells = count_cells(named.select(*margins, "n_tokens"), margins, F.col("n_tokens"))
    tables = {m: tempered(cells, m, t) if isinstance(t, (int, float)) else t for m, t in targets.items()}
    fitted = probabilities(rake(cells, tables, sweeps, tolerance), keep).select(*[F.col(m).alias(f"cell_{m}") for m in margins], "weight", "probability")
    same = [F.col(m).eqNullSafe(F.col(f"cell_{m}")) for m in margins]
    joined = named.join(fitted, same, "left")
    drawn = uniform(F.col(f"row.{key}")) < F.col("probability")
    own = [c for c in ("topic", "n_tokens", "weight", "probability", "kept") if c not in docs.columns and (c != "topic" or c in margins)]
    return joined.withColumn("kept", drawn).select("row.*", *own)


def draw(docs: DataFrame, targets: Mapping[str, DataFrame | float], sweeps: int = 10, key: str = "doc_id", text: str = "text", keep: float | None = None, tolerance: float | None = None) -> DataFrame:
    """The documents drawn, with the columns of ``docs``."""
    inner = docs.select(F.struct(*docs.columns).alias("row"), *[c for c in {key, text, *targets} if c in docs.columns])
    return mixed(inner, targets, sweeps, key, text, keep, tolerance).where("kept").select("row.*")
