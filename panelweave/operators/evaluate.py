"""Scores against labels: confusion counts, metrics, threshold sweeps, alarms."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators.skew import running_totals
from panelweave.workspace import materialise

# The thresholds tried when tuning the alarm.
SWEEP_THRESHOLDS = (0.0001, 0.001, 0.005, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4)


def binarise(score: Column | str, threshold: float) -> Column:
    """1 where the score reaches the threshold, else 0; null where the score is null or NaN."""
    score = F.col(score) if isinstance(score, str) else score
    return F.when(_known(score), (score >= F.lit(float(threshold))).cast("int"))


def _known(score: Column) -> Column:
    """Null and NaN are no scores."""
    return score.isNotNull() & ~F.isnan(score.cast("double"))


def join_scores(labels: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring scores to labels by key; the key is unique per step, so the join spreads evenly. A label without a
    score stays, its score null."""
    return labels.join(scores, list(keys), "left")


def _without_padding(df: DataFrame, include_padding: bool) -> DataFrame:
    return df if include_padding else df.where(~F.col("padded"))


def confusion(
    df: DataFrame,
    threshold: float,
    score: str = "score",
    label: str = "y",
    by: Sequence[str] = (),
    include_padding: bool = True,
) -> DataFrame:
    """True and false negatives and positives, always all four, counting padded steps unless told not to.

    Steps with a null label or a null or NaN score are in none of them; ``unknown`` counts these."""
    known = F.col(label).isNotNull() & _known(F.col(score))
    hit = known & (F.col(score) >= F.lit(float(threshold)))
    positive = F.col(label) == 1
    return (
        _without_padding(df, include_padding)
        .groupBy(*by)
        .agg(
            F.count_if(known & ~hit & ~positive).alias("tn"),
            F.count_if(hit & ~positive).alias("fp"),
            F.count_if(known & ~hit & positive).alias("fn"),
            F.count_if(hit & positive).alias("tp"),
            F.count_if(~known).alias("unknown"),
        )
    )


def confusion_by_padding(
    df: DataFrame, threshold: float, score: str = "score", label: str = "y", by: Sequence[str] = ()
) -> DataFrame:
    """The counts of ``confusion`` with padded steps (``padding`` true) and without them (false), from one pass."""
    counts = confusion(df, threshold, score, label, [*by, "padded"])
    both = F.when(F.col("padded"), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))
    sums = [F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp", "unknown")]
    return counts.withColumn("padding", F.explode(both)).groupBy(*by, "padding").agg(*sums)


def binary_metrics(counts: DataFrame, epsilon: float = 0.0) -> DataFrame:
    """Add sensitivity, precision and F1 to confusion counts; 0 where undefined.

    ``epsilon`` is added to precision + recall, as some libraries do.
    """
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    return (
        counts.withColumn("sensitivity", F.coalesce(F.try_divide(tp, tp + fn), zero))
        .withColumn("precision", F.coalesce(F.try_divide(tp, tp + fp), zero))
        .withColumn(
            "f1",
            F.coalesce(
                F.try_divide(
                    2 * F.col("precision") * F.col("sensitivity"),
                    F.col("precision") + F.col("sensitivity") + F.lit(float(epsilon)),
                ),
                zero,
            ),
        )
    )


def running_metrics(
    counts: DataFrame, order: Sequence[str], epsilon: float = 0.0, by: Sequence[str] = ()
) -> DataFrame:
    """Metrics over all batches so far, from one row of confusion counts per batch, in order."""
    so_far = {f"__{c}": c for c in ("tn", "fp", "fn", "tp")}
    # One row per batch, but costly to make; it is read more than once.
    counts = materialise(counts, "batch-counts")
    walked = running_totals(counts, by, order, so_far)
    keep = [c for c in counts.columns if c not in so_far.values()]
    return binary_metrics(walked.select(*keep, *[F.col(t).alias(c) for t, c in so_far.items()]), epsilon)


def _reached(score: str, thresholds: Sequence[float]) -> Column:
    """The number of thresholds, in ascending order, that a score reaches."""
    reached = F.lit(0)
    for t in thresholds:
        reached = reached + (F.col(score) >= F.lit(t)).cast("int")
    return reached


def _rungs(thresholds: Sequence[float]) -> Column:
    return F.array(*[F.struct(F.lit(i + 1).alias("rung"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)])


def _cells(n: Column) -> list[Column]:
    """The four confusion counts, from sums ``n`` by ``known``, ``positive`` and ``reached``, at the rung ``r``."""
    hit, known, positive = F.col("reached") >= F.col("r.rung"), F.col("known"), F.col("positive")
    cells = {"tn": known & ~hit & ~positive, "fp": known & hit & ~positive, "fn": known & ~hit & positive, "tp": known & hit & positive}
    return [F.sum(F.when(wanted, n).otherwise(F.lit(0))).alias(name) for name, wanted in cells.items()]


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float] = SWEEP_THRESHOLDS,
    score: str = "score",
    label: str = "y",
    by: Sequence[str] = ("split",),
    include_padding: bool = True,
) -> DataFrame:
    """Confusion counts and metrics for every threshold, from one pass over the scores.

    Each score is reduced to the number of thresholds it reaches. The table of (part, that number, label)
    counts is tiny, and every threshold is answered from it. ``unknown`` counts steps with a null label or a null or NaN
    score, as ``confusion`` does; they are in none of the four.
    """
    ordered = sorted(float(t) for t in thresholds)
    known = F.col(label).isNotNull() & _known(F.col(score))
    counts = (
        _without_padding(df, include_padding)
        .groupBy(*by, known.alias("known"), F.when(known, _reached(score, ordered)).alias("reached"), (known & (F.col(label) == 1)).alias("positive"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spread = counts.withColumn("r", F.explode(_rungs(ordered)))
    unknown = F.sum(F.when(~F.col("known"), F.col("n")).otherwise(F.lit(0))).alias("unknown")
    return binary_metrics(spread.groupBy(*by, F.col("r.threshold").alias("threshold")).agg(*_cells(F.col("n")), unknown))


def poisson_weight(key: Column, replicate: int) -> Column:
    """How often a bootstrap replicate draws a key: Poisson with mean 1, from a digest of the key and the replicate's number."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{replicate}"))), 1, 13)
    u = F.conv(digits, 16, 10).cast("double") / float(16**13)
    return reduce(lambda total, x: total + x, [(u >= F.lit(x)).cast("int") for x in poisson_steps()])


def poisson_steps() -> list[float]:
    """The distribution function of Poisson with mean 1, up to the last value below 1 in 13 hexadecimal digits."""
    steps, term, total = [], math.exp(-1), 0.0
    while True:
        total += term
        if total >= 1 - 16.0**-13:
            return steps
        steps.append(total)
        term /= len(steps)


def sweep_intervals(
    df: DataFrame,
    entity: str,
    thresholds: Sequence[float] = SWEEP_THRESHOLDS,
    score: str = "score",
    label: str = "y",
    by: Sequence[str] = ("split",),
    replicates: int = 50,
    level: float = 0.9,
    include_padding: bool = True,
) -> DataFrame:
    """Sensitivity and F1 at every threshold, with the bounds between which ``level`` of the bootstrap replicates lie.

    The steps of an entity are not independent, so a replicate draws entities: each one Poisson-distributed number of times,
    from a digest of its id, so a rerun draws the same under any partitioning. Steps are counted once, by entity and number of
    thresholds reached; all replicates are sums of these counts. Steps without a label or score are left out.
    """
    ordered = sorted(float(t) for t in thresholds)
    known = _without_padding(df, include_padding).where(F.col(label).isNotNull() & _known(F.col(score)))
    reached, positive = _reached(score, ordered).alias("reached"), (F.col(label) == 1).alias("positive")
    counts = known.groupBy(*by, F.col(entity).alias("__entity"), reached, positive).agg(F.count(F.lit(1)).alias("n"))
    drawn = [F.sum(F.col("n") * poisson_weight(F.col("__entity"), i)).alias(f"w{i}") for i in range(replicates)]
    sums = counts.groupBy(*by, "reached", "positive").agg(F.sum("n").alias("w"), *drawn)
    # A few rows from here on: parts, thresholds and replicates.
    weights = F.array(F.struct(F.lit(-1).alias("replicate"), F.col("w").alias("n")), *[F.struct(F.lit(i).alias("replicate"), F.col(f"w{i}").alias("n")) for i in range(replicates)])
    spread = sums.select(*by, "reached", "positive", F.lit(True).alias("known"), F.explode(weights).alias("drawn")).withColumn("r", F.explode(_rungs(ordered)))
    cells = spread.groupBy(*by, F.col("r.threshold").alias("threshold"), F.col("drawn.replicate").alias("replicate")).agg(*_cells(F.col("drawn.n")))
    tail = (1 - level) / 2
    found, own = [], F.col("replicate") < 0
    for metric in ("sensitivity", "f1"):
        found.append(F.max(F.when(own, F.col(metric))).alias(metric))
        for name, at in (("low", tail), ("high", 1 - tail)):
            found.append(F.percentile(F.when(~own, F.col(metric)), F.lit(at)).alias(f"{metric}_{name}"))
    return binary_metrics(cells).groupBy(*by, "threshold").agg(*found)


def entity_alarm(scores: DataFrame, entity: str, threshold: float, score: str = "score") -> DataFrame:
    """(entity, result): 1 when any step of the entity reaches the threshold, 0 when none does; null, which is written as ``[null]``
    by ``predictions_json``, when no step has a score that is a number."""
    return scores.groupBy(entity).agg(F.max(binarise(score, threshold)).alias("result"))


def predictions_json(alarms: DataFrame, entity: str, result: str = "result", with_id: bool = True) -> DataFrame:
    """One JSON object per prediction: ``{"id": ..., "result": [...]}``; ``with_id=False`` leaves the id out."""
    payload = [F.array(F.col(result)).alias("result")]
    if with_id:
        payload.insert(0, F.col(entity).alias("id"))
    return alarms.select(F.col(entity), F.to_json(F.struct(*payload)).alias("prediction"))
