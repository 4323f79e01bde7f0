"""Data drift and data quality of current batches against a reference panel."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators.skew import SEGMENT, cut_hot_groups, rows_per_group, running_totals, same_keys
from panelweave.workspace import materialise

# Defaults of the drift report.
DISTANCE_THRESHOLD = 0.1
P_VALUE_THRESHOLD = 0.05
DATASET_SHARE = 0.5
FEW_VALUES = 5
STD_FLOOR = 0.001

# Groups of a summary whose sizes are sent to every task.
GROUPS_SENT = 100_000


def _long(df: DataFrame, columns: Sequence[str], kind: str, *keep: str) -> DataFrame:
    """(keep..., column, value) for every non-null cell."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]
    )
    return (
        df.select(*keep, F.explode(cells).alias("cell"))
        .select(*keep, "cell.column", "cell.value")
        .where(F.col("value").isNotNull())
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _counted(ref: DataFrame, cur: DataFrame, columns: Sequence[str], by: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """How often each value occurs: ``r`` by (column, value) in the reference, ``c`` by (batch, column, value) in the batches.

    Both are summed in each task before the shuffle, and written, as the measures read them more than once.
    """
    of_ref = _long(ref, columns, kind).groupBy("column", "value").agg(F.count(F.lit(1)).alias("r"))
    of_cur = _long(cur, columns, kind, by).groupBy(by, "column", "value").agg(F.count(F.lit(1)).alias("c"))
    return materialise(of_ref, "reference-counts"), materialise(of_cur, "batch-counts")


def _with_size(df: DataFrame, counts: DataFrame, by: str) -> DataFrame:
    """Add ``n_cur``, the number of values by batch and column."""
    sizes = counts.groupBy(by, "column").agg(F.sum("c").alias("n_cur"))
    renamed, same = same_keys(df, sizes, [by, "column"])
    return df.join(renamed, same).select(*df.columns, "n_cur")


def _as_of(
    rows: DataFrame, known: DataFrame, at: str, carried: Sequence[str], group_rows: int | None, at_most: int, cut: bool = False
) -> DataFrame:
    """Give each row the ``carried`` columns of the last known row of its column whose ``at`` is not greater (null if none).

    Known rows go into the sort once, whatever the number of batches. With ``cut`` both sides have the segments of one sort by ``at``.
    """
    segment = [SEGMENT] if cut else []
    both = rows.withColumn("__side", F.lit(1)).unionByName(
        known.select("column", at, *carried, *segment, F.lit(0).alias("__side")), allowMissingColumns=True
    )
    ties = [c for c in rows.columns if c not in ("column", at, SEGMENT)]
    found = running_totals(
        both, ["column"], [at, "__side", *ties], {}, latest={f"at_{c}": c for c in carried},
        group_rows=group_rows, at_most=at_most, cut=both if cut else None,
    )
    return found.where("__side = 1").select(*rows.columns, *[f"at_{c}" for c in carried])


def numeric_drift(
    ref: DataFrame, cur: DataFrame, columns: Sequence[str], by: str = "batch", group_rows: int | None = None
) -> DataFrame:
    """Distances between the distributions of numeric columns, per batch and column.

    Gives (by, column, n_ref, n_cur, wasserstein, drift_score, ks, ks_p_value). Values are counted once. Between two
    values of a batch its distribution is constant and the reference's rises, so the area between them follows from the
    reference's running sums at both values and at the one place where it crosses the batch's share. These are found by
    position, so neither the reference nor the plan grows with the number of batches. Columns with too many distinct
    values for one task are walked in segments. A null batch is a batch like any other.
    """
    columns = list(columns)
    moments = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        moments += [F.stddev_pop(value).alias(f"spread_{i}"), F.avg(value).alias(f"mean_{i}")]
    one = ref.agg(F.count(F.lit(1)).alias("__n"), *moments).first()
    known = {c: (one[f"mean_{i}"], one[f"spread_{i}"]) for i, c in enumerate(columns)}
    ref_counts, cur_counts = _counted(ref, cur, columns, by, "double")
    return numeric_drift_of_counts(ref_counts, cur_counts, known, by, group_rows, one["__n"] + cur.count())


def numeric_drift_of_counts(
    ref_counts: DataFrame, cur_counts: DataFrame, known: dict[str, tuple], by: str, group_rows: int | None, at_most: int
) -> DataFrame:
    """``numeric_drift`` from counts: ``r`` by (column, value), ``c`` by (batch, column, value), which are read several times.

    ``known`` has mean and spread of each column of the reference; ``at_most`` bounds the rows of both tables."""
    # One number per compared column.
    spans = F.create_map(*[F.lit(x) for c, (_, spread) in known.items() for x in (c, max(spread or 0.0, STD_FLOOR))])
    centres = F.create_map(*[F.lit(x) for c, (mean, _) in known.items() for x in (c, mean or 0.0)])
    large = at_most > rows_per_group(ref_counts, at_most, group_rows)

    def settled(df: DataFrame, name: str) -> DataFrame:
        """Written where groups may be cut, as the cut reads its input several times."""
        return materialise(df, name) if large else df

    # One sort by value gives reference and batches the same segments, for the first three walks.
    both = ref_counts.select("column", "value", "r").unionByName(cur_counts.select(by, "column", "value", "c"), allowMissingColumns=True)
    cut = cut_hot_groups(both, ["column"], ["value"], group_rows, at_most) if large else None
    segment = [] if cut is None else [SEGMENT]
    walked_counts, placed_counts = ref_counts, cur_counts
    if cut is not None:
        walked_counts = cut.where(F.col("r").isNotNull()).select("column", "value", "r", SEGMENT)
        placed_counts = cut.where(F.col("c").isNotNull()).select(by, "column", "value", "c", SEGMENT)
    # Values are taken from the reference's mean, so that running sums of them stay small.
    from_centre = F.col("value") - centres[F.col("column")]
    moments = walked_counts.withColumn("moment", F.col("r") * from_centre)
    walked = running_totals(
        moments, ["column"], ["value"], {"upto": "r", "moment_upto": "moment"},
        group_rows=group_rows, at_most=at_most, cut=moments if segment else None,
    ).withColumn("here", F.col("value"))
    walked = settled(walked.withColumn("below", F.col("upto") - F.col("r")), "reference-sums")

    # The area under the reference's counts, left of a value.
    def area(value: Column, upto: Column, moment: Column) -> Column:
        return (value - centres[F.col("column")]) * upto - moment

    placed = _as_of(placed_counts, walked, "value", ["here", "upto", "below", "moment_upto"], group_rows, at_most, bool(segment))
    upto = F.coalesce("at_upto", F.lit(0))
    placed = settled(placed.select(
        by, "column", "value", "c", upto.alias("upto"),
        F.when(F.col("at_here") == F.col("value"), F.col("at_below")).otherwise(upto).alias("below"),
        area(F.col("value"), upto, F.coalesce("at_moment_upto", F.lit(0.0))).alias("area"), *segment,
    ), "batch-values")
    steps = running_totals(
        placed, [by, "column"], ["value"], {"c_upto": "c"},
        {"next": "value", "next_area": "area", "next_below": "below"}, group_rows=group_rows, at_most=at_most,
        cut=placed if segment else None,
    ).drop(*segment)
    # One row per compared column.
    whole = ref_counts.groupBy("column").agg(
        F.sum("r").alias("n_ref"), F.max("value").alias("top"), F.sum(F.col("r") * from_centre).alias("top_moment")
    )
    steps = _with_size(steps, cur_counts, by).join(F.broadcast(whole), "column")
    # The batch's share in counts of the reference; negative, as the crossing is the next known row upwards.
    steps = settled(steps.withColumn("level", -F.col("c_upto") * F.col("n_ref") / F.col("n_cur")), "batch-steps")
    crossings = walked.select(
        "column", (-F.col("upto")).cast("double").alias("level"), "here",
        area(F.col("value"), F.col("below"), F.col("moment_upto") - F.col("moment")).alias("area_here"),
    )
    steps = _as_of(steps, crossings, "level", ["here", "area_here"], group_rows, at_most)

    level = -F.col("level")
    beyond = F.col("next").isNull() & (F.col("top") > F.col("value"))
    end = F.when(beyond, F.col("top")).otherwise(F.coalesce("next", "value"))
    end_area = F.when(beyond, area(F.col("top"), F.col("n_ref"), F.col("top_moment"))).otherwise(F.coalesce("next_area", "area"))
    cross = F.greatest(F.least(F.coalesce("at_here", "top"), end), F.col("value"))
    cross_area = (
        F.when(cross == F.col("value"), F.col("area")).when(cross == end, end_area).otherwise(F.col("at_area_here"))
    )
    between = level * (cross - F.col("value")) - (cross_area - F.col("area")) + (end_area - cross_area) - level * (end - cross)
    first = F.col("c_upto") == F.col("c")
    apart = F.greatest(
        F.abs(F.col("upto") - level),
        F.abs(F.coalesce(F.col("next_below") - level, F.lit(0.0))),
        F.when(first, F.col("below").cast("double")).otherwise(0.0),
    )
    found = steps.groupBy(by, "column").agg(
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
        (F.sum(between + F.when(first, F.col("area")).otherwise(0.0)) / F.max("n_ref")).alias("wasserstein"),
        (F.max(apart) / F.max("n_ref")).alias("ks"),
    )
    return found.select(
        by, "column", "n_ref", "n_cur", "wasserstein", (F.col("wasserstein") / spans[F.col("column")]).alias("drift_score"),
        "ks", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")).alias("ks_p_value"),
    )


def wasserstein(ref, cur, columns, by="batch", group_rows=None) -> DataFrame:
    """(by, column, wasserstein, drift_score): the distance, and the distance over the reference spread."""
    found = numeric_drift(ref, cur, columns, by, group_rows)
    return found.select(by, "column", "wasserstein", "drift_score")


def ks_statistic(ref, cur, columns, by="batch", group_rows=None) -> DataFrame:
    """(by, column, n_ref, n_cur, ks, ks_p_value): the two-sample statistic and its asymptotic p-value."""
    found = numeric_drift(ref, cur, columns, by, group_rows)
    return found.select(by, "column", "n_ref", "n_cur", "ks", "ks_p_value")


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value by the alternating series."""
    x = statistic * F.sqrt(n.cast("double") * m / (n + m))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * x * x),
    )
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(terms, F.lit(0.0)), F.lit(1.0)))


def categorical_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str], by: str = "batch") -> DataFrame:
    """Distances between the distributions of categorical columns, per batch and column.

    Gives (by, column, n_ref, n_cur, n_values, js, chi2, z). ``chi2`` compares a batch with the reference
    scaled to the size of the batch; ``z`` compares the share of the greatest value and is null unless the
    column has two values. Values that a batch lacks enter through the reference rows that it does not meet, so only
    values that occur are joined.
    """
    return categorical_drift_of_counts(*_counted(ref, cur, columns, by, "string"), by)


def categorical_drift_of_counts(ref_counts: DataFrame, cur_counts: DataFrame, by: str = "batch") -> DataFrame:
    """``categorical_drift`` from counts: ``r`` by (column, value), ``c`` by (batch, column, value)."""
    # One row per compared column.
    whole = ref_counts.groupBy("column").agg(
        F.sum("r").alias("n_ref"), F.count(F.lit(1)).alias("ref_values"),
        F.max("value").alias("top"), F.max_by("r", "value").alias("top_r"),
    )
    met = _with_size(cur_counts.join(ref_counts, ["column", "value"], "left"), cur_counts, by).join(F.broadcast(whole), "column")
    p, q = F.coalesce("r", F.lit(0)) / F.col("n_ref"), F.col("c") / F.col("n_cur")
    middle = (p + q) / 2
    part = F.when(p > 0, p * F.ln(F.try_divide(p, middle))).otherwise(0.0) + q * F.ln(q / middle)
    expected = p * F.col("n_cur")
    off = F.when(expected > 0, F.try_divide((F.col("c") - expected) * (F.col("c") - expected), expected)).otherwise(float("inf"))
    sums = met.groupBy(by, "column").agg(
        *[F.max(c).alias(c) for c in ("n_ref", "n_cur", "ref_values", "top", "top_r")],
        F.sum(F.coalesce("r", F.lit(0))).alias("met"),
        F.count_if(F.col("r").isNull()).alias("new_values"),
        F.sum(part).alias("parts"),
        F.sum(off).alias("off"),
        F.max("value").alias("cur_top"),
        F.max_by("c", "value").alias("cur_top_c"),
        F.max_by(F.coalesce("r", F.lit(0)), "value").alias("cur_top_r"),
    )
    n, m = F.col("n_ref"), F.col("n_cur")
    unmet = (n - F.col("met")) / n
    n_values = F.col("ref_values") + F.col("new_values")
    ahead = F.col("top") > F.col("cur_top")
    top_ref = F.when(ahead, F.col("top_r")).otherwise(F.col("cur_top_r"))
    top_cur = F.when(ahead, F.lit(0)).otherwise(F.col("cur_top_c"))
    pooled = (top_ref + top_cur) / (n + m)
    error = F.sqrt(pooled * (1 - pooled) * (F.lit(1.0) / n + F.lit(1.0) / m))
    z = F.when(n_values == 2, F.try_divide(top_ref / n - top_cur / m, error))
    js = F.sqrt(F.greatest((F.col("parts") + unmet * math.log(2)) / 2, F.lit(0.0)))
    return sums.select(
        by, "column", "n_ref", "n_cur", n_values.alias("n_values"), js.alias("js"), (F.col("off") + unmet * m).alias("chi2"), z.alias("z")
    )


def js_distance(ref, cur, columns, by="batch") -> DataFrame:
    """(by, column, js): Jensen-Shannon distance, natural logarithm."""
    return categorical_drift(ref, cur, columns, by).select(by, "column", "js")


def chi2_statistic(ref, cur, columns, by="batch") -> DataFrame:
    """(by, column, n_values, chi2, p_value)."""
    found = categorical_drift(ref, cur, columns, by)
    return found.select(
        by, "column", "n_values", "chi2", chi2_p_value(F.col("chi2"), F.col("n_values") - 1).alias("p_value")
    )


def z_statistic(ref, cur, columns, by="batch") -> DataFrame:
    """(by, column, z, p_value) for columns with two values."""
    found = categorical_drift(ref, cur, columns, by).where(F.col("n_values") == 2)
    return found.select(by, "column", "z", z_p_value(F.col("z")).alias("p_value"))


def chi2_upper_tail(x: float, freedom: int) -> float:
    """Probability that a chi-squared variable exceeds ``x``: the regularised upper incomplete gamma function.

    Below the mean its lower part is summed as a series, above it the continued fraction is walked; both start from the
    logarithm of the density, so many degrees of freedom do not underflow. The steps grow with the root of ``freedom``.
    """
    if x != x or freedom < 1:
        return 1.0
    if math.isinf(x):
        return 0.0
    a, half = freedom / 2, x / 2
    if half <= 0:
        return 1.0
    front = math.exp(a * math.log(half) - half - math.lgamma(a))
    if half < a + 1:
        term = total = 1 / a
        at = a
        while term > total * 1e-16:
            at += 1
            term *= half / at
            total += term
        return min(max(1 - front * total, 0.0), 1.0)
    tiny = 1e-300
    b = half + 1 - a
    c, d = 1 / tiny, 1 / b
    fraction = d
    for i in range(1, 1_000_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        fraction *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return min(max(front * fraction, 0.0), 1.0)


def chi2_p_value(statistic: Column, freedom: Column) -> Column:
    """Runs on the aggregated result only, one value per batch and column."""

    @F.pandas_udf("double")
    def tail(x: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([chi2_upper_tail(float(a), int(b)) for a, b in zip(x, k)], dtype="float64")

    return tail(statistic, freedom)


def z_p_value(z: Column) -> Column:
    """Two-sided p-value of a standard normal statistic, on the aggregated result only."""

    @F.pandas_udf("double")
    def tail(x: pd.Series) -> pd.Series:
        return pd.Series([math.erfc(abs(v) / math.sqrt(2)) if v == v else 1.0 for v in x], dtype="float64")

    return tail(z)


def column_kinds(ref: DataFrame, columns: Sequence[str], few_values: int = FEW_VALUES) -> dict[str, str]:
    """``numeric`` or ``categorical`` per column: text and columns of at most ``few_values`` values are categorical.

    The sketch keeps the hashes themselves while they are few, so it is exact in effect for the handful of
    values that matters here.
    """
    sketch = [F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"))).alias(c) for c in columns]
    one = ref.agg(*sketch).first()
    text = {name for name, kind in ref.dtypes if kind in ("string", "boolean")}
    return {c: "categorical" if c in text or one[c] <= few_values else "numeric" for c in columns}


def drift_by_batch(
    ref: DataFrame,
    cur: DataFrame,
    kinds: dict[str, str],
    by: str = "batch",
    p_values: bool = False,
    group_rows: int | None = None,
) -> DataFrame:
    """Drift of every column in every batch: (by, column, stattest, score, threshold, drifted).

    ``kinds`` names the columns and says whether each is ``numeric`` or ``categorical``. The measures are distances
    (Wasserstein over the spread, Jensen-Shannon), or with ``p_values``, which suits references of some hundred rows, the tests of
    Kolmogorov-Smirnov and chi-squared, and z for two values. All batches are compared in one job.
    """
    numeric = [c for c, kind in kinds.items() if kind == "numeric"]
    categorical = [c for c, kind in kinds.items() if kind == "categorical"]
    parts = []
    if numeric:
        found = numeric_drift(ref, cur, numeric, by, group_rows)
        name, value = ("ks", "ks_p_value") if p_values else ("wasserstein", "drift_score")
        parts.append(found.select(by, "column", F.lit(name).alias("stattest"), F.col(value).alias("score")))
    if categorical:
        found = categorical_drift(ref, cur, categorical, by)
        if p_values:
            two = F.col("n_values") <= 2
            name = F.when(two, "z").otherwise("chi2")
            value = F.when(two, z_p_value(F.col("z"))).otherwise(chi2_p_value(F.col("chi2"), F.col("n_values") - 1))
        else:
            name, value = F.lit("jensenshannon"), F.col("js")
        parts.append(found.select(by, "column", name.alias("stattest"), value.alias("score")))
    threshold = P_VALUE_THRESHOLD if p_values else DISTANCE_THRESHOLD
    drifted = F.col("score") < threshold if p_values else F.col("score") >= threshold
    return reduce(DataFrame.unionByName, parts).select("*", F.lit(threshold).alias("threshold"), drifted.alias("drifted"))


def dataset_drift(report: DataFrame, by: str = "batch", share: float = DATASET_SHARE) -> DataFrame:
    """Number and share of drifted columns per batch, and whether the share reaches the limit."""
    part = F.count_if("drifted") / F.count(F.lit(1))
    return report.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if("drifted").alias("n_drifted"),
        part.alias("share_drifted"),
        (part >= share).alias("dataset_drift"),
    )


def drift_tests(report: DataFrame, by: str = "batch", share: float = DATASET_SHARE) -> DataFrame:
    """Pass or fail per column, and one test on the share of drifted columns: (by, test, column, value, passed)."""
    row = F.struct(
        F.lit("column_drift").alias("test"), "column", F.col("score").alias("value"),
        (~F.col("drifted")).alias("passed"),
    )
    # One pass over the report: the rows of a batch are one per column.
    batches = report.groupBy(by).agg(
        F.collect_list(row).alias("tests"), (F.count_if("drifted") / F.count(F.lit(1))).alias("part")
    )
    whole = F.struct(
        F.lit("share_of_drifted_columns").alias("test"),
        F.lit("*").alias("column"),
        F.col("part").alias("value"),
        (F.col("part") < share).alias("passed"),
    )
    return batches.select(by, F.explode(F.concat("tests", F.array(whole))).alias("t")).select(by, "t.*")


def missing_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("batch",)) -> DataFrame:
    """Per batch: rows, missing cells and their share, rows and columns with any missing cell."""
    columns = list(columns)
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(reduce(Column.__or__, [F.col(c).isNull() for c in columns])).alias("rows_with_missing"),
        *[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in enumerate(columns)],
    )
    cells = [F.col(f"__{i}") for i in range(len(columns))]
    total = reduce(Column.__add__, cells)
    return counts.select(
        *by,
        "n_rows",
        total.alias("n_missing"),
        _ratio(total, F.col("n_rows") * len(columns)).alias("share_missing"),
        "rows_with_missing",
        reduce(Column.__add__, [(c > 0).cast("bigint") for c in cells]).alias("columns_with_missing"),
    )


def missing_by_column(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("batch",)) -> DataFrame:
    """(by..., column, n_missing, share_missing)."""
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("n_missing"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(*by, "n_rows", F.explode(rows).alias("c")).select(
        *by, "c.column", "c.n_missing", _ratio(F.col("c.n_missing"), F.col("n_rows")).alias("share_missing")
    )


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def column_summary(
    df: DataFrame,
    columns: Sequence[str],
    by: str = "batch",
    exact: bool = True,
    group_rows: int | None = None,
) -> DataFrame:
    """Count, missing, mean, std, extremes, quartiles, distinct values and most common value.

    Exact quartiles interpolate between neighbouring ranks of the counted values, so no task holds a whole
    column; ``exact=False`` uses sketches and leaves out the most common value.
    """
    columns = list(columns)
    moments = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        kinds = {
            "n": F.count(value),
            "n_missing": F.count_if(F.col(c).isNull()),
            "mean": F.avg(value),
            "std": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
        }
        if not exact:
            for name, q in QUARTILES.items():
                kinds[name] = F.percentile_approx(value, F.lit(q), F.lit(10000))
            kinds["n_unique"] = F.approx_count_distinct(value)
        moments += [e.alias(f"{name}_{i}") for name, e in kinds.items()]
    fields = list(kinds)
    wide = df.groupBy(by).agg(*moments)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{f}_{i}").alias(f) for f in fields])
            for i, c in enumerate(columns)
        ]
    )
    basic = wide.select(by, F.explode(rows).alias("r")).select(by, "r.*")
    if not exact:
        return basic

    cells = _long(df, columns, "double", by)
    counts = cells.groupBy(by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    at_most = df.count()
    large = at_most > rows_per_group(df, at_most, group_rows)
    if large:
        counts = materialise(counts, "value-counts")
    walked = running_totals(counts, [by, "column"], ["value"], {"upto": "n"}, group_rows=group_rows, at_most=at_most)
    sizes = counts.groupBy(by, "column").agg(
        F.sum("n").alias("size"),
        F.count(F.lit(1)).alias("n_unique"),
        F.max_by("value", F.struct("n", -F.col("value"))).alias("most_common"),
    )
    # One row per group: few groups are sent to all tasks; many are written, so that AQE can split a large one.
    few = not large or sizes.count() <= GROUPS_SENT
    sizes = F.broadcast(sizes) if few else materialise(sizes, "group-sizes")
    placed = walked.join(sizes, [by, "column"])
    picks = []
    for name, q in QUARTILES.items():
        rank = F.lit(q) * (F.col("size") - 1)
        for end, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            here = (F.col("upto") - F.col("n") <= at) & (at < F.col("upto"))
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"{name}_{end}"))
    found = placed.groupBy(by, "column").agg(
        F.max("size").alias("size"),
        F.max("n_unique").alias("n_unique"),
        F.max("most_common").alias("most_common"),
        *picks,
    )
    quartiles = []
    for name, q in QUARTILES.items():
        rank = F.lit(q) * (F.col("size") - 1)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        quartiles.append((low + (rank - F.floor(rank)) * (high - low)).alias(name))
    return basic.join(
        found.select(by, "column", *quartiles, "n_unique", "most_common"), [by, "column"], "left"
    )


def drift_timeline(reports: DataFrame, at: str = "report_at") -> DataFrame:
    """The monitoring series: rows, drift share and missing share by report time.

    ``reports`` has one row per report with columns n_rows, share_drifted and share_missing.
    """
    return reports.select(at, "n_rows", "share_drifted", "share_missing").orderBy(at)


def drift_counters(reports: DataFrame, at: str = "report_at") -> DataFrame:
    """The monitoring counters: rows seen in all reports and the drift share of the latest one."""
    return reports.agg(
        F.sum("n_rows").alias("rows_seen"), F.max_by("share_drifted", at).alias("last_share_drifted")
    )
