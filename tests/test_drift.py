import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.operators import drift


def sample(spark, values, batch=None):
    rows = [(float(v), batch) for v in values]
    return spark.createDataFrame(rows, "v double, batch long")


def distance(a, b):
    """Area between the two empirical distributions."""
    points = np.sort(np.concatenate([a, b]))
    gaps = np.diff(points)
    below = lambda s: np.searchsorted(np.sort(s), points[:-1], side="right") / len(s)
    return float(np.sum(np.abs(below(a) - below(b)) * gaps))


@pytest.mark.parametrize("group_rows", [None, 60])
def test_wasserstein_and_ks_against_numpy(spark, group_rows):
    rng = np.random.default_rng(5)
    a, b, c = rng.normal(0, 2, 400).round(2), rng.normal(1, 1, 150).round(2), rng.exponential(3, 90).round(2)
    cur = sample(spark, b, 0).unionByName(sample(spark, c, 1))
    found = drift.numeric_drift(sample(spark, a), cur, ["v"], group_rows=group_rows).collect()
    got = {r.batch: r for r in found}
    for batch, other in ((0, b), (1, c)):
        assert got[batch].wasserstein == pytest.approx(distance(a, other))
        assert got[batch].drift_score == pytest.approx(distance(a, other) / np.std(a))
        points = np.concatenate([a, other])
        ks = np.max(np.abs(
            (a[None, :] <= points[:, None]).mean(1) - (other[None, :] <= points[:, None]).mean(1)
        ))
        assert got[batch].ks == pytest.approx(ks)
        assert (got[batch].n_ref, got[batch].n_cur) == (400, len(other))


def test_same_and_shifted_samples(spark):
    a = np.arange(50.0)
    cur = sample(spark, a, 0).unionByName(sample(spark, a + 1, 1))
    got = {r.batch: r for r in drift.numeric_drift(sample(spark, a), cur, ["v"]).collect()}
    assert got[0].wasserstein == 0 and got[0].ks == 0 and got[0].ks_p_value == 1
    assert got[1].wasserstein == pytest.approx(1.0)


def test_constant_reference_uses_the_floor(spark):
    row = drift.wasserstein(sample(spark, [2.0] * 9), sample(spark, [3.0] * 4, 0), ["v"]).first()
    assert row.drift_score == pytest.approx(1.0 / 0.001)


def cats(spark, counts, batch=None):
    rows = [(k, batch) for k, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "c string, batch long")


def test_categorical_measures_by_hand(spark):
    ref, cur = cats(spark, {"a": 60, "b": 40}), cats(spark, {"a": 10, "b": 40}, 0)
    row = drift.categorical_drift(ref, cur, ["c"]).first()
    p, q = (0.6, 0.4), (0.2, 0.8)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    js = math.sqrt(sum(x * math.log(x / z) + y * math.log(y / z) for x, y, z in zip(p, q, m)) / 2)
    assert row.js == pytest.approx(js)
    assert row.chi2 == pytest.approx((10 - 30) ** 2 / 30 + (40 - 20) ** 2 / 20)
    pooled = 80 / 150
    assert row.z == pytest.approx((0.4 - 0.8) / math.sqrt(pooled * (1 - pooled) * (1 / 100 + 1 / 50)))
    assert drift.z_statistic(ref, cur, ["c"]).first().p_value < 1e-5
    assert drift.chi2_statistic(ref, cur, ["c"]).first().p_value < 1e-5


def test_value_unknown_to_the_reference(spark):
    row = drift.categorical_drift(cats(spark, {"a": 5, "b": 5}), cats(spark, {"a": 4, "x": 1}, 0), ["c"]).first()
    assert math.isinf(row.chi2) and row.n_values == 3 and row.z is None


@pytest.mark.parametrize("x, k, p", [
    (3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (11.070498, 5, 0.05),
    (18.307038, 10, 0.05), (24.995790, 15, 0.05), (6.634897, 1, 0.01), (0.0, 4, 1.0),
])
def test_chi2_tail(x, k, p):
    assert drift.chi2_upper_tail(x, k) == pytest.approx(p, abs=1e-6)


def test_ks_p_value_of_a_known_point(spark):
    # The asymptotic distribution reaches 0.95 at 1.3581.
    one = spark.range(1).select(drift.ks_p_value(F.lit(1.3581), F.lit(2.0), F.lit(2.0)).alias("p"))
    assert one.first().p == pytest.approx(0.05, abs=1e-4)


def test_kinds(spark):
    df = spark.range(500).select(
        F.col("id").cast("double").alias("many"), (F.col("id") % 5).alias("few"), (F.col("id") % 6).alias("six"),
        F.lit("x").alias("text"),
    )
    kinds = drift.column_kinds(df, ["many", "few", "six", "text"])
    assert kinds == {"many": "numeric", "few": "categorical", "six": "numeric", "text": "categorical"}


def test_report_by_distances_and_by_p_values(spark):
    rng = np.random.default_rng(2)
    ref = sample(spark, rng.normal(size=300)).withColumn("c", (F.col("v") > 0).cast("int"))
    cur = sample(spark, rng.normal(3, 1, 100), 0).withColumn("c", (F.col("v") > 0).cast("int"))
    kinds = {"v": "numeric", "c": "categorical"}
    small = {r.column: r for r in drift.drift_by_batch(ref, cur, kinds, p_values=True).collect()}
    assert (small["v"].stattest, small["c"].stattest) == ("ks", "z")
    assert small["v"].drifted and small["v"].score < 0.05
    large = drift.drift_by_batch(ref, cur, kinds)
    assert {r.column: r.stattest for r in large.collect()} == {"v": "wasserstein", "c": "jensenshannon"}
    row = drift.dataset_drift(large).first()
    assert (row.n_columns, row.n_drifted, row.share_drifted, row.dataset_drift) == (2, 2, 1.0, True)
    tests = {(r.test, r.column): r.passed for r in drift.drift_tests(large).collect()}
    assert tests[("share_of_drifted_columns", "*")] is False and len(tests) == 3


@pytest.mark.parametrize("group_rows", [None, 40])
def test_many_batches_against_numpy(spark, group_rows):
    """Batches below, above, around and inside the reference, of one value and of many; ties at their ends."""
    rng = np.random.default_rng(9)
    a = rng.integers(-20, 20, 120) / 4
    batches = [rng.integers(low, low + wide, n) / 4 for n in (1, 2, 7, 30) for low in (-60, -20, -5, 0, 19, 50) for wide in (1, 8, 90)]
    cur = spark.createDataFrame([(float(v), i) for i, b in enumerate(batches) for v in b], "v double, batch long")
    found = {r.batch: r for r in drift.numeric_drift(sample(spark, a), cur, ["v"], group_rows=group_rows).collect()}
    assert len(found) == len(batches)
    for i, b in enumerate(batches):
        assert found[i].wasserstein == pytest.approx(distance(a, b), abs=1e-9)
        points = np.concatenate([a, b])
        ks = np.max(np.abs((a[None, :] <= points[:, None]).mean(1) - (b[None, :] <= points[:, None]).mean(1)))
        assert found[i].ks == pytest.approx(ks, abs=1e-12)


def test_plan_does_not_grow_with_batches(spark):
    ref = sample(spark, range(50))

    def plan(batches):
        cur = ref.select("v", (F.col("v") % batches).cast("long").alias("batch"))
        report = drift.drift_by_batch(ref, cur, {"v": "numeric"})
        return report._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert plan(2) == plan(40)


def test_null_batch_and_empty_columns(spark):
    ref = sample(spark, range(10)).withColumn("e", F.lit(None).cast("double"))
    cur = sample(spark, range(5), None).withColumn("e", F.lit(1.0))
    row = drift.numeric_drift(ref, cur, ["v", "e"]).collect()
    assert [(r.batch, r.column, r.n_cur) for r in row] == [(None, "v", 5)]
    row = drift.categorical_drift(ref, cur, ["v", "e"]).collect()
    assert [(r.batch, r.column, r.n_values) for r in row] == [(None, "v", 10)]


def test_summary_exact_and_sketched(spark):
    values = [1.0, 2.0, 2.0, 3.0, 10.0]
    df = sample(spark, values, 0).unionByName(spark.createDataFrame([(None, 0)], "v double, batch long"))
    for group_rows in (None, 2):
        row = drift.column_summary(df, ["v"], group_rows=group_rows).first()
        assert (row.n, row.n_missing, row.n_unique, row.most_common) == (5, 1, 4, 2.0)
        assert [row.p25, row.p50, row.p75] == [float(q) for q in np.percentile(values, [25, 50, 75])]
        assert row["std"] == pytest.approx(np.std(values, ddof=1))
    assert drift.column_summary(df, ["v"], exact=False).first().p50 == 2.0


def test_missing_values(spark):
    df = spark.createDataFrame([(0, 1.0, None), (0, None, None), (0, 1.0, 1.0)], "batch long, a double, b double")
    row = drift.missing_values(df, ["a", "b"]).first()
    assert (row.n_rows, row.n_missing, row.rows_with_missing, row.columns_with_missing) == (3, 3, 2, 2)
    assert row.share_missing == pytest.approx(0.5)
    by_column = {r.column: r.n_missing for r in drift.missing_by_column(df, ["a", "b"]).collect()}
    assert by_column == {"a": 1, "b": 2}


def test_timeline_and_counters(spark):
    reports = spark.createDataFrame(
        [("2024-01-02", 100, 0.5, 0.1), ("2024-01-01", 50, 0.25, 0.2)],
        "report_at string, n_rows long, share_drifted double, share_missing double",
    )
    assert [r.report_at for r in drift.drift_timeline(reports).collect()] == ["2024-01-01", "2024-01-02"]
    assert tuple(drift.drift_counters(reports).first()) == (150, 0.5)


def test_chi2_tail_with_many_degrees_of_freedom():
    assert drift.chi2_upper_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert drift.chi2_upper_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    for freedom in (1480, 1500, 100_000):
        # The normal value after the cube root transform.
        assert drift.chi2_upper_tail(freedom, freedom) == pytest.approx(0.5 - 1 / (3 * (3.141592653589793 * freedom) ** 0.5), abs=1e-4)
        far = freedom + 4 * (2 * freedom) ** 0.5
        assert 0 < drift.chi2_upper_tail(far, freedom) < 1e-3
