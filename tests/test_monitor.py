import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.operators import drift, monitor, stats, summaries

KINDS = {"a": "numeric", "b": "numeric", "s": "categorical"}
SCHEMA = "batch long, a double, b double, s string"


def rows_of(n=400, seed=0, shift=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a = None if i % 11 == 0 else float(round(rng.normal(shift * (i % 4)), 1))
        rows.append((i % 4, a, float(rng.integers(0, 5)), None if i % 7 == 0 else "xyz"[int(rng.integers(0, 3))]))
    return rows


@pytest.fixture(scope="module")
def ref(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).cache()


@pytest.fixture(scope="module")
def cur(spark):
    return spark.createDataFrame(rows_of(seed=1, shift=0.5), SCHEMA).cache()


def report(df):
    return sorted((r["batch"], r["column"], r["stattest"], round(r["score"], 9), r["drifted"]) for r in df.collect())


def test_stored_counts_give_the_report_of_all_rows(spark, tmp_path, ref, cur):
    known, store = (monitor.CountStore(spark, str(tmp_path / n), KINDS) for n in ("ref", "cur"))
    assert known.add(ref, 0)
    for i in (0, 1, 2):
        assert store.add(cur.where(F.col("batch") == i), i)
    assert report(store.drift(known)) == report(drift.drift_by_batch(ref, cur.where("batch < 3"), KINDS))
    before = sorted((tmp_path / "cur" / "counts").rglob("*.parquet"))
    # A new batch reads its own rows only, and one that comes again changes nothing.
    assert store.add(cur.where("batch = 3"), 3) and not store.add(cur.where("batch = 2"), 2)
    after = sorted((tmp_path / "cur" / "counts").rglob("*.parquet"))
    assert [f for f in after if "batch-3" not in str(f)] == before
    assert report(store.drift(known)) == report(drift.drift_by_batch(ref, cur, KINDS))
    names = ["batch", "n_rows", "n_missing", "rows_with_missing", "columns_with_missing"]
    want = drift.missing_values(cur, list(KINDS)).select(*names)
    assert sorted(store.missing().select(*names).collect()) == sorted(want.collect())


def test_a_batch_counts_once_it_is_named(spark, tmp_path, cur):
    store = monitor.CountStore(spark, str(tmp_path), KINDS)
    store.add(cur, 0)
    # A batch whose writer ended before it was named.
    store.counts().write.parquet(f"{tmp_path}/counts/batch-1")
    assert store.batches() == [0] and store.counts().where("batch = 1").count() == 0
    assert store.add(cur, 1) and store.counts().where("batch = 1").agg(F.sum("n")).first()[0] > 0


def test_a_stream_is_counted_batch_by_batch(spark, tmp_path, cur):
    store = monitor.CountStore(spark, str(tmp_path / "store"), KINDS)
    folder = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    for i in (0, 1):
        cur.where(F.col("batch") == i).coalesce(1).write.mode("append").parquet(folder)
        store.start(stream).awaitTermination()
    store.start(stream).awaitTermination()
    found = {r["batch"]: r["n_rows"] for r in store.missing().collect()}
    assert found == {0: 100, 1: 100}


def test_an_empty_store(spark, tmp_path, ref):
    known, store = (monitor.CountStore(spark, str(tmp_path / n), KINDS) for n in ("ref", "cur"))
    known.add(ref, 0)
    assert store.drift(known).count() == 0
    store.add(ref.limit(0), 0)
    assert store.drift(known).count() == 0


def numbers(df, *by):
    return {tuple(r[c] for c in (*by, "column")): [r[c] for c in ("n", "nulls", "mean", "m2", "low", "high")] for r in df.collect()}


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_merged_summaries_equal_one_fit(spark, cur, parts):
    far = cur.withColumn("a", F.col("a") + 1e6)
    whole = numbers(summaries.summarise(far, ["a", "b"], ["batch"]), "batch")
    split = far.withColumn("part", F.abs(F.hash("a", "b")) % parts)
    made = summaries.summarise(split, ["a", "b"], ["batch", "part"])
    for order in (F.col("part"), -F.col("part")):
        merged = numbers(summaries.merge(made.orderBy(order).coalesce(1), ["batch"]), "batch")
        assert merged.keys() == whole.keys()
        for key, values in whole.items():
            assert merged[key] == pytest.approx(values, rel=1e-9)


def test_merged_statistics_impute_and_scale(spark, ref):
    merged = summaries.merge(summaries.summarise(ref, ["a", "b"], ["batch"]))
    got, want = summaries.as_stats(merged, ["a", "b"]).first(), stats.fit_stats(ref, ["a", "b"]).first()
    assert got.asDict() == pytest.approx(want.asDict(), rel=1e-9)


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([(None, None), (None, float("nan"))], "g string, a double")
    found = summaries.merge(summaries.summarise(df, ["a"], ["g"], 200), ["g"]).collect()
    assert [(r["g"], r["n"], r["nulls"], r["mean"], r["low"], r["sketch"]) for r in found] == [(None, 0, 2, None, None, None)]


@pytest.mark.parametrize("shift", [0.0, 1.0])
def test_sketched_distances_are_within_their_error(spark, shift):
    rng = np.random.default_rng(3)
    make = lambda n, s: spark.createDataFrame([(i % 2, float(x)) for i, x in enumerate(rng.normal(s, 1, n))], "batch long, a double")
    ref, cur = make(20000, 0), make(20000, shift)
    k = 800
    left = summaries.merge(summaries.summarise(ref, ["a"], ["batch"], k))
    right = summaries.summarise(cur, ["a"], ["batch"], k)
    near = {r["batch"]: r for r in summaries.sketch_drift(left, right, k).collect()}
    for r in drift.numeric_drift(ref, cur, ["a"]).collect():
        found = near[r["batch"]]
        assert abs(found["ks"] - r["ks"]) <= found["ks_error"] < 0.03
        assert abs(found["wasserstein"] - r["wasserstein"]) <= found["wasserstein_error"]
        # The bound is of the worst case; as a rule it is far nearer.
        assert abs(found["wasserstein"] - r["wasserstein"]) < 0.05


def test_sketches_sort_no_values(spark, ref, cur):
    made = summaries.sketch_drift(summaries.merge(summaries.summarise(ref, ["a"], ["batch"], 200)), summaries.summarise(cur, ["a"], ["batch"], 200), 200)
    plan = made._jdf.queryExecution().executedPlan().toString()
    below = [line for line in plan.splitlines() if "Sort " in line or "Sort[" in line]
    assert all("column" in line or "batch" in line for line in below) and "Exchange" in plan
    assert not any(" a#" in line for line in plan.splitlines() if "Exchange" in line)
