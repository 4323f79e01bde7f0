import json
import os
import random

from pyspark.sql import functions as F

from panelweave.operators import stats
from panelweave.plans import batch, learn, score
from panelweave.sources import files
from panelweave.sources.schema import HOURLY_SCHEMA


def write_entities(folder, ids, hours, seed):
    os.makedirs(folder)
    rng = random.Random(seed)
    names = HOURLY_SCHEMA.fieldNames()
    for i, n in zip(ids, hours):
        with open(os.path.join(folder, f"p{i:06d}.psv"), "w") as f:
            f.write("|".join(names) + "\n")
            for t in range(1, n + 1):
                row = {c: f"{rng.uniform(1, 99):.2f}" if rng.random() < 0.3 else "NaN" for c in names}
                row.update(Age="61.5", Gender=str(i % 2), Unit1="NaN", Unit2="NaN", HospAdmTime="-0.5",
                           ICULOS=str(t), SepsisLabel=str(int(t > n - 3)), TroponinI="NaN")
                f.write("|".join(row[c] for c in names) + "\n")


def test_from_files_to_sequences_and_alarms(spark, tmp_path):
    write_entities(tmp_path / "a", range(1, 9), [19, 20, 25, 55, 56, 60, 6, 5], 1)
    write_entities(tmp_path / "b", range(100001, 100004), [30, 70, 12], 2)
    train = batch.load_hourly(spark, str(tmp_path / "a"))
    test = batch.load_hourly(spark, str(tmp_path / "b"), entities=2)
    assert test.select("id").distinct().count() == 2
    stats_path = str(tmp_path / "stats")
    prepared, spec = batch.prepare_hourly(train, test, stats_path)
    assert len(spec.features) == 39
    fresh, _ = batch.prepare_hourly(train, test)
    assert prepared.count() == fresh.count() == 14 + 15 + 20 + 50 + 50 + 50 + 1 + 25 + 50
    assert prepared.exceptAll(fresh).count() == 0
    bounds = prepared.where("split = 'train'").agg(
        F.min(F.least(*spec.features)), F.max(F.greatest(*spec.features))
    )
    assert tuple(bounds.first()) == (0.0, 1.0)
    assert prepared.where("TroponinI <> 0").count() == 0

    padded = batch.padded_sequences(prepared, spec).collect()
    assert {r.id for r in padded} == {2, 3, 4, 5, 6, 100001, 100002}
    assert all(len(r.x) == 50 and all(len(v) == 39 for v in r.x) and len(r.y) == 50 for r in padded)

    saved = files.load_stats(spark, stats_path)
    panel = batch.one_hot(test.drop("Unit1", "Unit2"), "Gender", [0, 1])
    weights = [0.1] * 39
    found = batch.predict_alarms(panel, spec, saved, score.linear_step_score(weights, -1.0), 0.05)
    rows = {r.id: json.loads(r.prediction) for r in found.collect()}
    assert rows == {i: {"id": i, "result": [1]} for i in (100001, 100002)}
    by_rows = batch.predict_alarms(
        panel, spec, stats.stats_values(saved),
        lambda df: df.withColumn("score", score.linear_score(spec.features, weights, -1.0)), 2.0,
    )
    assert {json.loads(r.prediction)["result"][0] for r in by_rows.collect()} == {0}
    own = batch.predict_alarms(panel, spec, None, score.linear_step_score(weights, -1.0), 0.05)
    assert own.count() == 2

    few = spec.with_features("HR", "Temp", "ICULOS").bounded(50)
    runs, models = str(tmp_path / "runs"), str(tmp_path / "models")
    model, metrics = batch.train_and_evaluate(prepared, few, 0.3, "logreg", 3, runs, models, maxIter=5)
    found = {r["split"]: r for r in metrics.collect()}
    assert set(found) == {"train", "test"}
    assert sum(found["train"][c] for c in ("tn", "fp", "fn", "tp")) == prepared.where("split = 'train'").count()
    run = learn.read_runs(spark, runs).first()
    assert run.params["algo"] == "logreg" and run.metrics["test_f1"] == found["test"].f1
    latest = learn.load_latest_model(spark, models)
    alarms = batch.predict_alarms(panel, spec, saved, lambda df: batch.score_steps(df, few, latest, 3), 0.3)
    direct = batch.score_steps(prepared.where("split = 'test'"), few, model, 3).groupBy("id").agg(F.max("score").alias("s"))
    expected = {r.id: int(r.s >= 0.3) for r in direct.collect()}
    assert {r.id: json.loads(r.prediction)["result"][0] for r in alarms.collect()} == expected
