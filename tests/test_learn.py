import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelweave import PanelSpec
from panelweave.operators.split import hash_split
from panelweave.plans import learn

SPEC = PanelSpec("id", ("t",), ("a", "b"), "y")


@pytest.fixture(scope="module")
def panel(spark):
    """A planted signal: the label follows the change of ``a``; ``b`` is noise."""
    rows = spark.range(3000).select(
        (F.col("id") % 60).alias("id"), F.floor(F.col("id") / 60).alias("t"),
        F.rand(3).alias("a"), F.rand(4).alias("b"),
    )
    made = learn.causal_features(rows, SPEC.with_features("a"), rows=2).withColumn(
        "y", F.coalesce((F.col("a_delta") > 0.2).cast("int"), F.lit(0))
    )
    return made.drop("a_delta", "a_avg2", "a_min2", "a_max2").cache()


def auc(df):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y").evaluate(df)


@pytest.mark.parametrize("algo, params", [("gbt", {"maxIter": 5}), ("logreg", {})])
def test_classifier_finds_the_signal(panel, algo, params):
    wide = hash_split(learn.causal_features(panel, SPEC), "id", {"train": 70, "test": 30})
    model = learn.train_step_classifier(
        wide.where("split = 'train'"), learn.causal_feature_names(SPEC), "y", algo, **params
    )
    assert auc(learn.score(wide.where("split = 'test'"), model)) > 0.9


def test_unknown_classifier(panel):
    with pytest.raises(ValueError):
        learn.train_step_classifier(panel, ["a"], "y", "svm")


def test_importance_ranks_and_selects(panel):
    noisy = panel.withColumn("zero", F.lit(0.0))
    spec = SPEC.with_features("a", "b", "zero")
    found = learn.feature_importance(noisy, spec, trees=10).collect()
    assert found[0].feature == "a" and found[-1].importance == 0.0
    (train, other), kept = learn.select_features(noisy, [noisy], spec, trees=10)
    assert "zero" not in train.columns and "zero" not in other.columns and "zero" not in kept.features


def test_causal_features_see_the_past_only(panel):
    whole = {(r.id, r.t): r for r in learn.causal_features(panel, SPEC).collect()}
    early = learn.causal_features(panel.where("t < 10"), SPEC).collect()
    assert all(whole[(r.id, r.t)] == r for r in early)
    first = whole[(0, 0)]
    assert first.a_delta is None and first.a_avg6 == first.a_min6 == first.a_max6 == first.a


@pytest.mark.parametrize("group_rows", [6, 9, 40])
def test_causal_features_in_blocks(panel, group_rows):
    plain = learn.causal_features(panel, SPEC)
    blocks = learn.causal_features(panel, SPEC, group_rows=group_rows)
    assert blocks.columns == plain.columns
    rounded = [
        df.select("id", "t", *[F.round(c, 9).alias(c) for c in df.columns if c not in ("id", "t")])
        for df in (plain, blocks)
    ]
    assert rounded[0].exceptAll(rounded[1]).count() == 0 and blocks.count() == plain.count()


def test_model_versions(spark, panel, tmp_path):
    base = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        learn.latest_model_version(spark, base)
    old = learn.train_step_classifier(panel, ["b"], "y", "logreg", maxIter=1)
    new = learn.train_step_classifier(panel, ["a"], "y", "logreg")
    learn.save_model_version(spark, new, base, datetime(2024, 5, 1, 12, 30, 5))
    path = learn.save_model_version(spark, old, base, datetime(2023, 5, 1))
    assert path.endswith("version_20230501000000")
    loaded = learn.load_latest_model(spark, base)
    same = learn.score(panel, new).exceptAll(learn.score(panel, loaded)).count()
    assert same == 0


def test_scoring_keeps_nulls(spark):
    rows = [(i, float(i % 5), None if i % 4 == 0 else 1.0 * i, None if i % 3 == 0 else i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, other double, y int")
    model = learn.train_step_classifier(df.where("y is not null"), ["a"], "y", algo="logreg")
    scored = learn.score(df, model)
    assert scored.columns == [*df.columns, "score"]
    assert scored.drop("score").exceptAll(df).count() == 0 and scored.where("score is null").count() == 0


def test_versions_appear_whole(spark, panel, tmp_path):
    base = str(tmp_path / "models")
    at = datetime(2024, 5, 1)
    model = learn.train_step_classifier(panel, ["a"], "y", "logreg", maxIter=1)
    first, second = (learn.save_model_version(spark, model, base, at) for _ in range(2))
    assert first != second and learn.latest_model_version(spark, base) == second
    told = json.loads((tmp_path / "models" / second.rpartition("/")[2] / "_manifest.json").read_text())
    assert told and all(n > 0 and len(digest) == 64 for n, digest in told.values())
    # A writer that ended early, in the old way and in the new one, and a file that is not what was written.
    spark.read.text(f"{first}/metadata").write.text(f"{base}/version_20250101000000/metadata")
    damaged = learn.save_model_version(spark, model, base, datetime(2026, 1, 1))
    part = next((tmp_path / "models" / damaged.rpartition("/")[2] / "metadata").glob("part-*"))
    part.write_text(part.read_text() + " ")
    assert learn.latest_model_version(spark, base) == second
    # As versions were saved before.
    model.write().save(f"{base}/version_20270101000000")
    assert learn.latest_model_version(spark, base).endswith("version_20270101000000")


def test_no_rows_to_learn_from(panel):
    none = panel.limit(0)
    for fit in (lambda: learn.feature_importance(none, SPEC), lambda: learn.train_step_classifier(none, ["a"], "y")):
        with pytest.raises(ValueError, match="no row to learn from"):
            fit()


def test_values_are_exchanged_within_parts(spark):
    df = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'a', 'b') as split", "if(id % 7 = 0, null, id) as v", "1 as w")
    for cell_rows in (20, 10_000):
        got = learn.exchanged(df, ["id"], ["v", "w"], "split", cell_rows).cache()
        for part in ("a", "b"):
            own = got.where(F.col("split") == part)
            assert own.select("v").exceptAll(own.select(F.col("v__other"))).count() == 0
        assert got.where("w <> w__other").count() == 0
        assert got.where("v <=> v__other").count() < 60
        again = learn.exchanged(df.repartition(5), ["id"], ["v", "w"], "split", cell_rows)
        assert got.exceptAll(again).count() == 0


def test_permutation_importance(panel):
    rows = panel.withColumn("split", F.when(F.col("id") % 2 == 0, "even")).withColumn("c", F.lit(2.0))
    model = learn.train_step_classifier(rows, ["a", "b", "c"], "y", "logreg", maxIter=10)
    found = [sorted(map(tuple, learn.permutation_importance(r, model, ["id", "t"], "y", cell_rows=100).collect()), key=str) for r in (rows, rows.repartition(9))]
    assert [r[:2] for r in found[0]] == [r[:2] for r in found[1]]
    assert all(abs(a[3] - b[3]) < 1e-9 for a, b in zip(*found))
    for part in (None, "even"):
        by = {r[1]: r[3] for r in found[0] if r[0] == part}
        assert by["c"] == 0 and by["a"] > 0.02 > abs(by["b"])
