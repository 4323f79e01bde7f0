import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave import PanelSpec
from panelweave.operators import evaluate, sequences
from panelweave.plans import score

SPEC = PanelSpec("id", ("t",), ("a", "b"), "y")


def panel(spark, lengths):
    rows = [(i, t, float(t), float(-t), t % 2) for i, n in lengths.items() for t in range(n)]
    return spark.createDataFrame(rows, "id long, t long, a double, b double, y int").repartition(5)


def test_packs_in_order_and_filters_short(spark):
    got = sequences.to_sequences(panel(spark, {1: 14, 2: 15}), SPEC).collect()
    assert [r.id for r in got] == [2]
    assert got[0].x == [[float(t), float(-t)] for t in range(15)]
    assert got[0].y == [t % 2 for t in range(15)]


@pytest.mark.parametrize("n", [49, 50, 51])
def test_padding_to_fifty(spark, n):
    packed = sequences.to_sequences(panel(spark, {1: n}), SPEC)
    pre = sequences.validate_shape(sequences.pad_sequences(packed, 2), 50, 2).first()
    post = sequences.pad_sequences(packed, 2, side="post").first()
    steps = [[float(t), float(-t)] for t in range(min(n, 50))]
    fill = [[0.0, 0.0]] * (50 - len(steps))
    assert pre.x == fill + steps and post.x == steps + fill
    assert len(pre.y) == len(post.y) == 50


def test_label_side_and_truncation(spark):
    packed = sequences.to_sequences(panel(spark, {1: 20}), SPEC)
    out = sequences.pad_sequences(packed, 2, 18, "post", label_side="pre", label_truncate="pre").first()
    assert out.y == [t % 2 for t in range(2, 20)]
    assert sequences.pad_sequences(packed, 2, 22, label_side="post").first().y[-2:] == [0, 0]


def test_wrong_shape_fails(spark):
    packed = sequences.to_sequences(panel(spark, {1: 20}), SPEC)
    with pytest.raises(Exception, match="shape"):
        sequences.validate_shape(packed, 50, 2).collect()


def test_flatten_marks_padding(spark):
    packed = sequences.to_sequences(panel(spark, {1: 20}), SPEC)
    for side, first in (("pre", True), ("post", False)):
        flat = sequences.flatten_steps(sequences.pad_sequences(packed, 2, 30, side), "id", 30, side)
        rows = flat.orderBy("step").collect()
        assert len(rows) == 30 and sum(r.padded for r in rows) == 10
        assert rows[0].padded is first and rows[-1].padded is not first
    names = sequences.unpack_features(flat, ["a", "b"]).columns
    assert names == ["id", "step", "padded", "y", "a", "b"]


def test_user_model_gets_dense_batches(spark):
    packed = sequences.pad_sequences(sequences.to_sequences(panel(spark, {i: 20 for i in range(7)}), SPEC), 2)

    def make():
        def predict(x):
            assert x.shape[1:] == (50, 2)
            return np.sum(x, axis=2)

        return predict

    got = score.score_with(packed, make, 50, 2, batch_size=3).select("scores").collect()
    assert len(got) == 7 and all(len(r.scores) == 50 and set(r.scores) == {0.0} for r in got)


SCORES = "id long, score double, y int, padded boolean, split string"


def scores(spark, rows):
    return spark.createDataFrame([(i, s, y, p, "train") for i, (s, y, p) in enumerate(rows)], SCORES)


def test_confusion_counts_ties_as_positive(spark):
    df = scores(spark, [(0.5, 1, False), (0.5, 0, False), (0.4, 1, False), (0.1, 0, True)])
    assert tuple(evaluate.confusion(df, 0.5).first()) == (1, 1, 1, 1, 0)
    assert tuple(evaluate.confusion(df, 0.5, include_padding=False).first()) == (0, 1, 1, 1, 0)


def test_one_class_gives_four_counts_and_zero_metrics(spark):
    df = scores(spark, [(0.1, 0, False), (0.2, 0, False)])
    row = evaluate.binary_metrics(evaluate.confusion(df, 0.5)).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (2, 0, 0, 0)
    assert (row.sensitivity, row.precision, row.f1) == (0.0, 0.0, 0.0)


def test_epsilon_lowers_f1(spark):
    counts = evaluate.confusion(scores(spark, [(0.9, 1, False), (0.9, 0, False)]), 0.5)
    plain, shifted = (evaluate.binary_metrics(counts, e).first().f1 for e in (0.0, 1e-7))
    assert plain == pytest.approx(2 / 3) and 0 < plain - shifted < 1e-6


def test_sweep_equals_separate_evaluations(spark):
    rng = np.random.default_rng(3)
    df = scores(spark, [(float(s), int(y), False) for s, y in zip(rng.random(300) ** 4, rng.integers(0, 2, 300))])
    swept = {r.threshold: (r.tn, r.fp, r.fn, r.tp) for r in evaluate.threshold_sweep(df).collect()}
    assert len(swept) == 9
    for t, counts in swept.items():
        assert tuple(evaluate.confusion(df, t).first())[:4] == counts


def test_alarm_and_json(spark):
    df = spark.createDataFrame([(1, 0.04), (1, 0.05), (2, 0.01)], "id long, score double")
    alarms = evaluate.entity_alarm(df, "id", 0.05)
    assert {tuple(r) for r in alarms.collect()} == {(1, 1), (2, 0)}
    texts = {r.prediction for r in evaluate.predictions_json(alarms, "id").collect()}
    assert texts == {'{"id":1,"result":[1]}', '{"id":2,"result":[0]}'}
    bare = {r.prediction for r in evaluate.predictions_json(alarms, "id", with_id=False).collect()}
    assert bare == {'{"result":[1]}', '{"result":[0]}'}


def test_join_scores_by_key(spark):
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (2, 0, 1)], "id long, step int, y int")
    found = labels.select("id", "step", (F.col("id") + F.col("step") / 10).alias("score"))
    got = evaluate.join_scores(labels, found.orderBy(F.desc("score")), ["id", "step"]).collect()
    assert {(r.id, r.step, r.y, round(r.score, 1)) for r in got} == {(1, 0, 1, 1.0), (1, 1, 0, 1.1), (2, 0, 1, 2.0)}


def test_confusion_shows_what_it_cannot_count(spark):
    df = scores(spark, [(0.9, 1, False), (None, 1, False), (0.9, None, False), (float("nan"), 0, False)])
    assert tuple(evaluate.confusion(df, 0.5).first()) == (0, 0, 0, 1, 3)


GAPS = [(1, 0.9, 1), (1, float("nan"), 0), (2, None, 1), (3, 0.05, None), (3, 0.05, 0), (4, float("nan"), 1), (4, None, 0)]


def test_null_and_nan_scores_are_no_hits(spark):
    df = spark.createDataFrame([(*r, "all") for r in GAPS], "id long, score double, y int, split string")
    names = ("tn", "fp", "fn", "tp", "unknown")
    counted = evaluate.confusion(df, 0.1, by=["split"]).select(*names).first()
    swept = evaluate.threshold_sweep(df, (0.1, 0.5)).where("threshold = 0.1").select(*names).first()
    assert tuple(counted) == tuple(swept) == (1, 0, 0, 1, 5)
    alarms = {r["id"]: r["result"] for r in evaluate.entity_alarm(df, "id", 0.1).collect()}
    assert alarms == {1: 1, 2: None, 3: 0, 4: None}
    written = {r["id"]: r["prediction"] for r in evaluate.predictions_json(evaluate.entity_alarm(df, "id", 0.1), "id").collect()}
    assert written[4] == '{"id":4,"result":[null]}'


def test_intervals_hold_the_value_and_do_not_depend_on_partitions(spark):
    df = spark.range(4000).selectExpr(
        "id % 200 as id", "'all' as split", "(id * 7919 % 1000) / 1000.0d as score", "cast((id * 7919 % 1000) / 1000.0 + (id * 31 % 100) / 200.0 > 0.9 as int) as y"
    )
    one = evaluate.sweep_intervals(df, "id", (0.3, 0.6), replicates=40).orderBy("threshold").collect()
    two = evaluate.sweep_intervals(df.repartition(7), "id", (0.3, 0.6), replicates=40).orderBy("threshold").collect()
    assert one == two
    point = evaluate.threshold_sweep(df, (0.3, 0.6)).orderBy("threshold").collect()
    for r, p in zip(one, point):
        assert r["sensitivity"] == p["sensitivity"] and r["f1"] == p["f1"]
        assert r["f1_low"] < r["f1"] < r["f1_high"] and r["f1_high"] - r["f1_low"] < 0.2


def test_poisson_weights(spark):
    drawn = spark.range(20000).select(evaluate.poisson_weight(F.col("id"), 3).alias("w"))
    mean, spread = drawn.agg(F.avg("w"), F.var_samp("w")).first()
    assert abs(mean - 1) < 0.05 and abs(spread - 1) < 0.08
