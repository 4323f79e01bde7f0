import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.plans import recurrent

SCHEMA = "id long, x array<array<double>>, y array<int>"


@pytest.mark.parametrize("truncate", [50, 9])
def test_gradient_is_the_numeric_one(truncate):
    """With a truncation no shorter than the sequence; a shorter one still has the exact gradient of the last steps' output."""
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(5, 9, 2)), rng.integers(0, 2, (5, 9)).astype(float)
    known = rng.random((5, 9)) < 0.8
    model = recurrent.start(2, 3, seed=1)
    loss, n, slope = recurrent.gradient(model, x, y, known, truncate)
    assert n == known.sum()
    for i in range(model.flat().size):
        step = np.zeros(model.flat().size)
        step[i] = 1e-5
        up, down = (recurrent.gradient(model.with_flat(model.flat() + s), x, y, known, truncate)[0] for s in (step, -step))
        assert abs((up - down) / 2e-5 - slope[i]) < 1e-6


def test_truncation_carries_the_state():
    rng = np.random.default_rng(1)
    x, y, known = rng.normal(size=(4, 20, 2)), rng.integers(0, 2, (4, 20)).astype(float), np.ones((4, 20), bool)
    model = recurrent.start(2, 3)
    whole, parts = (recurrent.gradient(model, x, y, known, t) for t in (20, 6))
    assert whole[0] == pytest.approx(parts[0], rel=1e-12)
    assert not np.allclose(whole[2], parts[2])


def planted(n=200, steps=30, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        mark = (rng.random(steps) < 1 / 30).astype(float)
        x = [[float(a), float(b)] for a, b in zip(mark, rng.random(steps))]
        rows.append((i, x, [int(mark[: max(t - 6, 0)].any()) for t in range(steps)]))
    return rows


def test_likelihood_rises_and_partitions_do_not_matter(spark, tmp_path):
    packed = spark.createDataFrame(planted(), SCHEMA)
    model = recurrent.fit(packed.repartition(3), 2, epochs=8)
    assert len(model.losses) > 4 and all(b < a for a, b in zip(model.losses, model.losses[1:]))
    again = recurrent.fit(packed.repartition(7), 2, epochs=8)
    assert np.allclose(model.flat(), again.flat(), atol=1e-6)
    recurrent.save(spark, model, str(tmp_path / "model"))
    back = recurrent.load(spark, str(tmp_path / "model"))
    assert (back.flat() == model.flat()).all() and back.losses == model.losses


def test_scores_of_odd_sequences(spark):
    model = recurrent.start(2, 3)
    rows = [(1, [[1.0, None], [float("nan"), 2.0]], [0, None]), (2, [], []), (3, None, None), (4, [[1.0, 0.0], [0.0, 2.0], [5.0, 5.0]], [1])]
    found = {r["id"]: r for r in recurrent.score(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert [len(found[i]["scores"]) for i in (1, 2, 3, 4)] == [2, 0, 0, 3]
    # Nulls count as 0, and a step is scored by what stands before it alone.
    assert found[1]["scores"] == pytest.approx(found[4]["scores"][:2], rel=1e-12)
    packed = spark.createDataFrame(rows, SCHEMA)
    assert recurrent.fit(packed, 2, hidden=2, epochs=1).losses
    with pytest.raises(ValueError, match="no row to learn from"):
        recurrent.fit(packed.where(F.col("id") == 3), 2)
