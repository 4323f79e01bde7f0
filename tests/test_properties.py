"""Properties over generated panels; each example set runs as one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelweave import PanelSpec
from panelweave.functions.arrays import pad
from panelweave.operators import history, sequences

SPEC = PanelSpec("id", ("t",), ("a",), "y")
CHECKS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
values = st.one_of(st.none(), st.integers(-50, 50).map(float))
panels = st.lists(st.lists(values, min_size=1, max_size=70), min_size=1, max_size=6)


def frame(spark, panel):
    rows = [(i, t, v, t % 2) for i, history_ in enumerate(panel) for t, v in enumerate(history_)]
    return spark.createDataFrame(rows, "id long, t long, a double, y int").repartition(3)


def filled(values_):
    out, last = [], None
    for v in values_:
        last = last if v is None else v
        out.append(last)
    return out


@CHECKS
@given(panel=panels, drop=st.integers(0, 6), keep=st.integers(1, 20), group_rows=st.sampled_from([None, 3, 11]))
def test_fill_and_trim(spark, panel, drop, keep, group_rows):
    found = {}
    for r in history.ffill_trim(frame(spark, panel), SPEC, drop, keep, group_rows).collect():
        found.setdefault(r.id, {})[r.t] = r.a
    for i, values_ in enumerate(panel):
        whole = dict(enumerate(filled(values_)))
        end = max(len(values_) - drop, 0)
        want = {t: whole[t] for t in range(max(end - keep, 0), end)}
        assert found.get(i, {}) == want


@CHECKS
@given(
    steps=st.lists(st.lists(st.integers(1, 9), max_size=12), min_size=1, max_size=8),
    length=st.integers(1, 10), side=st.sampled_from(["pre", "post"]), cut=st.sampled_from(["pre", "post"]),
)
def test_padded_length_is_fixed(spark, steps, length, side, cut):
    df = spark.createDataFrame(list(enumerate(steps)), "id int, s array<int>")
    out = df.select("id", pad(F.col("s"), length, F.lit(0), side, cut).alias("s")).collect()
    for r in out:
        kept = steps[r.id][:length] if cut == "post" else steps[r.id][-length:]
        fill = [0] * (length - len(kept))
        assert r.s == (fill + kept if side == "pre" else kept + fill)


@CHECKS
@given(panel=panels, min_len=st.integers(1, 30), max_len=st.integers(1, 30))
def test_packing_loses_only_short_entities(spark, panel, min_len, max_len):
    got = {r.id: r for r in sequences.to_sequences(frame(spark, panel), SPEC, max_len, min_len).collect()}
    assert set(got) == {i for i, h in enumerate(panel) if len(h) >= min_len}
    for i, r in got.items():
        assert [v[0] for v in r.x] == panel[i][:max_len] and r.n_steps == len(r.x) == len(r.y)
