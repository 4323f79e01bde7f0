import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelweave import PanelSpec
from panelweave.operators import history
from panelweave.operators.skew import SEGMENT, cut_hot_groups, running_totals

SPEC = PanelSpec("id", ("t",), ("a", "b"), "y")
SCHEMA = "id long, t long, a double, b double, y int"


def panel(spark, lengths, value=lambda i, t: float(t)):
    rows = [(i, t, value(i, t), None, 0) for i, n in lengths.items() for t in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def kept(df):
    out = {}
    for r in df.select("id", "t").collect():
        out.setdefault(r.id, []).append(r.t)
    return {i: sorted(ts) for i, ts in out.items()}


def test_ffill_keeps_leading_nulls_and_entity_borders(spark):
    rows = [(1, 0, None, 1.0, 0), (1, 1, 5.0, None, 0), (1, 2, None, None, 0), (2, 0, None, None, 0),
            (2, 1, 0.0, None, 0), (2, 2, None, 3.0, 0)]
    for group_rows in (None, 1, 2):
        df = history.ffill(spark.createDataFrame(rows, SCHEMA), SPEC, group_rows=group_rows)
        got = {(r.id, r.t): (r.a, r.b) for r in df.collect()}
        assert got == {
            (1, 0): (None, 1.0), (1, 1): (5.0, 1.0), (1, 2): (5.0, 1.0),
            (2, 0): (None, None), (2, 1): (0.0, None), (2, 2): (0.0, 3.0),
        }


def test_ffill_matches_pandas_when_one_entity_holds_most_rows(spark):
    rng = random.Random(7)
    rows = []
    for i in range(12):
        for t in range(900 if i == 3 else 20):
            rows.append((i, t // 3 if i == 3 else t, t, rng.choice([None, None, rng.random()]), None, 0))
    rng.shuffle(rows)
    spec = PanelSpec("id", ("t", "k"), ("a", "b"), "y")
    df = spark.createDataFrame(rows, "id long, t long, k long, a double, b double, y int").repartition(6)
    got = history.ffill(df, spec, group_rows=50).toPandas().sort_values(["id", "t", "k"]).reset_index(drop=True)
    want = pd.DataFrame(rows, columns=["id", "t", "k", "a", "b", "y"]).sort_values(["id", "t", "k"])
    want["a"] = want.groupby("id")["a"].ffill()
    pd.testing.assert_series_equal(got["a"], want["a"].reset_index(drop=True))


def test_segments_bound_every_group_and_follow_the_order(spark):
    n = 4000
    # One entity holds nearly all rows, and one value of its first order column holds half of them.
    rows = [(1, 5 if k % 2 else k % 11, k) for k in range(n)] + [(2, k, k) for k in range(30)]
    df = spark.createDataFrame(rows, "id long, t long, k long")
    cut = cut_hot_groups(df, ["id"], ["t", "k"], group_rows=200)
    got = cut.toPandas()
    assert len(got) == n + 30
    assert got[got.id == 2][SEGMENT].eq(0).all()
    hot = got[got.id == 1].sort_values(["t", "k"])
    assert hot[SEGMENT].is_monotonic_increasing
    assert hot.groupby(SEGMENT).size().max() <= 400


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz", "decimal(20,2)", "double", "long"])
def test_segments_follow_every_kind_of_order(spark, kind):
    k = F.col("id")
    value = {
        "string": F.concat(F.lit("q"), F.conv(k * 7919 % 5000, 10, 36)),
        "date": F.date_add(F.lit("1999-12-01").cast("date"), (k % 400).cast("int")),
        "timestamp": F.timestamp_micros(1_700_000_000_000_000 + k * 7919 % 5000),
        "timestamp_ntz": F.timestamp_micros(1_700_000_000_000_000 + k * 7919 % 5000).cast("timestamp_ntz"),
        "long": F.lit(2**60) + k % 50,
    }.get(kind, (k * 7919 % 5000).cast(kind))
    df = spark.range(3000).select(F.lit(1).alias("id"), value.alias("t"), k.alias("k"), k.cast("double").alias("a"))
    cut = cut_hot_groups(df, ["id"], ["t", "k"], group_rows=150)
    spans = cut.groupBy(SEGMENT).agg(F.min(F.struct("t", "k")).alias("lo"), F.max(F.struct("t", "k")).alias("hi"))
    ordered = [(r.lo, r.hi) for r in spans.orderBy(SEGMENT).collect()]
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))
    assert kind == "long" or len(ordered) > 10


def test_no_segments_when_groups_fit(spark):
    df = panel(spark, {1: 10, 2: 10})
    assert cut_hot_groups(df, ["id"], ["t"]) is None
    assert cut_hot_groups(df, ["id"], ["t"], group_rows=10) is None


def test_known_bound_saves_the_count(spark):
    spec = PanelSpec("id", ("t",), ("a", "b"), "y", max_history=10)
    df = panel(spark, {1: 10})
    assert cut_hot_groups(df, ["id"], ["t"], 10, spec.max_history) is None
    assert history.ffill_trim(df, spec, 1, 3).count() == 3


def test_running_totals_split_equals_plain(spark):
    rows = [(g, v, v % 5) for g in range(3) for v in range(200 * (g + 1))]
    df = spark.createDataFrame(rows, "g int, v long, n long")
    plain = running_totals(df, ["g"], ["v"], {"up": "n"}, {"next": "v"})
    cut = running_totals(df, ["g"], ["v"], {"up": "n"}, {"next": "v"}, group_rows=37)
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0
    assert plain.where(F.col("next").isNull()).count() == 3


@pytest.mark.parametrize("rows, left", [(5, 0), (6, 1), (20, 15), (55, 50), (56, 51)])
def test_drop_last(spark, rows, left):
    got = kept(history.drop_last(panel(spark, {1: rows, 2: 30}), SPEC, 5))
    assert len(got.get(1, [])) == left and got[2] == list(range(25))


def test_drop_last_of_nothing(spark):
    df = panel(spark, {1: 3})
    assert history.drop_last(df, SPEC, 0).count() == 3


def test_keep_last(spark):
    got = kept(history.keep_last(panel(spark, {1: 49, 2: 50, 3: 51}), SPEC, 50))
    assert got == {1: list(range(49)), 2: list(range(50)), 3: list(range(1, 51))}


@pytest.mark.parametrize("group_rows", [None, 8])
def test_ffill_trim_carries_values_of_cut_rows(spark, group_rows):
    df = panel(spark, {1: 56, 2: 5, 3: 6}, value=lambda i, t: 9.0 if t == 0 else None)
    got = history.ffill_trim(df, SPEC, group_rows=group_rows)
    rows = kept(got)
    assert rows == {1: list(range(1, 51)), 3: [0]}
    assert {r.a for r in got.collect()} == {9.0}


def test_min_history_before_and_after_trim(spark):
    df = panel(spark, {1: 19, 2: 20, 3: 14, 4: 15})
    assert set(kept(history.min_history(df, SPEC, 15))) == {1, 2, 4}
    assert set(kept(history.min_history(history.trim_tail(df, SPEC), SPEC, 15))) == {2}


def test_limit_entities_is_exact(spark):
    got = kept(history.limit_entities(panel(spark, {5: 2, 1: 2, 3: 1, 9: 4}), SPEC, 3))
    assert set(got) == {1, 3, 5}


def test_row_batches_default_and_whole(spark):
    df = panel(spark, {i: 40 for i in range(20)}).withColumn("k", F.col("id") * 1000 + F.col("t"))
    first = history.row_batches(df, ["k"]).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in first) == [(i, 100) for i in range(5)]
    whole = history.row_batches(df, ["k"], 100, None, group_rows=90).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in whole) == [(i, 100) for i in range(8)]
    # A bound too large for one task takes the segmented way and keeps the same rows.
    forced = history.row_batches(df, ["k"], 100, 5, group_rows=90)
    assert forced.count() == 500 and forced.agg(F.max("k")).first()[0] == df.select("k").orderBy(
        "k").limit(500).agg(F.max("k")).first()[0]


def test_equal_batches_cover_the_table(spark):
    df = panel(spark, {1: 53})
    for group_rows in (None, 7):
        sizes = history.equal_batches(df, ["t"], 5, group_rows).groupBy("batch").count().collect()
        assert sorted((r.batch, r["count"]) for r in sizes) == [(0, 11), (1, 11), (2, 11), (3, 11), (4, 9)]


def test_union_aligns_by_name(spark):
    a = spark.createDataFrame([(1, 2.0)], "id long, a double")
    b = spark.createDataFrame([(3.0, 4)], "b double, id long")
    got = {tuple(r) for r in history.union_panels(a, b).select("id", "a", "b").collect()}
    assert got == {(1, 2.0, None), (4, None, 3.0)}


def test_input_order_and_partitions_do_not_matter(spark):
    df = panel(spark, {i: 10 + i for i in range(20)}, lambda i, t: None if (i + t) % 3 else float(t))
    results = [
        sorted(map(tuple, history.ffill_trim(df.repartition(n), SPEC, 2, 8).collect()), key=repr)
        for n in (1, 3, 16)
    ]
    assert results[0] == results[1] == results[2]


def test_a_null_entity_is_an_entity(spark):
    rows = [(e, i, float(i)) for e in (None, 1) for i in range(8)] + [(2, 0, 0.0)]
    df = spark.createDataFrame(rows, "id long, t long, a double")
    spec = PanelSpec("id", ("t",), ("a",))
    dropped = history.drop_last(df, spec, 5)
    assert sorted((str(r.id), r.t) for r in dropped.collect()) == [(e, t) for e in ("1", "None") for t in range(3)]
    assert history.min_history(df, spec, 5).count() == 16
    assert {r.id for r in history.limit_entities(df, spec, 1).collect()} == {None}
    assert history.limit_entities(df, spec, 2).count() == 16


@pytest.mark.parametrize("order", ["text", "three", "null key"])
def test_every_oversized_group_is_cut(spark, order):
    k = F.col("id")
    text = F.concat(F.lit("order-0000000000000000"), F.lpad((k * 7919 % 20_000).cast("string"), 8, "0"))
    key = F.lit(None).cast("long") if order == "null key" else F.lit(1).cast("long")
    columns = {"text": ["text"], "three": ["one", "two", "k"], "null key": ["k"]}[order]
    df = spark.range(20_000).select(key.alias("g"), text.alias("text"), F.lit(1).alias("one"), F.lit("x").alias("two"), k.alias("k"), F.when(k % 9 == 0, k.cast("double")).alias("a"))
    cut = cut_hot_groups(df, ["g"], columns, group_rows=1000)
    sizes = [r["count"] for r in cut.groupBy(SEGMENT).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 1000 and len(sizes) > 20
    spec = PanelSpec("g", tuple(columns), ("a",))
    plain, split = history.ffill(df, spec), history.ffill(df, spec, group_rows=1000)
    assert plain.exceptAll(split).count() == 0
    counted = running_totals(df, ["g"], columns, {"up": "k"}, {"next": "k"}, group_rows=1000)
    assert running_totals(df, ["g"], columns, {"up": "k"}, {"next": "k"}).exceptAll(counted).count() == 0
