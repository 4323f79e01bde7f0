import uuid

import pytest
from pyspark.sql import functions as F

from panelweave import PanelSpec
from panelweave.operators import history, sequences, stats
from panelweave.plans import prepare
from panelweave.sources import layout

SPEC = PanelSpec("id", ("t", "k"), ("a", "b"), "y")


def panel(spark, n=2000):
    return spark.range(n).selectExpr(
        "if(id % 41 = 0, null, id % 41) as id", "id div 41 as t", "id as k", "if(id % 3 = 0, double(id), null) as a",
        "if(id % 7 = 1, -double(id), null) as b", "int(id % 5 = 0) as y",
    )


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "panel")
    layout.write_by_entity(panel(spark), SPEC, path, 4)
    return layout.attach(spark, path, f"t_{uuid.uuid4().hex}")


def exchanges(df):
    df.collect()
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line and "hashpartitioning(id" in line]


def same(got, want):
    return got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_rows_come_back(spark, table):
    assert table.columns == panel(spark).columns and same(table, panel(spark))
    assert len(table.inputFiles()) == 4


@pytest.mark.parametrize("work", [
    lambda df, fitted: history.ffill(df, SPEC),
    lambda df, fitted: history.ffill_trim(df, SPEC, 2, 20),
    lambda df, fitted: history.keep_last(df, SPEC, 7),
    lambda df, fitted: sequences.to_sequences(df, SPEC, 10, 3),
    lambda df, fitted: prepare.prepare_v1(df, SPEC, stats=fitted, drop=2, keep=20),
])
def test_work_by_entity_needs_no_shuffle(spark, table, work):
    fitted = stats.stats_values(stats.fit_stats(panel(spark), SPEC.features))
    got, want = work(table, fitted), work(panel(spark), fitted)
    assert not exchanges(got) and exchanges(want)
    assert same(got, want)


def test_an_oversized_entity_is_refused(spark, tmp_path):
    rows = panel(spark).withColumn("id", F.when(F.col("id") > 5, F.col("id")))
    with pytest.raises(ValueError, match="too many for one task"):
        layout.write_by_entity(rows, SPEC, str(tmp_path / "p"), 4, group_rows=100)


def test_an_empty_panel(spark, tmp_path):
    layout.write_by_entity(panel(spark).limit(0), SPEC, str(tmp_path / "p"), 4)
    assert layout.attach(spark, str(tmp_path / "p"), f"t_{uuid.uuid4().hex}").count() == 0
