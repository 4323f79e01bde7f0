"""What Spark makes of the operators: shuffles, sorts, windows and what reaches the scan."""

import re

import pytest
from pyspark.sql import functions as F

from panelweave import PanelSpec, workspace
from panelweave.operators import evaluate, history, sequences, stats
from panelweave.plans import prepare
from registry import queries
from registry.panels import EVENTS, events_panel, orders_panel, ORDERS

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(text, name):
    return len(re.findall(rf"^[\s:+\-*()\d]*{name} ", text, flags=re.M))


def main_plan(text):
    """The plan without the one of the statistics subquery."""
    lines, skip = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = depth if "Subquery subquery" in line and line.lstrip(" :+-").startswith("Subquery") else None
        if skip is None:
            lines.append(line)
    return "\n".join(lines)


def test_ffill_and_trim_take_one_shuffle_sort_and_window(spark):
    text = plan(history.ffill_trim(events_panel(spark, SF), EVENTS))
    assert nodes(text, "Exchange") == nodes(text, "Sort") == nodes(text, "Window") == 1


def test_trim_is_cut_before_the_shuffle(spark):
    text = plan(history.trim_tail(orders_panel(spark, SF), ORDERS))
    assert "WindowGroupLimit" in text.split("Exchange hashpartitioning")[1]
    assert nodes(text, "Exchange") == 1


def test_fit_and_transform_read_the_panel_once(spark):
    """What is left to run reads the trimmed rows: one narrow scan for the fit, one for the transform, no shuffle of rows."""
    df = prepare.prepare_v1(events_panel(spark, SF), EVENTS, F.col("split") == "train")
    df.collect()
    text = plan(df)
    assert "events.parquet" not in text and text.split("Initial Plan")[0].count("FileScan parquet") <= 2
    assert "hashpartitioning" not in text and "NestedLoopJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["flatten_steps", "linear_score", "confusion", "score_label_join", "pad_labels"])
def test_queries_on_prepared_rows_scan_the_events_once(spark, name, monkeypatch):
    """Over all plans that a query runs, its writes included."""
    written = []

    def recorded(df, folder):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return workspace.materialise(df, folder)

    monkeypatch.setattr(prepare, "materialise", recorded)
    monkeypatch.setattr(queries, "materialise", recorded)
    df = queries.QUERIES[name](spark, SF)
    df.collect()
    texts = [t.split("Initial Plan")[0] for t in [*written, plan(df)]]
    # The sample of the split's condition and the categories are read from the entity column alone.
    wide = [line for t in texts for line in t.splitlines() if "FileScan" in line and "events.parquet" in line and "value" in line]
    assert len(wide) == 1


def test_packing_needs_no_second_shuffle(spark):
    prepared = prepare.prepare_v1(events_panel(spark, SF), EVENTS, F.col("split") == "train")
    text = main_plan(plan(sequences.to_sequences(prepared, EVENTS)))
    assert text.count("Exchange hashpartitioning") == 1


def test_row_filters_join_without_a_window(spark):
    panel = orders_panel(spark, SF)
    for df in (history.min_history(panel, ORDERS), history.limit_entities(panel, ORDERS, 5)):
        assert nodes(plan(df), "Window") == 0 and "Semi" in plan(df)
    assert "Anti" in plan(history.drop_last(panel, ORDERS, 5))


def test_scan_reads_needed_columns_only(spark):
    lengths = plan(history.entity_lengths(orders_panel(spark, SF), ORDERS))
    assert "ReadSchema: struct<o_custkey:bigint>" in lengths
    means = plan(stats.column_means(orders_panel(spark, SF), ["p_total"]))
    assert "ReadSchema: struct<o_totalprice:double>" in means


def test_id_filter_reaches_the_scan(spark):
    raw = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(raw.where(F.col("user_id") <= 7).select("user_id", "value"))
    assert "LessThanOrEqual(user_id,7)" in text


def test_sweep_counts_once(spark):
    rows = spark.range(10).select(
        F.lit("train").alias("split"), (F.col("id") % 2).cast("int").alias("y"),
        (F.col("id") / 10).alias("score"), F.lit(False).alias("padded"),
    )
    text = plan(evaluate.threshold_sweep(rows))
    assert nodes(text, "Window") == 0 and text.count("Range (") == 1
    assert "Generate explode" in text.split("HashAggregate")[1] + text.split("HashAggregate")[2]


def test_oversized_entity_is_split_by_the_join(spark):
    """A third of the rows in one entity, and a list of entities too long to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        k = F.col("id")
        df = spark.range(0, 200_000, 1, 16).select(
            F.when(k % 3 == 0, 7).otherwise(100 + k % 5000).alias("id"), k.alias("t"), F.rand(1).alias("a")
        )
        spec = PanelSpec("id", ("t",), ("a",))
        kept = history.min_history(df, spec, 15)
        assert kept.count() == 200_000
        rows = kept.collect()
        assert len(rows) == 200_000 and "skew=true" in plan(kept)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
