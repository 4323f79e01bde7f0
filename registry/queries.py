"""One query per operator, over whole tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.operators import drift, encode, evaluate, history, monitor, sequences, split, stats, summaries
from panelweave.plans import batch, learn, prepare, recurrent, score
from panelweave.sources import files, folders, layout
from panelweave.sources.schema import HOUR
from panelweave.spec import PanelSpec
from panelweave.streaming.alarms import held_back, score_rows, stream_alarms
from panelweave.streaming.settling import Settling
from panelweave.workspace import fresh_path, materialise
from registry.panels import (
    ALARM, BIAS, ENCODED, EVENT_FEATURES, EVENTS, HOURLY_SEEN, ORDERS, SHARES, TYPES, WEIGHTS,
    drift_samples, event_columns, events_panel, hourly_panel, orders_panel, table, types_panel,
)

NUMERIC = ("value", "v_view", "v_click", "v_error", "v_purchase", "v_signup")
CATEGORICAL = ("event_type", "grp")
BATCHES = 5
QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__.rstrip("_")] = f
    return f


def is_train() -> Column:
    return F.col("split") == "train"


def r6(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(F.col(c), digits).alias(c) for c in names]


# ---- panels used by several queries


def encoded(spark: SparkSession, sf_dir: str):
    panel = events_panel(spark, sf_dir)
    categories = encode.fit_categories(panel.where(is_train()), "grp")
    return prepare.encode(panel, EVENTS, "grp", categories)


def prepared(spark: SparkSession, sf_dir: str):
    panel, spec = encoded(spark, sf_dir)
    return prepare.prepare_v1(panel, spec, is_train()), spec


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel, spec = prepared(spark, sf_dir)
    return sequences.to_sequences(panel, spec)


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = sequences.validate_shape(
        sequences.pad_sequences(packed(spark, sf_dir), len(ENCODED)), 50, len(ENCODED)
    )
    return sequences.flatten_steps(padded, "id")


def scored_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = steps(spark, sf_dir).withColumn("score", score.linear_step_score(WEIGHTS, BIAS))
    return split.hash_split(found.drop("x"), "id", SHARES)


def micro(matrix: str) -> Column:
    """A matrix as JSON text, in millionths."""
    return F.to_json(F.transform(matrix, lambda v: F.transform(v, lambda e: F.round(e * 1e6).cast("bigint"))))


def batched(spark: SparkSession, sf_dir: str):
    ref, cur = drift_samples(spark, sf_dir)
    # Numbering the rows of the whole table is costly and the batches are read more than once.
    return ref, materialise(history.equal_batches(cur, EVENTS.order, BATCHES), "current")


# ---- sources and sinks


@query
def psv_scan(spark, sf_dir):
    panel = table(spark, sf_dir, "events").select(*event_columns())
    path = fresh_path(spark, "entity-files")
    files.write_panel_dir(panel, EVENTS, path)
    schema = T.StructType([f for f in panel.schema if f.name != "id"])
    back = files.read_panel_dir(spark, path, schema, id_pattern=files.ENTITY_FOLDER)
    return back.select("id", "event_id", *EVENT_FEATURES, "label")


@query
def psv_scan_flat(spark, sf_dir):
    """One file per entity in one folder, as the entity files come."""
    panel = table(spark, sf_dir, "events").select(*event_columns())
    path = fresh_path(spark, "flat-files")
    files.write_entity_files(panel, EVENTS, path)
    schema = T.StructType([f for f in panel.schema if f.name != "id"])
    back = files.read_panel_dir(spark, path, schema)
    return back.select("id", "event_id", *EVENT_FEATURES, "label")


@query
def hourly_sequences(spark, sf_dir):
    """Entity files of two folders to padded steps: scan, prepare, pack and pad."""
    panel, paths = hourly_panel(spark, sf_dir), {}
    for name in SHARES:
        paths[name] = fresh_path(spark, f"hourly-{name}")
        files.write_entity_files(panel.where(F.col("split") == name).drop("split"), PanelSpec("id", (HOUR,), ()), paths[name])
    train, test = (batch.load_hourly(spark, paths[name]) for name in SHARES)
    prepared, spec = batch.prepare_hourly(train, test)
    padded = sequences.validate_shape(batch.padded_sequences(prepared, spec), 50, len(spec.features))
    flat = sequences.unpack_features(sequences.flatten_steps(padded, "id"), list(spec.features))
    rest = sum((F.col(c) for c in spec.features if c not in HOURLY_SEEN), F.lit(0.0))
    return flat.select("id", "step", "padded", "y", *r6(*HOURLY_SEEN), rest.alias("rest"))


@query
def panel_csv(spark, sf_dir):
    panel = orders_panel(spark, sf_dir)
    path = fresh_path(spark, "panel-csv")
    files.write_panel(panel, path, "csv")
    back = files.read_panel_csv(spark, path, panel.schema)
    return back.select("id", "o_orderkey", "p_urgent", "p_low", "p_total", "status", "label", "split")


@query
def sequence_store(spark, sf_dir):
    path = fresh_path(spark, "sequences")
    files.write_sequences(packed(spark, sf_dir), path)
    back = files.read_sequences(spark, path)
    return back.select("id", "n_steps", micro("x").alias("x"), F.to_json("y").alias("y"))


@query
def entity_cap(spark, sf_dir):
    return history.limit_entities(events_panel(spark, sf_dir), EVENTS, 100).select("id", "event_id")


@query
def panel_union(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    first, second = panel.where(is_train()), panel.where(~is_train()).drop("v_const")
    return history.union_panels(first, second).select("id", "event_id", "v_view", "v_const", "split")


@query
def predictions_json(spark, sf_dir):
    alarms = evaluate.entity_alarm(scored_steps(spark, sf_dir), "id", ALARM)
    return evaluate.predictions_json(alarms, "id")


# ---- projections


@query
def drop_cols(spark, sf_dir):
    return encode.drop_columns(events_panel(spark, sf_dir), ["ts", "v_empty", "v_const", "grp", "split"])


@query
def one_hot(spark, sf_dir):
    panel = orders_panel(spark, sf_dir)
    categories = encode.fit_categories(panel.where(is_train()), "status")
    return encode.one_hot(panel, "status", categories).drop("o_orderdate")


@query
def one_hot_end(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    categories = encode.fit_categories(panel.where(is_train()), "grp")
    return encode.one_hot(panel, "grp", categories, position="end", prefix="column_grp").select(
        "id", "event_id", "label", "column_grp_0", "column_grp_1"
    )


@query
def one_hot_long(spark, sf_dir):
    """Indicators of a column with any number of categories."""
    return encode.category_rows(orders_panel(spark, sf_dir), ["o_orderkey"], "id")


@query
def null_profile(spark, sf_dir):
    found = encode.null_profile(events_panel(spark, sf_dir), EVENT_FEATURES)
    return found.select("column", "n_rows", "n_null", *r6("null_share"))


@query
def drop_sparse(spark, sf_dir):
    panel = events_panel(spark, sf_dir).drop("ts")
    train, test = encode.drop_sparse_columns(panel.where(is_train()), [panel.where(~is_train())], EVENT_FEATURES)
    return history.union_panels(train, test)


# ---- filters and splits


@query
def min_history(spark, sf_dir):
    return history.min_history(orders_panel(spark, sf_dir), ORDERS, 15).select("id", "o_orderkey")


@query
def split_id_range(spark, sf_dir):
    panel = events_panel(spark, sf_dir).drop("split")
    top = panel.agg(F.max("id")).first()[0]
    return split.split_by_id_range(panel, "id", [top // 2, top], ["train", "test"]).select(
        "id", "event_id", "split"
    )


@query
def hash_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    by_entity = split.hash_split(orders, "o_custkey", {"train": 60, "test": 20, "valid": 20})
    by_row = split.hash_split(
        by_entity.withColumnRenamed("split", "entity_split"), "o_orderkey", SHARES, seed=42
    )
    return by_row.withColumnRenamed("split", "row_split")


PARTS = {"train": 60, "test": 25, "valid": 15}


@query
def stratified_split(spark, sf_dir):
    """Every order with the part of its customer; parts have exact shares of customers with and without an order of the label."""
    orders = orders_panel(spark, sf_dir).drop("split")
    return split.stratified_split(orders.select("id", "o_orderkey", "label"), "id", "label", PARTS)


# ---- aggregates


@query
def column_means(spark, sf_dir):
    names = [c for c in EVENT_FEATURES if c != "grp"]
    return stats.column_means(events_panel(spark, sf_dir).where(is_train()), names).select(*r6(*names))


@query
def column_minmax(spark, sf_dir):
    return stats.column_bounds(events_panel(spark, sf_dir).where(is_train()), EVENT_FEATURES)


@query
def entity_lengths(spark, sf_dir):
    return history.entity_lengths(orders_panel(spark, sf_dir), ORDERS)


@query
def entity_alarm(spark, sf_dir):
    return evaluate.entity_alarm(scored_steps(spark, sf_dir), "id", ALARM)


# ---- windows


@query
def ffill(spark, sf_dir):
    return history.ffill(events_panel(spark, sf_dir), EVENTS).drop("ts", "split")


@query
def ffill_split(spark, sf_dir):
    """Forward-fill of entities that are cut into segments, each entity holding a large share of the table."""
    panel, group_rows = types_panel(spark, sf_dir)
    return history.ffill(panel, TYPES, group_rows=group_rows).drop("ts")


@query
def ffill_split_text(spark, sf_dir):
    """Forward-fill by a text order whose values begin alike."""
    panel, group_rows = types_panel(spark, sf_dir)
    text = F.concat(F.lit("event-00000000000000000000"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    spec = PanelSpec(TYPES.entity, ("name",), TYPES.features, TYPES.label)
    return history.ffill(panel.withColumn("name", text), spec, group_rows=group_rows).drop("ts", "name")


@query
def ffill_split_three(spark, sf_dir):
    """Forward-fill by three order columns, of which the first two are constant."""
    panel, group_rows = types_panel(spark, sf_dir)
    spec = PanelSpec(TYPES.entity, ("one", "two", "event_id"), TYPES.features, TYPES.label)
    panel = panel.withColumns({"one": F.lit(1), "two": F.lit("x")})
    return history.ffill(panel, spec, group_rows=group_rows).drop("ts", "one", "two")


@query
def ffill_split_null(spark, sf_dir):
    """Forward-fill of entities of which one is null and oversized."""
    panel, group_rows = types_panel(spark, sf_dir)
    some = F.nullif(F.col(TYPES.entity), F.lit("view"))
    return history.ffill(panel.withColumn(TYPES.entity, some), TYPES, group_rows=group_rows).drop("ts")


@query
def drop_last_null(spark, sf_dir):
    """Drop the newest rows of entities, of which one is null."""
    orders = orders_panel(spark, sf_dir).withColumn("id", F.when(F.col("id") % 7 > 0, F.col("id")))
    return history.drop_last(orders, ORDERS).select("id", "o_orderkey", "p_total")


@query
def ffill_trim_split(spark, sf_dir):
    panel, group_rows = types_panel(spark, sf_dir)
    return history.ffill_trim(panel, TYPES, group_rows=group_rows).drop("ts")


@query
def drop_last(spark, sf_dir):
    return history.drop_last(orders_panel(spark, sf_dir), ORDERS, 5).select("id", "o_orderkey", "p_total")


@query
def keep_last(spark, sf_dir):
    return history.keep_last(orders_panel(spark, sf_dir), ORDERS, 8).select("id", "o_orderkey", "p_total")


@query
def trim_tail(spark, sf_dir):
    return history.trim_tail(orders_panel(spark, sf_dir), ORDERS, 5, 8).select("id", "o_orderkey", "p_total")


@query
def row_batches(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    return history.row_batches(panel, EVENTS.order, 100, None).select("event_id", "batch")


@query
def row_batches_split(spark, sf_dir):
    """Batches of the whole table numbered by segments, as a large table is."""
    panel = orders_panel(spark, sf_dir)
    share = -(-panel.count() // 16)
    return history.row_batches(panel, ORDERS.order, 100, None, group_rows=share).select("o_orderkey", "batch")


# ---- imputation and scaling


@query
def mean_impute(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    fitted = stats.fit_stats(panel, EVENT_FEATURES, is_train())
    return stats.impute(panel, EVENT_FEATURES, fitted).select("id", "event_id", *r6(*EVENT_FEATURES))


@query
def zero_impute(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    return stats.impute(panel, EVENT_FEATURES, how="zero").select("id", "event_id", *r6(*EVENT_FEATURES))


@query
def minmax_scale(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    fitted = stats.fit_stats(panel, EVENT_FEATURES, is_train())
    return stats.min_max_scale(panel, EVENT_FEATURES, fitted).select("id", "event_id", *r6(*EVENT_FEATURES))


@query
def prepare_v1(spark, sf_dir):
    panel, spec = prepared(spark, sf_dir)
    return panel.select("id", "event_id", *r6(*spec.features), "label", "split")


@query
def entity_layout(spark, sf_dir):
    """The first preparation over a table laid out by entity, where it needs no shuffle."""
    panel, spec = encoded(spark, sf_dir)
    path = fresh_path(spark, "by-entity")
    layout.write_by_entity(panel, spec, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = layout.attach(spark, path, f"by_entity_{uuid.uuid4().hex}")
    out = prepare.prepare_v1(laid, spec, is_train())
    return out.select("id", "event_id", *r6(*spec.features), "label", "split")


@query
def prepare_v2(spark, sf_dir):
    panel, spec = encoded(spark, sf_dir)
    out = prepare.prepare_v2(panel, spec, is_train())
    return out.select("id", "event_id", *r6(*spec.features), "label", "split")


@query
def prepare_v3(spark, sf_dir):
    panel = orders_panel(spark, sf_dir).withColumn("p_none", F.lit(None).cast("double"))
    out, spec = prepare.prepare_v3(panel, ORDERS.with_features(*ORDERS.features, "p_none"), is_train())
    return out.select("id", "o_orderkey", *r6(*spec.features, digits=3), "label", "split")


@query
def prepare_v4(spark, sf_dir):
    out, spec = prepare.prepare_v4(orders_panel(spark, sf_dir), ORDERS, is_train(), ("p_low",))
    return out.select("id", "o_orderkey", *r6(*spec.features), "label", "split")


@query
def self_fit_prepare(spark, sf_dir):
    panel, spec = encoded(spark, sf_dir)
    out = prepare.prepare_v1(panel.where(~is_train()), spec)
    return out.select("id", "event_id", *r6(*spec.features), "label")


@query
def saved_stats_prepare(spark, sf_dir):
    panel, spec = encoded(spark, sf_dir)
    path = fresh_path(spark, "stats")
    trimmed = history.ffill_trim(panel.where(is_train()), spec)
    files.save_stats(stats.fit_stats(trimmed, spec.features), path)
    out = prepare.prepare_v1(panel.where(~is_train()), spec, stats=files.load_stats(spark, path))
    return out.select("id", "event_id", *r6(*spec.features), "label")


# ---- sequences


@query
def sequences_(spark, sf_dir):
    return packed(spark, sf_dir).select("id", "n_steps", micro("x").alias("x"), F.to_json("y").alias("y"))


def _padded(spark, sf_dir, side):
    out = sequences.pad_sequences(packed(spark, sf_dir), len(ENCODED), 50, side)
    return out.select("id", micro("x").alias("x"), F.to_json("y").alias("y"))


@query
def pad_pre(spark, sf_dir):
    return _padded(spark, sf_dir, "pre")


@query
def pad_post(spark, sf_dir):
    return _padded(spark, sf_dir, "post")


@query
def pad_labels(spark, sf_dir):
    found = materialise(packed(spark, sf_dir).select("id", "n_steps", "x", "y"), "packed")
    post = sequences.pad_sequences(found, len(ENCODED), 50, "pre", label_side="post")
    pre = sequences.pad_sequences(found, len(ENCODED), 40, "post", label_side="pre", label_truncate="pre")
    return post.select("id", F.to_json("y").alias("y_post")).join(
        pre.select("id", F.to_json("y").alias("y_pre")), "id"
    )


@query
def flatten_steps(spark, sf_dir):
    flat = sequences.unpack_features(steps(spark, sf_dir), list(ENCODED))
    return flat.select("id", "step", "padded", "y", *r6(*ENCODED))


# ---- scores and evaluation


@query
def linear_score(spark, sf_dir):
    panel, spec = prepared(spark, sf_dir)
    out = panel.withColumn("score", score.linear_score(spec.features, WEIGHTS, BIAS))
    return out.select("id", "event_id", *r6("score"))


@query
def score_user_model(spark, sf_dir):
    padded = sequences.pad_sequences(packed(spark, sf_dir), len(ENCODED))
    weights, bias = list(WEIGHTS), BIAS

    def make_predict():
        w = np.array(weights)

        def predict(x):
            return 1.0 / (1.0 + np.exp(-(x @ w + bias)))

        return predict

    out = score.score_with(padded, make_predict, 50, len(ENCODED))
    flat = out.select("id", F.posexplode("scores").alias("step", "score"))
    return flat.select("id", "step", *r6("score"))


@query
def score_label_join(spark, sf_dir):
    # Scores come from a table of their own, as they do where a model wrote them.
    found = materialise(scored_steps(spark, sf_dir), "scored-steps")
    labels, scores = found.select("id", "step", "y"), found.select("id", "step", *r6("score"))
    return evaluate.join_scores(labels, scores, ["id", "step"])


@query
def confusion(spark, sf_dir):
    return evaluate.confusion_by_padding(scored_steps(spark, sf_dir), ALARM, by=["split"])


@query
def binary_metrics(spark, sf_dir):
    counts = evaluate.confusion(scored_steps(spark, sf_dir), ALARM, by=["split"])
    return evaluate.binary_metrics(counts).select("split", *r6("sensitivity", "precision", "f1"))


@query
def running_metrics(spark, sf_dir):
    found = scored_steps(spark, sf_dir).withColumn("batch", F.expr("id div 16"))
    counts = evaluate.confusion(found, ALARM, by=["batch"])
    return evaluate.running_metrics(counts, ["batch"]).select(
        "batch", "tn", "fp", "fn", "tp", *r6("sensitivity", "precision", "f1")
    )


@query
def threshold_sweep(spark, sf_dir):
    found = evaluate.threshold_sweep(scored_steps(spark, sf_dir))
    return found.select(
        "split", "threshold", "tn", "fp", "fn", "tp", *r6("sensitivity", "precision", "f1")
    )


@query
def sweep_intervals(spark, sf_dir):
    """The sweep with bootstrap intervals by entity."""
    found = evaluate.sweep_intervals(scored_steps(spark, sf_dir), "id", replicates=20)
    return found.select("split", "threshold", *r6("sensitivity", "sensitivity_low", "sensitivity_high", "f1", "f1_low", "f1_high"))


def with_gaps(steps: DataFrame) -> DataFrame:
    """Steps some of which have no label, or a score that is null or NaN; every tenth entity has no score at all."""
    k = F.col("id") + F.col("step")
    score = F.when((k % 7 == 0) | (F.col("id") % 10 == 0), None).when(k % 11 == 0, float("nan")).otherwise(F.col("score"))
    return steps.withColumn("score", score).withColumn("y", F.when(k % 13 != 0, F.col("y")))


@query
def unknown_scores(spark, sf_dir):
    """Counts, sweep and alarms over scores with gaps: one rule for all three."""
    steps = materialise(with_gaps(scored_steps(spark, sf_dir)).select("id", "split", "step", "score", "y", "padded"), "gaps")
    cells = ["split", "tn", "fp", "fn", "tp", "unknown"]
    counted = evaluate.confusion(steps, ALARM, by=["split"]).select(F.lit("counts").alias("source"), *cells)
    swept = evaluate.threshold_sweep(steps, (0.05, ALARM)).where(F.col("threshold") == ALARM).select(F.lit("sweep").alias("source"), *cells)
    alarms = evaluate.entity_alarm(steps, "id", ALARM).agg(
        F.count_if(F.col("result") == 0).alias("tn"), F.count_if(F.col("result") == 1).alias("tp"), F.count_if(F.col("result").isNull()).alias("unknown")
    )
    none = F.lit(0).cast("long")
    return counted.unionByName(swept).unionByName(alarms.select(F.lit("alarms").alias("source"), F.lit("all").alias("split"), "tn", none.alias("fp"), none.alias("fn"), "tp", "unknown"))


# ---- learning


@query
def causal_features(spark, sf_dir):
    panel, spec = prepared(spark, sf_dir)
    spec = spec.bounded(50)
    out = learn.causal_features(panel, spec)
    return out.select("id", "event_id", *r6(*learn.causal_feature_names(spec)))


@query
def causal_features_split(spark, sf_dir):
    """The same over blocks of each history, each entity holding a large share of the table."""
    panel, group_rows = types_panel(spark, sf_dir)
    out = learn.causal_features(panel, TYPES, group_rows=group_rows)
    return out.select("id", "event_id", *r6(*learn.causal_feature_names(TYPES)))


@query
def rf_importance(spark, sf_dir):
    panel, spec = prepared(spark, sf_dir)
    return learn.feature_importance(panel.where(is_train()), spec)


@query
def step_classifier(spark, sf_dir):
    panel, spec = prepared(spark, sf_dir)
    spec = spec.bounded(50)
    # Written once: the fit and the scores read the same rows.
    wide = materialise(learn.causal_features(panel, spec), "wide")
    model = learn.train_step_classifier(wide.where(is_train()), learn.causal_feature_names(spec), "label")
    return learn.score(wide, model).select("id", "event_id", "label", "split", *r6("score"))


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a label that the price alone tells, beside constant and empty columns."""
    made = {"label": (F.col("p_total") > 150_000).cast("int"), "p_const": F.lit(3.0), "p_zero": F.lit(0.0)}
    return orders_panel(spark, sf_dir).withColumns(made)


@query
def select_features(spark, sf_dir):
    """The features that forest importance keeps: the planted one."""
    spec = ORDERS.with_features("p_total", "p_const", "p_zero")
    _, kept = learn.select_features(_planted(spark, sf_dir), [], spec)
    return spark.createDataFrame([(c,) for c in kept.features], "feature string")


@query
def permutation_importance(spark, sf_dir):
    """Of a planted feature and two constant ones, the planted one matters and the others are exactly 0."""
    rows = _planted(spark, sf_dir)
    model = learn.train_step_classifier(rows.where(is_train()), ["p_total", "p_const", "p_zero"], "label", "logreg", maxIter=20)
    found = learn.permutation_importance(rows, model, ["o_orderkey"], "label")
    return found.select("split", "feature", (F.col("importance") > 0.1).alias("matters"), (F.col("importance") == 0).alias("none"))


@query
def step_classifier_auc(spark, sf_dir):
    """Whether the step classifier ranks held-out rows by a planted label."""
    spec = ORDERS.with_features("p_total", "p_const")
    wide = materialise(learn.causal_features(_planted(spark, sf_dir), spec), "wide")
    model = learn.train_step_classifier(wide.where(is_train()), learn.causal_feature_names(spec), "label")
    scored = materialise(learn.score(wide, model).select("split", F.col("label").cast("double").alias("label"), "score"), "scores")
    area = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    found = [(name, area.evaluate(scored.where(F.col("split") == name)) > 0.95) for name in SHARES]
    return spark.createDataFrame(found, "split string, ranked boolean")


@query
def recurrent_classifier(spark, sf_dir):
    """Held-out ranking of a planted signal, seven rows old or older: the network sees it, windows of six rows do not."""
    mark = (F.col("event_id") % 41 == 0).cast("double")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "ts", "event_id", mark.alias("mark"), (F.col("value") / 100).alias("noise"))
    spec = PanelSpec("id", ("ts", "event_id"), ("mark", "noise"), "label")
    packed = sequences.to_sequences(rows.withColumn("label", F.lit(0)), spec)

    def marked(first, n) -> Column:
        return F.exists(F.slice("x", F.greatest(first, F.lit(1)), F.greatest(n, F.lit(0))), lambda v: v[0] == 1)

    at = F.sequence(F.lit(1), F.col("n_steps"))
    packed = packed.withColumn("y", F.transform(at, lambda t: marked(F.lit(1), t - 7).cast("int")))
    packed = packed.withColumn("recent", F.transform(at, lambda t: marked(t - 5, F.least(t, F.lit(6))).cast("double")))
    packed = materialise(split.hash_split(packed, "id", SHARES), "packed")
    model = recurrent.fit(packed.where(is_train()), 2, hidden=16, epochs=60)
    steps = recurrent.score(packed, model).select("id", "split", F.explode(F.arrays_zip("x", "y", "recent", "scores")).alias("s"))
    steps = materialise(steps.select("split", "s.x", F.col("s.y").cast("double").alias("y"), "s.recent", F.col("s.scores").alias("score")), "steps")
    seen = steps.withColumns({"mark": F.col("x")[0], "noise": F.col("x")[1]})
    windows = learn.score(seen, learn.train_step_classifier(seen.where(is_train()), ["mark", "noise", "recent"], "y", "logreg", maxIter=20), "window")
    windows = materialise(windows.select("split", "y", "score", "window"), "both-scores")

    def area(of: DataFrame, column: str) -> float:
        return BinaryClassificationEvaluator(rawPredictionCol=column, labelCol="y").evaluate(of)

    found = []
    for name in SHARES:
        own = windows.where(F.col("split") == name)
        found.append((name, area(own, "score") > 0.9, area(own, "window") < 0.7))
    return spark.createDataFrame(found, "split string, network_ranks boolean, windows_do_not boolean")


@query
def logistic_coefficients(spark, sf_dir):
    """A logistic fit on one binary feature, whose coefficients are logarithms of counted odds."""
    dear = (F.col("o_totalprice") > 150_000).cast("double")
    label = (F.col("o_custkey") % 3 == 0) | ((dear == 1) & (F.col("o_orderkey") % 2 == 0))
    rows = table(spark, sf_dir, "orders").select(dear.alias("x"), label.cast("int").alias("y"))
    model = learn.train_step_classifier(rows, ["x"], "y", "logreg", maxIter=200, regParam=0.0, tol=1e-12).stages[-1]
    found = [("intercept", float(model.intercept)), ("x", float(model.coefficients[0]))]
    return spark.createDataFrame(found, "name string, value double").select("name", F.round("value", 3).alias("value"))


@query
def score_keeps_nulls(spark, sf_dir):
    """Scoring returns the rows as they came, nulls included."""
    orders = orders_panel(spark, sf_dir)
    model = learn.train_step_classifier(orders.where(is_train()), ["p_urgent", "p_total"], "label", "logreg", maxIter=5)
    scored = learn.score(orders, model)
    return scored.select("id", "o_orderkey", "p_urgent", "p_low", "p_total", F.col("score").isNotNull().alias("scored"))


@query
def model_versions(spark, sf_dir):
    panel, spec = prepared(spark, sf_dir)
    model = learn.train_step_classifier(panel.where(is_train()), list(spec.features), "label", "logreg")
    base = fresh_path(spark, "models")
    # Another model in the same second; then a writer that ends in the middle of a later version.
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    other = learn.train_step_classifier(panel.where(is_train()), list(spec.features[:1]), "label", "logreg", maxIter=1)
    paths = [learn.save_model_version(spark, m, base, at) for m in (other, model)]
    unfinished = f"{base}/{learn.VERSION}20250101000000"
    spark.read.text(f"{paths[1]}/metadata").write.text(f"{unfinished}/metadata")
    fresh = learn.score(panel, model).select("id", "event_id", "score")
    loaded = learn.score(panel, learn.load_latest_model(spark, base)).select("id", "event_id", "score")
    both = evaluate.join_scores(fresh.withColumnRenamed("score", "fresh"), loaded, ["id", "event_id"])
    return both.select("id", "event_id", (F.abs(F.col("fresh") - F.col("score")) < 1e-12).alias("same"))


@query
def run_log(spark, sf_dir):
    counts = evaluate.confusion(scored_steps(spark, sf_dir), ALARM, by=["split"])
    path = fresh_path(spark, "runs")
    for row in evaluate.binary_metrics(counts).collect():
        metrics = {"sensitivity": row["sensitivity"], "f1": row["f1"]}
        learn.log_run(spark, path, row["split"], {"threshold": ALARM, "split": row["split"]}, metrics)
    runs = learn.read_runs(spark, path)
    return runs.select(
        "run_id",
        F.col("params")["threshold"].alias("threshold"),
        F.round(F.col("metrics")["sensitivity"], 6).alias("sensitivity"),
        F.round(F.col("metrics")["f1"], 6).alias("f1"),
    )


# ---- drift and data quality


@query
def missing_values(spark, sf_dir):
    _, cur = batched(spark, sf_dir)
    found = drift.missing_values(cur, EVENT_FEATURES)
    return found.select(
        "batch", "n_rows", "n_missing", *r6("share_missing"), "rows_with_missing", "columns_with_missing"
    )


@query
def missing_by_column(spark, sf_dir):
    _, cur = batched(spark, sf_dir)
    found = drift.missing_by_column(cur, EVENT_FEATURES)
    return found.select("batch", "column", "n_missing", *r6("share_missing"))


@query
def column_summary(spark, sf_dir):
    _, cur = batched(spark, sf_dir)
    found = drift.column_summary(cur, NUMERIC)
    return found.select(
        "batch", "column", "n", "n_missing", *r6("mean", "std", "min", "max", "p25", "p50", "p75"),
        "n_unique", "most_common",
    )


@query
def wasserstein(spark, sf_dir):
    ref, cur = batched(spark, sf_dir)
    return drift.wasserstein(ref, cur, NUMERIC).select(
        "batch", "column", *r6("wasserstein", "drift_score")
    )


@query
def wasserstein_split(spark, sf_dir):
    """The distances with the sorted values of every column cut into segments."""
    ref, cur = batched(spark, sf_dir)
    share = -(-ref.count() // 16)
    return drift.wasserstein(ref, cur, NUMERIC, group_rows=share).select(
        "batch", "column", *r6("wasserstein", "drift_score")
    )


@query
def ks_statistic(spark, sf_dir):
    ref, cur = batched(spark, sf_dir)
    return drift.ks_statistic(ref, cur, NUMERIC).select(
        "batch", "column", "n_ref", "n_cur", *r6("ks", "ks_p_value")
    )


@query
def js_distance(spark, sf_dir):
    ref, cur = batched(spark, sf_dir)
    return drift.js_distance(ref, cur, CATEGORICAL).select("batch", "column", *r6("js"))


@query
def chi2_statistic(spark, sf_dir):
    ref, cur = batched(spark, sf_dir)
    return drift.chi2_statistic(ref, cur, CATEGORICAL).select("batch", "column", "n_values", *r6("chi2", "p_value"))


@query
def z_statistic(spark, sf_dir):
    ref, cur = batched(spark, sf_dir)
    return drift.z_statistic(ref, cur, CATEGORICAL).select("batch", "column", *r6("z", "p_value"))


KINDS = {c: "numeric" for c in NUMERIC} | {c: "categorical" for c in CATEGORICAL}


def _report(spark, sf_dir, samples=None):
    ref, cur = samples or batched(spark, sf_dir)
    return drift.drift_by_batch(ref, cur, KINDS)


@query
def drift_by_batch(spark, sf_dir):
    return _report(spark, sf_dir).select("batch", "column", "stattest", *r6("score"), "drifted")


@query
def drift_by_batch_small(spark, sf_dir):
    """Drift by the p-values of tests."""
    found = drift.drift_by_batch(*batched(spark, sf_dir), KINDS, p_values=True)
    return found.select("batch", "column", "stattest", *r6("score"), "drifted")


@query
def incremental_drift(spark, sf_dir):
    """Drift from stored counts, to which batches were added one by one, and one of them twice."""
    ref, cur = batched(spark, sf_dir)
    path = fresh_path(spark, "monitor")
    known, store = (monitor.CountStore(spark, f"{path}/{n}", KINDS) for n in ("reference", "batches"))
    known.add(ref, 0)
    for i in [*range(BATCHES), 1]:
        store.add(cur.where(F.col("batch") == i), i)
    return store.drift(known).select("batch", "column", "stattest", *r6("score"), "drifted")


SKETCH = 1600


@query
def sketch_drift(spark, sf_dir):
    """Whether distances from merged quantile sketches are within their error of the exact ones."""
    ref, cur = batched(spark, sf_dir)
    # Sketches of parts of each side, merged.
    parts = summaries.summarise(ref, NUMERIC, ["id"], SKETCH), summaries.summarise(cur.withColumn("part", F.col("event_id") % 4), NUMERIC, ["batch", "part"], SKETCH)
    near = summaries.sketch_drift(summaries.merge(parts[0]), summaries.merge(parts[1], ["batch"]), SKETCH)
    exact = drift.numeric_drift(ref, cur, NUMERIC).select("batch", "column", F.col("wasserstein").alias("w"), F.col("ks").alias("d"))
    both = near.join(exact, ["batch", "column"])
    within = [(F.abs(F.col(a) - F.col(b)) <= F.col(f"{a}_error")).alias(f"{a}_within") for a, b in (("wasserstein", "w"), ("ks", "d"))]
    return both.select("batch", "column", "n_ref", "n_cur", *within)


@query
def merged_stats(spark, sf_dir):
    """Statistics for scaling, merged from summaries of the training entities' days."""
    panel = events_panel(spark, sf_dir).where(is_train()).withColumn("day", F.to_date("ts"))
    merged = summaries.merge(summaries.summarise(panel, EVENT_FEATURES, ["day"]))
    spread = F.sqrt(F.try_divide("m2", "n")).alias("spread")
    return merged.select("column", "n", "nulls", *r6("mean", "low", "high"), spread).select("column", "n", "nulls", "mean", "low", "high", *r6("spread"))


@query
def drift_many_batches(spark, sf_dir):
    """All events, in batches of 100 rows, against the reference."""
    ref, _ = drift_samples(spark, sf_dir)
    rows = table(spark, sf_dir, "events").select(*event_columns(), "value", "event_type")
    cur = materialise(history.row_batches(rows, EVENTS.order, 100, None), "current")
    found = drift.drift_by_batch(ref, cur, KINDS)
    return found.select("batch", "column", "stattest", *r6("score"), "drifted")


@query
def dataset_drift(spark, sf_dir):
    found = drift.dataset_drift(_report(spark, sf_dir))
    return found.select("batch", "n_columns", "n_drifted", *r6("share_drifted"), "dataset_drift")


@query
def drift_tests(spark, sf_dir):
    found = drift.drift_tests(_report(spark, sf_dir))
    return found.select("batch", "test", "column", *r6("value"), "passed")


def _reports(spark, sf_dir):
    # Numbering the batches writes the current rows; both reports read the same ones.
    ref, cur = batched(spark, sf_dir)
    quality = drift.missing_values(cur, EVENT_FEATURES)
    at = F.date_format(F.date_add(F.lit("2024-02-01").cast("date"), F.col("batch").cast("int")), "yyyy-MM-dd")
    return drift.dataset_drift(_report(spark, sf_dir, (ref, cur))).join(quality, "batch").withColumn("report_at", at)


@query
def drift_timeline(spark, sf_dir):
    found = drift.drift_timeline(_reports(spark, sf_dir))
    return found.select("report_at", "n_rows", *r6("share_drifted", "share_missing"))


@query
def drift_counters(spark, sf_dir):
    return drift.drift_counters(_reports(spark, sf_dir)).select("rows_seen", *r6("last_share_drifted"))


# ---- streaming


ARRIVALS = 3
HOUR_LATE = 3600


def arrival(ts: Column, event_id: Column, first, step: int) -> Column:
    """In which of the arrivals a row comes: by its time, but every 53rd one arrival late."""
    own = F.least(F.floor(F.timestamp_diff("SECOND", first, ts) / step), F.lit(ARRIVALS - 1))
    return (own + F.when(event_id % 53 == 0, 1).otherwise(0)).cast("int")


@query
def stream_alarms_(spark, sf_dir):
    """The whole event table through the stream, in order of time, some rows late, with what is left at its end."""
    settling, alarms = streamed_alarms(spark, sf_dir, fresh_path(spark, "stream"))
    return alarms(settling.emitted()).unionByName(alarms(settling.remaining())).select("id", "event_id", *r6("score"), "alarm", "late")


def streamed_alarms(spark: SparkSession, sf_dir: str, path: str, **options):
    """Write the events as they arrive, stream them after each arrival; the stream, and its rows to alarms."""
    events = table(spark, sf_dir, "events")
    spec = EVENTS.with_features(*EVENT_FEATURES)
    fitted = stats.stats_values(stats.fit_stats(events_panel(spark, sf_dir), EVENT_FEATURES, is_train()))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = int((last - first).total_seconds()) // ARRIVALS + 1 if first else 1
    zero = F.lit(first).cast(events.schema["ts"].dataType)
    parts = events.withColumn("arrival", arrival(F.col("ts"), F.col("event_id"), zero, step))
    parts.write.partitionBy("arrival").parquet(f"{path}/parts")
    like = events.select(*event_columns())
    settling = Settling(spark, f"{path}/state", like, spec, HOUR_LATE, **options)
    folders.make(spark, f"{path}/arrived")
    stream = spark.readStream.schema(events.schema).parquet(f"{path}/arrived").select(*event_columns())
    arrived = spark.read.schema(events.schema).parquet
    for i in range(ARRIVALS + 1):
        if folders.exists(spark, f"{path}/parts/arrival={i}"):
            arrived(f"{path}/parts/arrival={i}").write.mode("append").parquet(f"{path}/arrived")
            settling.start(stream).awaitTermination()
    return settling, lambda ready: score_rows(ready, spec, fitted, WEIGHTS[:8], BIAS, ALARM)


@query
def stream_alarms_unordered(spark, sf_dir):
    """The whole event table in files of any order: rows wait in the state store for all that the table spans."""
    return drained_alarms(spark, sf_dir, f"{sf_dir}/events.parquet")


def drained_alarms(spark: SparkSession, sf_dir: str, events: str, **options) -> DataFrame:
    """Alarms for the events in ``events``, a file or a folder of files, in whatever order they are read."""
    features = EVENT_FEATURES
    batch = spark.read.parquet(events)
    spec = EVENTS.with_features(*features)
    fitted = stats.stats_values(stats.fit_stats(events_panel(spark, sf_dir), features, is_train()))
    # Files are read in no order of time, so rows wait for all that the table spans.
    span = batch.agg(F.min("ts"), F.max("ts")).first()
    lateness = f"{int((span[1] - span[0]).total_seconds()) + 1} seconds" if span[0] else "1 second"
    # As a pattern, the path may be one file or a folder of files.
    pattern = f"{events[:-1]}[{events[-1]}]"
    arriving = spark.readStream.schema(batch.schema).options(**options).parquet(pattern).select(*event_columns())
    progress, out = fresh_path(spark, "alarms-progress"), fresh_path(spark, "alarms")
    running = (
        stream_alarms(arriving, spec, fitted, WEIGHTS[:8], BIAS, ALARM, lateness=lateness)
        .writeStream.format("parquet")
        .partitionBy("late")
        .option("path", out)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    rest = held_back(spark, progress, batch.select(*event_columns()), spec)
    rest = score_rows(rest, spec, fitted, WEIGHTS[:8], BIAS, ALARM)
    written = spark.read.schema(rest.schema).parquet(out)
    return written.unionByName(rest).select("id", "event_id", *r6("score"), "alarm", "late")
