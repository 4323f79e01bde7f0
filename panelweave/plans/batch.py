"""The work end to end: files to sequences, prepared rows to a logged model, a panel to alarms."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.operators.encode import drop_columns, fit_categories, indicator_names, one_hot
from panelweave.operators.evaluate import binary_metrics, confusion, entity_alarm, predictions_json
from panelweave.operators.history import ffill_trim, limit_entities, min_history, union_panels
from panelweave.operators.sequences import flatten_steps, pad_sequences, to_sequences
from panelweave.operators.stats import fit_stats, impute_and_scale
from panelweave.plans.learn import (
    causal_feature_names, causal_features, log_run, save_model_version, score, train_step_classifier,
)
from panelweave.plans.prepare import prepare_v1
from panelweave.sources.files import read_panel_dir, save_stats
from panelweave.sources.schema import HOUR, HOURLY_SCHEMA, LABEL, STATICS, UNUSED, VITALS_AND_LABS
from panelweave.spec import PanelSpec
from panelweave.workspace import materialise

# Every column but the entity and the label is a feature, the hour included; a copy of the hour keeps the
# order, so scaling does not touch it.
KEPT = 50
HOURLY = PanelSpec("id", ("hour",), (*VITALS_AND_LABS, *STATICS, HOUR), LABEL)


def load_hourly(
    spark: SparkSession, path: str | list[str], entities: int | None = None, schema: T.StructType = HOURLY_SCHEMA
) -> DataFrame:
    """Scan hourly entity files, optionally of the ``entities`` smallest ids only."""
    panel = read_panel_dir(spark, path, schema).withColumn("hour", F.col(HOUR))
    return panel if entities is None else limit_entities(panel, HOURLY, entities)


def prepare_hourly(
    train: DataFrame, test: DataFrame, stats_path: str | None = None
) -> tuple[DataFrame, PanelSpec]:
    """Drop the unit columns, encode gender, forward-fill, trim, fill and scale both panels by train.

    The result carries column ``split``, and its spec the bound on the rows of an entity. Entity ids of the two panels must not overlap. With ``stats_path``
    the fitted statistics are saved there first and read back, for scoring later.
    """
    both = union_panels(train.withColumn("split", F.lit("train")), test.withColumn("split", F.lit("test")))
    is_train = F.col("split") == "train"
    # The text is parsed once; what follows reads only the columns it needs from the written table.
    landed = materialise(drop_columns(both, UNUSED), "hourly")
    categories = fit_categories(landed.where(is_train), "Gender")
    names = indicator_names("Gender", categories)
    panel = one_hot(landed, "Gender", categories)
    spec = HOURLY.without(*UNUSED).encoded("Gender", names)
    if stats_path is None:
        return prepare_v1(panel, spec, is_train, keep=KEPT), spec.bounded(KEPT)
    trimmed = materialise(ffill_trim(panel, spec, keep=KEPT), "trimmed")
    save_stats(fit_stats(trimmed, spec.features, is_train), stats_path)
    saved = train.sparkSession.read.parquet(stats_path)
    return impute_and_scale(trimmed, spec.features, saved), spec.bounded(KEPT)


def padded_sequences(
    prepared: DataFrame, spec: PanelSpec, max_len: int = 50, min_len: int = 15, side: str = "pre"
) -> DataFrame:
    """Prepared histories as dense sequences of equal length."""
    return pad_sequences(to_sequences(prepared, spec, max_len, min_len), len(spec.features), max_len, side)


def train_and_evaluate(
    prepared: DataFrame,
    spec: PanelSpec,
    threshold: float = 0.5,
    algo: str = "gbt",
    rows: int = 6,
    runs_path: str | None = None,
    models_path: str | None = None,
    **params,
) -> tuple[PipelineModel, DataFrame]:
    """Fit the step classifier on split ``train`` and evaluate every split of the prepared rows.

    Gives the model and one row of counts and metrics per split. With ``runs_path`` the run is logged with its
    parameters and metrics, with ``models_path`` the model is saved as a new version.
    """
    spark = prepared.sparkSession
    # Written once: the fit and the scores read the same rows.
    wide = materialise(causal_features(prepared, spec, rows), "wide")
    names = causal_feature_names(spec, rows)
    model = train_step_classifier(wide.where(F.col("split") == "train"), names, spec.label, algo, **params)
    counts = confusion(score(wide, model), threshold, label=spec.label, by=["split"])
    metrics = materialise(binary_metrics(counts), "metrics")
    if runs_path is not None:
        found = {
            f"{row['split']}_{name}": row[name] for row in metrics.collect() for name in ("sensitivity", "f1")
        }
        used = {"algo": algo, "rows": rows, "threshold": threshold, **params}
        log_run(spark, runs_path, uuid.uuid4().hex, used, found)
    if models_path is not None:
        save_model_version(spark, model, models_path)
    return model, metrics


def score_steps(prepared: DataFrame, spec: PanelSpec, model: PipelineModel, rows: int = 6) -> DataFrame:
    """Prepared rows with the probability a step classifier gives them, in column ``score``."""
    wide = score(causal_features(prepared, spec, rows), model)
    return wide.select(*prepared.columns, "score")


def predict_alarms(
    panel: DataFrame,
    spec: PanelSpec,
    stats: DataFrame | dict | None,
    step_score: Column | Callable[[DataFrame], DataFrame],
    threshold: float,
    max_len: int = 50,
    min_len: int = 15,
) -> DataFrame:
    """Score a panel and give one JSON prediction per entity: (entity, prediction).

    ``stats`` are saved training statistics; None fits them on the scored panel itself. ``step_score`` is a
    column over the feature vector ``x`` of a padded step, or a function that adds column ``score`` to
    prepared rows.
    """
    prepared = prepare_v1(panel, spec, stats=stats)
    if callable(step_score) and not isinstance(step_score, Column):
        scored = step_score(min_history(prepared, spec, min_len))
    else:
        padded = padded_sequences(prepared, spec, max_len, min_len)
        scored = flatten_steps(padded, spec.entity, max_len).withColumn("score", step_score)
    return predictions_json(entity_alarm(scored, spec.entity, threshold), spec.entity)
