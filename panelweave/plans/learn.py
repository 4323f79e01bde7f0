"""Learning on panels with Spark ML, and keeping runs and models."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.operators.skew import cut_hot_groups, rows_per_group, running_totals
from panelweave.sources import folders
from panelweave.spec import PanelSpec
from panelweave.workspace import materialise


def _training_rows(rows: DataFrame, name: str) -> DataFrame:
    """The rows to learn from, written once, as fitting passes over its input several times."""
    written = materialise(rows, name)
    if written.isEmpty():
        raise ValueError("there is no row to learn from")
    return written


def feature_importance(
    train: DataFrame, spec: PanelSpec, trees: int = 100, depth: int = 5, seed: int = 42
) -> DataFrame:
    """(feature, importance) of a random forest fitted on the training rows, most important first."""
    rows = _training_rows(
        train.select(*spec.features, F.col(spec.label).cast("double").alias("__y")), "forest-rows"
    )
    assembled = VectorAssembler(inputCols=list(spec.features), outputCol="__x").transform(rows)
    forest = RandomForestClassifier(
        featuresCol="__x", labelCol="__y", numTrees=trees, maxDepth=depth, seed=seed
    )
    importances = forest.fit(assembled).featureImportances
    rows = [(c, float(importances[i])) for i, c in enumerate(spec.features)]
    schema = "feature string, importance double"
    return train.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature")


def important_features(importance: DataFrame, threshold: float = 0.005) -> list[str]:
    """Features whose importance exceeds the threshold; one row per feature comes to the driver."""
    return [r["feature"] for r in importance.where(F.col("importance") > threshold).collect()]


def select_features(
    train: DataFrame, others: list[DataFrame], spec: PanelSpec, threshold: float = 0.005, **forest
) -> tuple[list[DataFrame], PanelSpec]:
    """Drop the features of low importance from the training panel and from every other panel."""
    wanted = set(important_features(feature_importance(train, spec, **forest), threshold))
    low = [c for c in spec.features if c not in wanted]
    return [frame.drop(*low) for frame in (train, *others)], spec.without(*low)


def causal_feature_names(spec: PanelSpec, rows: int = 6) -> list[str]:
    made = [f"{c}_{kind}" for c in spec.features for kind in ("delta", f"avg{rows}", f"min{rows}", f"max{rows}")]
    return [*spec.features, *made]


def causal_features(
    df: DataFrame, spec: PanelSpec, rows: int = 6, group_rows: int | None = None
) -> DataFrame:
    """Add to each row what a one-directional model could know: change and rolling mean, min and max.

    Oversized entities are numbered, cut into blocks of equal length, and each block gets a copy of the few
    rows before it, so its windows see all they need.
    """

    def made(previous, recent) -> list[Column]:
        out = []
        for c in spec.features:
            out += [
                (F.col(c) - F.lag(c).over(previous)).alias(f"{c}_delta"),
                F.avg(c).over(recent).alias(f"{c}_avg{rows}"),
                F.min(c).over(recent).alias(f"{c}_min{rows}"),
                F.max(c).over(recent).alias(f"{c}_max{rows}"),
            ]
        return out

    names = [*df.columns, *causal_feature_names(spec, rows)[len(spec.features) :]]
    cut = cut_hot_groups(df, [spec.entity], spec.order, group_rows, spec.max_history)
    if cut is None:
        w = Window.partitionBy(spec.entity).orderBy(*spec.order)
        return df.select("*", *made(w, w.rowsBetween(1 - rows, 0)))

    size = max(rows, rows_per_group(df, df.count(), group_rows))
    one = F.lit(1).cast("bigint")
    numbered = running_totals(
        df.withColumn("__one", one), [spec.entity], spec.order, {"__at": "__one"},
        cut=cut.withColumn("__one", one),
    )
    home = F.floor((F.col("__at") - 1) / size).cast("bigint")
    needed_next = (F.col("__at") - 1) % size >= size - max(rows - 1, 1)
    copies = F.when(needed_next, F.array(home, home + 1)).otherwise(F.array(home))
    spread = numbered.withColumn("__home", home).withColumn("__block", F.explode(copies))
    w = Window.partitionBy(spec.entity, "__block").orderBy("__at")
    return (
        spread.select("*", *made(w, w.rowsBetween(1 - rows, 0)))
        .where(F.col("__block") == F.col("__home"))
        .select(*names)
    )


def train_step_classifier(
    train: DataFrame, features: list[str], label: str, algo: str = "gbt", **params
) -> PipelineModel:
    """Fit a per-step binary classifier on prepared rows; a null feature (such as the change in the first row
    of a history) counts as 0, in training and in scoring."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="__x")
    common = {"featuresCol": "__x", "labelCol": "__y"}
    if algo == "gbt":
        model = GBTClassifier(**common, **{"maxIter": 20, "maxDepth": 4, "seed": 42, **params})
    elif algo == "logreg":
        model = LogisticRegression(**common, **{"maxIter": 50, "regParam": 1e-4, **params})
    else:
        raise ValueError(f"unknown classifier {algo!r}")
    rows = train.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features],
        F.col(label).cast("double").alias("__y"),
    )
    return Pipeline(stages=[assembler, model]).fit(_training_rows(rows, "training-rows"))


def score(panel: DataFrame, model: PipelineModel, output: str = "score") -> DataFrame:
    """Add the probability of the positive class to every row; the model reads nulls as 0, the rows keep them."""
    inputs = model.stages[0].getInputCols()
    known = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in inputs]
    scored = model.transform(panel.select(F.struct(*panel.columns).alias("__row"), *known))
    return scored.select("__row.*", F.get(vector_to_array("probability"), F.lit(1)).alias(output))


def exchanged(df: DataFrame, keys: Sequence[str], columns: Sequence[str], by: str, cell_rows: int = 1000) -> DataFrame:
    """``df`` with ``<column>__other``: the value of another row of the same part, for each column.

    Rows are dealt into cells of about ``cell_rows`` by a hash of their key, and in a cell each row takes the value of the next one in
    an order by another hash, the last one that of the first. No sort goes beyond a cell, and the same rows are exchanged under
    any partitioning as long as keys are unique.
    """
    cells = max(1, df.count() // cell_rows)
    dealt = df.withColumn("__cell", F.pmod(F.xxhash64(*keys), F.lit(cells)))
    made = []
    for i, c in enumerate(columns):
        order = Window.partitionBy(by, "__cell").orderBy(F.xxhash64(*keys, F.lit(i)), *keys)
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # In a struct, so that a null value is not taken for the end of the cell.
        following = F.coalesce(F.lead(F.struct(c)).over(order), F.first(F.struct(c)).over(whole))
        made.append(following[c].alias(f"{c}__other"))
    return dealt.select(*df.columns, *made)


def permutation_importance(
    panel: DataFrame, model: PipelineModel, keys: Sequence[str], label: str, by: str = "split", cell_rows: int = 1000
) -> DataFrame:
    """(by, feature, loss, importance): the mean negative log-likelihood of the labels, and how much it rises when the values of one
    feature are exchanged between rows of the same part. A constant feature has exactly 0. Rows without a label are left out."""
    features = list(model.stages[0].getInputCols())
    known = panel.where(F.col(label).isNotNull()).select(by, *keys, F.col(label).cast("double").alias("__y"), *features)
    wide = materialise(exchanged(known, keys, features, by, cell_rows), "exchanged")

    def loss(of: DataFrame, feature: str | None) -> DataFrame:
        chance = F.least(F.greatest(F.col("__score"), F.lit(1e-15)), F.lit(1 - 1e-15))
        value = -(F.col("__y") * F.ln(chance) + (1 - F.col("__y")) * F.ln(1 - chance))
        # Rounded, so that sums of the same numbers in another order are the same.
        mean = F.round(F.avg(value), 12).alias("loss")
        return score(of, model, "__score").groupBy(by).agg(mean).withColumn("feature", F.lit(feature).cast("string"))

    parts = [loss(wide, None)]
    for c in features:
        parts.append(loss(wide.drop(c).withColumnRenamed(f"{c}__other", c), c))
    losses = materialise(reduce(DataFrame.unionByName, parts), "losses")
    own = losses.where("feature is null").select(F.col(by).alias("__by"), F.col("loss").alias("__own"))
    both = losses.where("feature is not null").join(own, F.col(by).eqNullSafe(F.col("__by")))
    return both.select(by, "feature", F.col("__own").alias("loss"), (F.col("loss") - F.col("__own")).alias("importance"))


RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("logged_at", T.TimestampType(), False),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def log_run(
    spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict, at: datetime | None = None
) -> None:
    """Append one run with its parameters and metrics to the run table at ``path``."""
    row = (
        run_id,
        at or datetime.now(timezone.utc),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
    )
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


# Fixed value: the name of a version's folder, by which models saved earlier are found.
VERSION, STAMP = "version_", "%Y%m%d%H%M%S"
_MANIFEST = "_manifest.json"


def _lengths(spark: SparkSession, path: str) -> dict[str, int]:
    return {name: n for name, n in folders.files(spark, path) if not name.rpartition("/")[2].startswith(("_", "."))}


def _contents(spark: SparkSession, path: str) -> dict[str, list]:
    """Length and SHA-256 of each data file of a model; the files are read by Spark, a few rows come to the driver."""
    lengths = _lengths(spark, path)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = read.select(F.col("path"), F.sha2("content", 256).alias("digest")).collect()
    at, fs = folders.place(spark, path)
    top = fs.makeQualified(at).toUri().getPath().rstrip("/") + "/"
    digests = {r["path"].partition(top)[2]: r["digest"] for r in found}
    return {name: [n, digests.get(name)] for name, n in lengths.items()}


def save_model_version(spark: SparkSession, model, base: str, at: datetime | None = None) -> str:
    """Publish a fitted model as ``<base>/version_<yyyymmddHHMMSS>`` and return that path.

    The model is written under a hidden name, with a manifest of its files, and renamed when it is whole, so a version is there
    or not. Of two writers in one second the later one's version gets a number behind its name, and sorts after the other's.
    """
    base = base.rstrip("/")
    stamp = VERSION + (at or datetime.now(timezone.utc)).strftime(STAMP)
    hidden = f"{base}/.{stamp}-{uuid.uuid4().hex}"
    model.write().save(hidden)
    folders.write_text(spark, f"{hidden}/{_MANIFEST}", json.dumps(_contents(spark, hidden)))
    for i in range(1000):
        name = stamp if not i else f"{stamp}_{i:03d}"
        # Only one writer can make the mark of a name.
        if not folders.exists(spark, f"{base}/{name}") and folders.claim(spark, f"{base}/.{name}.taken"):
            if folders.rename(spark, hidden, f"{base}/{name}"):
                return f"{base}/{name}"
    raise OSError(f"cannot publish {hidden}")


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a version has all files of its manifest, unchanged.

    A version from before there were manifests is whole if its own writer finished: the metadata, and those of each stage of a pipeline.
    """
    if folders.exists(spark, f"{path}/{_MANIFEST}"):
        told = json.loads(folders.read_text(spark, f"{path}/{_MANIFEST}"))
        return _lengths(spark, path) == {name: n for name, (n, _) in told.items()} and _contents(spark, path) == told
    if not folders.exists(spark, f"{path}/metadata/_SUCCESS"):
        return False
    told = json.loads("".join(r["value"] for r in spark.read.text(f"{path}/metadata").collect()))
    stages = told.get("paramMap", {}).get("stageUids", [])
    finished = {name.partition("_")[2] for name in folders.names(spark, f"{path}/stages") if folders.exists(spark, f"{path}/stages/{name}/metadata/_SUCCESS")}
    return set(stages) <= finished


def latest_model_version(spark: SparkSession, base: str) -> str:
    """The whole version with the greatest name; unfinished and damaged ones are passed over. An error if there is none."""
    base = base.rstrip("/")
    if not folders.exists(spark, base):
        raise FileNotFoundError(f"no model folder {base}")
    for name in reversed([n for n in folders.names(spark, base) if n.startswith(VERSION)]):
        if is_whole(spark, f"{base}/{name}"):
            return f"{base}/{name}"
    raise FileNotFoundError(f"no model versions in {base}")


def load_latest_model(spark: SparkSession, base: str) -> PipelineModel:
    return PipelineModel.load(latest_model_version(spark, base))
