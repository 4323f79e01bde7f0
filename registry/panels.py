"""Panels derived from the given tables, each as a DataFrame and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.operators.skew import running_totals
from panelweave.operators.split import hash_split
from panelweave.sources.schema import HOUR, HOURLY_SCHEMA, LABEL
from panelweave.spec import PanelSpec

CHANNELS = ("view", "click", "error", "purchase", "signup")
EVENT_FEATURES = (*[f"v_{c}" for c in CHANNELS], "v_empty", "v_const", "grp")
EVENTS = PanelSpec("id", ("ts", "event_id"), EVENT_FEATURES, "label")
ORDERS = PanelSpec("id", ("o_orderdate", "o_orderkey"), ("p_urgent", "p_low", "p_total"), "label")
SHARES = {"train": 67, "test": 33}

# Features after `grp` became indicators, with weights for a fixed linear score.
ENCODED = (*EVENT_FEATURES[:-1], "grp_0", "grp_1")
WEIGHTS = (0.8, -0.6, 2.5, 0.4, -0.9, 0.3, 0.2, -0.1, 0.1)
BIAS = -1.0
ALARM = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_columns() -> list:
    """The panel columns made from an event row."""
    value = F.col("value")
    return [
        F.col("user_id").alias("id"),
        F.col("ts"),
        F.col("event_id"),
        *[F.when(F.col("event_type") == c, value).alias(f"v_{c}") for c in CHANNELS],
        F.lit(None).cast("double").alias("v_empty"),
        F.lit(7.0).alias("v_const"),
        (F.col("user_id") % 2).cast("int").alias("grp"),
        F.when((F.col("event_type") == "error") & (value > 80), 1).otherwise(0).alias("label"),
    ]


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse channels and long histories, with a split by entity."""
    return hash_split(table(spark, sf_dir, "events").select(*event_columns()), "id", SHARES)


HOURLY_OF = {"HR": "v_view", "O2Sat": "v_click", "Temp": "v_error", "SBP": "v_purchase", "MAP": "v_signup"}
HOURLY_SEEN = (*HOURLY_OF, "Age", "Gender_0", "Gender_1", HOUR)


def hourly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the hourly schema: channels as vitals, the number of an entity's row as its hour."""
    rows = events_panel(spark, sf_dir).withColumn("__one", F.lit(1))
    numbered = running_totals(rows, ["id"], EVENTS.order, {HOUR: "__one"})
    made = {c: F.col(v) for c, v in HOURLY_OF.items()}
    made |= {"Age": 50 + F.col("id") % 40, "Gender": F.col("grp"), HOUR: F.col(HOUR), LABEL: F.col("label")}
    fields = [made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in HOURLY_SCHEMA]
    return numbered.select("id", "split", *fields)


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short and uneven histories."""
    priority, price, status = F.col("o_orderpriority"), F.col("o_totalprice"), F.col("o_orderstatus")
    panel = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        "o_orderdate",
        "o_orderkey",
        F.when(priority.startswith("1"), price).alias("p_urgent"),
        F.when(priority.startswith("5"), price).alias("p_low"),
        price.alias("p_total"),
        status.alias("status"),
        F.when(status == "F", 1).otherwise(0).alias("label"),
    )
    return hash_split(panel, "id", SHARES)


TYPES = PanelSpec("id", ("ts", "event_id"), ("w_some", "w_rare", "w_all"), "label")


def types_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Few entities that each hold a large share of all rows, and the rows one task may take of an entity."""
    value = F.col("value")
    panel = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("id"),
        "ts",
        "event_id",
        F.when(value >= 60, value).alias("w_some"),
        F.when(value >= 200, value).alias("w_rare"),
        value.alias("w_all"),
        F.when(value > 80, 1).otherwise(0).alias("label"),
    )
    return panel, -(-panel.count() // 64)


def drift_samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference rows (entities of train) and current rows (the others), before batching."""
    rows = hash_split(
        table(spark, sf_dir, "events").select(*event_columns(), "value", "event_type"), "id", SHARES
    )
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


SPLIT_SQL = (
    "CASE WHEN CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 7) AS BIGINT) % 100 < 67 "
    "THEN 'train' ELSE 'test' END"
)

_channels_sql = ",\n       ".join(
    f"CASE WHEN event_type = '{c}' THEN value END AS v_{c}" for c in CHANNELS
)
EVENTS_SQL = f"""p AS (
SELECT user_id AS id, ts, event_id, value, event_type,
       {_channels_sql},
       CAST(NULL AS DOUBLE) AS v_empty, CAST(7 AS DOUBLE) AS v_const, CAST(user_id % 2 AS INT) AS grp,
       CASE WHEN event_type = 'error' AND value > 80 THEN 1 ELSE 0 END AS label,
       {SPLIT_SQL.format(key="user_id")} AS split
FROM events)"""

TYPES_SQL = """p AS (
SELECT event_type AS id, ts, event_id, CASE WHEN value >= 60 THEN value END AS w_some,
       CASE WHEN value >= 200 THEN value END AS w_rare, value AS w_all,
       CASE WHEN value > 80 THEN 1 ELSE 0 END AS label
FROM events)"""

_hourly_sql = ", ".join(f"{v} AS {c}" for c, v in HOURLY_OF.items())
HOURLY_SQL = f"""h AS (
SELECT id, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS {HOUR}, count(*) OVER (PARTITION BY id) AS n,
       {_hourly_sql}, 50 + id % 40 AS Age, 1 - grp AS Gender_0, grp AS Gender_1, label, split
FROM p)"""

ORDERS_SQL = f"""o AS (
SELECT o_custkey AS id, o_orderdate, o_orderkey,
       CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice END AS p_urgent,
       CASE WHEN o_orderpriority LIKE '5%' THEN o_totalprice END AS p_low,
       o_totalprice AS p_total, o_orderstatus AS status,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
       {SPLIT_SQL.format(key="o_custkey")} AS split
FROM orders)"""
