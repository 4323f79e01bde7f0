"""Scoring entities continuously."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from panelweave.operators.evaluate import binarise
from panelweave.operators.stats import impute_and_scale
from panelweave.plans.score import linear_score
from panelweave.spec import PanelSpec

_PLACES, _VALUES = "array<array<bigint>>", "array<array<double>>"
#: Rows not yet settled, filled rows held back, the last known values and the newest settled clock.
_STATE = f"held_at {_PLACES}, held {_VALUES}, waiting_at {_PLACES}, waiting {_VALUES}, last array<double>, newest bigint"
_CLOCK = "__clock"


def _micros(df: DataFrame, clock: str) -> Column:
    if isinstance(df.schema[clock].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(clock))
    return F.unix_micros(clock)


def _from_micros(kind: T.DataType, column: str) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", F.col(column), F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.timestamp_micros(column)


def _advance(saved: tuple | None, rows: list[tuple], settled: float, delay: int, width: int) -> tuple[tuple, list[tuple]]:
    """The state after more ``rows`` (place, values), and the rows that leave it.

    Rows with a clock before ``settled`` are taken in order, once each, and filled; all but the newest ``delay`` of them leave.
    """
    held_at, held, waiting_at, waiting, last, newest = saved or ([], [], [], [], [None] * width, None)
    known = {tuple(at): list(values) for at, values in zip(held_at, held)}
    for at, values in rows:
        known.setdefault(tuple(at), values)
    ready = [(list(at), list(values)) for at, values in zip(waiting_at, waiting)]
    last, later = list(last), []
    for at in sorted(known):
        if at[0] >= settled:
            later.append(at)
            continue
        last = [new if new is not None else old for new, old in zip(known[at], last)]
        newest = at[0]
        ready.append((list(at), last))
    out, kept = ready[: max(len(ready) - delay, 0)], ready[max(len(ready) - delay, 0) :]
    state = ([list(at) for at in later], [known[at] for at in later], [at for at, _ in kept], [v for _, v in kept], last, newest)
    return state, out


def _frame(entity: object, rows: list[tuple], late: bool, names: Sequence[str]) -> pd.DataFrame:
    columns = list(zip(*[(entity, *at, *values, late) for at, values in rows]))
    return pd.DataFrame(dict(zip(names, columns)))


def _result(df: DataFrame, spec: PanelSpec) -> tuple[T.StructType, list[str]]:
    fields = [T.StructField(spec.entity, df.schema[spec.entity].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in spec.order] + [T.StructField(c, T.DoubleType()) for c in spec.features]
    schema = T.StructType([*fields, T.StructField("late", T.BooleanType())])
    return schema, schema.fieldNames()


def _with_types(rows: DataFrame, schema: T.StructType, spec: PanelSpec) -> DataFrame:
    clock, *others = spec.order
    typed = [F.col(c).cast(schema[c].dataType).alias(c) for c in others]
    return rows.select(spec.entity, _from_micros(schema[clock].dataType, clock).alias(clock), *typed, *spec.features, "late")


def fill_and_delay(
    stream: DataFrame,
    spec: PanelSpec,
    delay: int = 5,
    lateness: str = "1 hour",
    poll_ms: int | None = None,
    expire_after_ms: int | None = None,
) -> DataFrame:
    """Forward-fill each entity's stream and hold back its newest ``delay`` rows.

    The first order column must be a timestamp and the others integers. A row stays in state until the watermark,
    ``lateness`` behind the newest row of the stream, has passed it, so the result does not depend on the order in which
    rows arrive within that time, nor on how they are cut into micro-batches. A row that arrives behind the watermark
    leaves at once as it came, with ``late`` true; write these to a place of their own. Rows of one place in the
    order count once. Without ``poll_ms`` the rows of an entity leave with its next micro-batch or by ``held_back``; with it,
    entities with rows in state are looked at again after that time, which suits a stream that goes on (one that stops
    when its input is read would wait for itself). With ``expire_after_ms`` as well, the state of an entity without
    unsettled rows goes away once the watermark is that far past its newest row.

    State per entity is the rows of the last ``lateness``, ``delay`` rows and one vector; ``held_back`` reads what is
    left when a stream has ended.
    """
    clock = spec.order[0]
    order, features = list(spec.order), list(spec.features)
    schema, names = _result(stream, spec)
    width = len(features)

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs() * 1000
        rows, late = [], []
        if not state.hasTimedOut:
            for chunk in chunks:
                places = chunk[[_CLOCK, *order[1:]]].astype("int64").values.tolist()
                values = chunk[features].astype("float64").values.tolist()
                for at, row in zip(places, values):
                    row = [None if v != v else v for v in row]
                    (late if at[0] < watermark else rows).append((at, row))
        saved = state.get if state.exists else None
        after, out = _advance(saved, rows, watermark, delay, width)
        if late:
            yield _frame(key[0], late, True, names)
        if out:
            yield _frame(key[0], out, False, names)
        idle = not after[0] and (after[5] is None or expire_after_ms is not None and watermark >= after[5] + expire_after_ms * 1000)
        if idle:
            if state.exists:
                state.remove()
            return
        state.update(after)
        if poll_ms is not None and (after[0] or expire_after_ms is not None):
            state.setTimeoutDuration(poll_ms)

    # A watermark takes timestamps with a zone only.
    timed = stream.withColumn(_CLOCK, _micros(stream, clock)).withColumn("__event", F.timestamp_micros(_CLOCK))
    wanted = timed.withWatermark("__event", lateness).select(
        spec.entity,
        "__event",
        _CLOCK,
        *[F.col(c).cast("long").alias(c) for c in order[1:]],
        *[F.col(c).cast("double").alias(c) for c in features],
    )
    timeout = GroupStateTimeout.NoTimeout if poll_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    found = wanted.groupBy(spec.entity).applyInPandasWithState(step, schema, T.StructType.fromDDL(_STATE), "append", timeout)
    return _with_types(found, stream.schema, spec)


def held_back(spark: SparkSession, checkpoint: str, like: DataFrame, spec: PanelSpec, delay: int = 5) -> DataFrame:
    """What ``fill_and_delay`` would still give if the stream that wrote ``checkpoint`` ended now.

    ``like`` is a DataFrame with the stream's columns. Each entity's state is one row, read from the state store.
    """
    schema, names = _result(like, spec)
    width = len(spec.features)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for entity, *saved in frame.itertuples(index=False, name=None):
                plain = [[list(row) for row in part] for part in saved[:4]]
                plain = [[[None if v is None or v != v else v for v in row] for row in part] for part in plain]
                last = [None if v is None or v != v else float(v) for v in saved[4]]
                _, out = _advance((*plain, last, None), [], float("inf"), delay, width)
                if out:
                    yield _frame(entity, out, False, names)

    state = spark.read.format("statestore").load(checkpoint)
    value = "value.groupState" if "groupState" in state.schema["value"].dataType.fieldNames() else "value"
    parts = [F.col(f"{value}.{c}").alias(c) for c in T.StructType.fromDDL(_STATE).fieldNames()[:5]]
    rows = state.select(F.col(f"key.{state.schema['key'].dataType.fieldNames()[0]}").alias(spec.entity), *parts)
    return _with_types(rows.mapInPandas(run, schema), like.schema, spec)


def score_rows(
    ready: DataFrame, spec: PanelSpec, stats: dict, weights: Sequence[float], bias: float, threshold: float
) -> DataFrame:
    """Score filled rows with saved statistics and raise an alarm at the threshold: column expressions only."""
    filled = impute_and_scale(ready, spec.features, stats)
    scored = filled.withColumn("score", linear_score(spec.features, weights, bias))
    return scored.select(*spec.keys, "score", binarise("score", threshold).alias("alarm"), "late")


def stream_alarms(
    stream: DataFrame,
    spec: PanelSpec,
    stats: dict,
    weights: Sequence[float],
    bias: float,
    threshold: float,
    delay: int = 5,
    lateness: str = "1 hour",
    poll_ms: int | None = None,
    expire_after_ms: int | None = None,
) -> DataFrame:
    """Score every row of a stream with saved statistics and raise an alarm at the threshold.

    Only the fill and the delay need state. A drained stream, with ``score_rows(held_back(...))``, gives what the
    batch operators give, less the cut to the newest rows, which is only known at the end of the data.
    """
    ready = fill_and_delay(stream, spec, delay, lateness, poll_ms, expire_after_ms)
    return score_rows(ready, spec, stats, weights, bias, threshold)
