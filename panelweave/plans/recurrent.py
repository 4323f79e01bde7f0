"""A recurrent step classifier: it sees the whole history of an entity, one direction in time.

One layer of long short-term memory and a logistic output for every step, fitted by the gradient of the whole training set. Spark
holds the sequences; each task walks its own in blocks, back-propagates through at most ``truncate`` steps, and gives one
row of gradient sums, whose size is that of the model. The driver adds up nothing but that and takes the step. A step that would raise
the loss is taken back and tried at half its length, so the likelihood rises with every epoch that is kept.

A null or NaN input counts as 0, a step with a null label teaches nothing, a sequence without steps is passed over. Order of rows and
partitioning change a fit by rounding only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.workspace import materialise

#: Sequences walked at once in a task.
BLOCK = 256


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class StepModel:
    """``weights`` of (inputs, hidden, 1) to the four gates, ``output`` of (hidden, 1) to the logit."""

    weights: np.ndarray
    output: np.ndarray
    #: Mean negative log-likelihood a step, of every epoch kept.
    losses: tuple[float, ...] = ()

    @property
    def hidden(self) -> int:
        return len(self.output) - 1

    @property
    def inputs(self) -> int:
        return len(self.weights) - self.hidden - 1

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights.ravel(), self.output])

    def with_flat(self, values: np.ndarray) -> StepModel:
        n = self.weights.size
        return replace(self, weights=values[:n].reshape(self.weights.shape), output=values[n:])


def start(inputs: int, hidden: int, seed: int = 0) -> StepModel:
    """Small random weights; at first the forget gate is open and the input gate nearly closed, so that what enters is remembered."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(0, 1 / np.sqrt(inputs + hidden), (inputs + hidden + 1, 4 * hidden))
    weights[-1] = 0
    weights[-1, :hidden], weights[-1, hidden : 2 * hidden] = -2, 4
    return StepModel(weights, np.append(rng.normal(0, 1 / np.sqrt(hidden), hidden), 0.0))


def _forward(model: StepModel, x: np.ndarray, h: np.ndarray, c: np.ndarray):
    """All steps of ``x`` (sequence, step, input) from a state; what each step leaves for the way back."""
    k, trail = model.hidden, []
    for t in range(x.shape[1]):
        seen = np.column_stack([x[:, t], h, np.ones(len(x))])
        gates = seen @ model.weights
        i, f, o = (_sigmoid(gates[:, j * k : (j + 1) * k]) for j in (0, 1, 2))
        g = np.tanh(gates[:, 3 * k :])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        trail.append((seen, i, f, o, g, before, squashed, h))
    return trail, h, c


def _logits(model: StepModel, trail: list) -> np.ndarray:
    return np.stack([step[-1] @ model.output[:-1] + model.output[-1] for step in trail], axis=1)


def gradient(model: StepModel, x: np.ndarray, y: np.ndarray, known: np.ndarray, truncate: int) -> tuple[float, int, np.ndarray]:
    """Summed negative log-likelihood of the known steps, their number, and its gradient through at most ``truncate`` steps."""
    k = model.hidden
    h, c = np.zeros((len(x), k)), np.zeros((len(x), k))
    loss, on_weights, on_output = 0.0, np.zeros_like(model.weights), np.zeros_like(model.output)
    for at in range(0, x.shape[1], truncate):
        part = slice(at, at + truncate)
        trail, h, c = _forward(model, x[:, part], h, c)
        z, mask = _logits(model, trail), known[:, part]
        loss += float((mask * (np.logaddexp(0, z) - y[:, part] * z)).sum())
        off = mask * (_sigmoid(z) - y[:, part])
        dh, dc = np.zeros_like(h), np.zeros_like(c)
        for t in range(len(trail) - 1, -1, -1):
            seen, i, f, o, g, before, squashed, out = trail[t]
            on_output[:-1] += off[:, t] @ out
            on_output[-1] += off[:, t].sum()
            dh = dh + np.outer(off[:, t], model.output[:-1])
            dc = dc + dh * o * (1 - squashed**2)
            gates = np.column_stack([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)])
            on_weights += seen.T @ gates
            dh, dc = (gates @ model.weights.T)[:, model.inputs : -1], dc * f
    return loss, int(known.sum()), np.concatenate([on_weights.ravel(), on_output])


def _blocks(x: pa.Array, y: pa.Array | None, inputs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Sequences laid side by side, padded to the longest: inputs, labels, which are known, lengths."""
    for at in range(0, len(x), BLOCK):
        rows = [np.nan_to_num(np.array(s or [], float).reshape(-1, inputs), nan=0.0) for s in x.slice(at, BLOCK).to_pylist()]
        lengths = np.array([len(r) for r in rows])
        longest = int(lengths.max(initial=0))
        wide, label, known = np.zeros((len(rows), longest, inputs)), np.zeros((len(rows), longest)), np.zeros((len(rows), longest), bool)
        for i, r in enumerate(rows):
            wide[i, : len(r)] = r
        if y is not None:
            for i, s in enumerate(y.slice(at, BLOCK).to_pylist()):
                own = np.array([np.nan if v is None else v for v in (s or [])[: lengths[i]]], float)
                label[i, : len(own)], known[i, : len(own)] = np.nan_to_num(own), ~np.isnan(own)
        yield wide, label, known, lengths


def _sums(model: StepModel, truncate: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, n, total = 0.0, 0, np.zeros(model.flat().size)
        for batch in batches:
            for x, y, known, _ in _blocks(batch.column(0), batch.column(1), model.inputs):
                found = gradient(model, x, y, known, truncate)
                loss, n, total = loss + found[0], n + found[1], total + found[2]
        if n:
            values = np.concatenate([total, [loss, n]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    return run


def _totals(rows: DataFrame, model: StepModel, truncate: int) -> tuple[float, np.ndarray]:
    """Mean loss and gradient over all rows: as many numbers as the model has, and two."""
    sums = rows.mapInArrow(_sums(model, truncate), "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    found = {r["at"]: r["value"] for r in sums.collect()}
    if not found:
        raise ValueError("there is no row to learn from")
    values = np.array([found[i] for i in range(len(found))])
    return values[-2] / values[-1], values[:-2] / values[-1]


def fit(
    packed: DataFrame, inputs: int, hidden: int = 8, epochs: int = 40, rate: float = 0.05, truncate: int = 50, seed: int = 0,
    x: str = "x", y: str = "y",
) -> StepModel:
    """Fit on sequences as ``operators.sequences.to_sequences`` packs them; each epoch is one pass over them."""
    # Every epoch is one pass, so all cores share it, however few files the sequences came in.
    parts = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(packed.select(x, y).repartition(parts), "training-sequences")
    model = start(inputs, hidden, seed)
    loss, slope = _totals(rows, model, truncate)
    losses, first, second, steps = [loss], 0.0, 0.0, 0
    for _ in range(epochs):
        first_next, second_next = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        steps += 1
        step = (first_next / (1 - 0.9**steps)) / (np.sqrt(second_next / (1 - 0.99**steps)) + 1e-8)
        tried = model.with_flat(model.flat() - rate * step)
        loss, tried_slope = _totals(rows, tried, truncate)
        if loss < losses[-1]:
            model, slope, first, second = tried, tried_slope, first_next, second_next
            losses.append(loss)
            rate *= 1.1
        else:
            # From here again, without the momentum that led astray.
            rate, first, second, steps = rate / 2, 0.0, 0.0, 0
    return replace(model, losses=tuple(map(float, losses)))


def score(packed: DataFrame, model: StepModel, x: str = "x", output: str = "scores") -> DataFrame:
    """Add the probability of every step to the sequences, as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for wide, _, _, lengths in _blocks(batch.column(x), None, model.inputs):
                if wide.shape[1]:
                    none = np.zeros((len(wide), model.hidden))
                    chance = _sigmoid(_logits(model, _forward(model, wide, none, none)[0]))
                else:
                    chance = np.zeros((len(wide), 0))
                found += [row[:n] for row, n in zip(chance, lengths)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.float64()))], [*batch.schema.names, output])

    return packed.mapInArrow(run, packed.select("*", F.lit(None).cast("array<double>").alias(output)).schema)


def save(spark: SparkSession, model: StepModel, path: str) -> None:
    row = (model.inputs, model.hidden, model.flat().tolist(), list(model.losses))
    spark.createDataFrame([row], "inputs int, hidden int, weights array<double>, losses array<double>").coalesce(1).write.parquet(path)


def load(spark: SparkSession, path: str) -> StepModel:
    row = spark.read.parquet(path).first()
    return replace(start(row["inputs"], row["hidden"]).with_flat(np.array(row["weights"])), losses=tuple(row["losses"]))
