"""Scoring prepared panels and sequences."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.functions.arrays import dot, logistic


def linear_score(features: Sequence[str], weights: Sequence[float], bias: float = 0.0) -> Column:
    """Logistic score of feature columns with given weights."""
    total = F.lit(float(bias))
    for c, w in zip(features, weights, strict=True):
        total = total + F.col(c) * F.lit(float(w))
    return logistic(total)


def linear_step_score(weights: Sequence[float], bias: float = 0.0, vector: str = "x") -> Column:
    """Logistic score of a feature vector."""
    return logistic(dot(F.col(vector), list(weights), bias))


def score_with(
    sequences: DataFrame,
    make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]],
    max_len: int,
    width: int,
    batch_size: int = 1024,
    output: str = "scores",
) -> DataFrame:
    """Score padded sequences with a user's model.

    ``make_predict`` runs once per Python worker and returns a function from an array of shape
    (batch, max_len, width) to one of shape (batch, max_len). The result is an array column.
    """
    predict = predict_batch_udf(
        make_predict,
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=batch_size,
        input_tensor_shapes=[[max_len, width]],
    )
    return sequences.withColumn(output, predict(F.flatten("x")))
