"""Calendar features, a stable split, least squares, scoring and the metric row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalar import CALENDAR_PARTS, calendar, epoch_to_timestamp, hash_share, ts_lit


@dataclass(frozen=True)
class LinearModel:
    """``label = intercept + sum(coefficient * feature)``, in the order of the features."""

    coefficients: list[float]
    intercept: float


def calendar_features(df: DataFrame, epoch: str, per_second: int = 1000) -> DataFrame:
    """Append the calendar parts of an epoch column."""
    return df.withColumns(calendar(epoch_to_timestamp(F.col(epoch), per_second)))


def feature_columns(*extra: str) -> list[str]:
    return [*CALENDAR_PARTS, *extra]


def assemble(df: DataFrame, features: Sequence[str], invalid: str = "error") -> DataFrame:
    """Append the ``features`` vector; a NULL or NaN input is an error by default."""
    return VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid=invalid
    ).transform(df)


def split(df: DataFrame, key: Column, train_percent: int = 80) -> DataFrame:
    """Append ``is_train``. The side depends on the key alone, not on the partitioning,
    so a retried task puts every row where it was."""
    return df.withColumn("is_train", hash_share(key, train_percent))


def fit(train: DataFrame, label: str, features: Sequence[str]) -> LinearModel:
    """Ordinary least squares without regularisation, in one pass over the rows.

    One aggregate gives the means and the cross moments about them. Its buffers hold centred
    sums and are merged pair by pair, so values far from zero, as years are, lose no digits and
    the order of rows and partitions does not matter. That small matrix is all that reaches the
    driver, which scales it to correlations and solves it by its rank: a constant feature gets
    0, and features that depend on each other share their effect. A NULL or NaN among features or
    labels is an error.
    """
    columns = [*features, label]
    values = train.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    bad = reduce(Column.__or__, [F.col(c).isNull() | F.isnan(c) for c in values.columns])
    failed = F.raise_error(F.lit("NULL or NaN among the features or labels")).cast("double")
    values = values.withColumn("c0", F.when(bad, failed).otherwise(F.col("c0")))
    k = len(columns)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = values.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"c{i}").alias(f"m{i}") for i in range(k)],
        *[F.covar_pop(f"c{i}", f"c{j}").alias(f"s{i}_{j}") for i, j in pairs],
    ).first()
    if not sums["n"]:
        raise ValueError("no rows to fit")
    moments = np.zeros((k, k))
    for i, j in pairs:
        moments[i, j] = moments[j, i] = sums[f"s{i}_{j}"]
    means = np.array([sums[f"m{i}"] for i in range(k)])
    spread = np.sqrt(np.diag(moments))
    # A spread that rounding of the mean alone explains is that of a constant.
    scale = np.where(spread > np.abs(means) * 1e-14, spread, np.inf)[:-1]
    correlations = moments[:-1, :-1] / np.outer(scale, scale)
    slopes, *_ = np.linalg.lstsq(correlations, moments[:-1, -1] / scale, rcond=1e-12)
    coefficients = slopes / scale
    return LinearModel([float(c) for c in coefficients], float(means[-1] - coefficients @ means[:-1]))


def predict(model: LinearModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Append ``prediction``, a plain expression over the feature columns.

    As in training, a NULL or NaN feature is an error.
    """
    terms = (F.col(f) * F.lit(c) for f, c in zip(features, model.coefficients, strict=True))
    value = reduce(Column.__add__, terms) + F.lit(model.intercept)
    missing = value.isNull() | F.isnan(value)
    failed = F.raise_error(F.lit("NULL or NaN among the features")).cast("double")
    return df.withColumn("prediction", F.when(missing, failed).otherwise(value))


def rmse(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Root mean squared error as one row (left lazy, so it can be written directly)."""
    error = F.col(label) - F.col(prediction)
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def metric_row(value: DataFrame, created: datetime) -> DataFrame:
    """``created_date, rmse`` in the types of the metric table."""
    return value.select(
        ts_lit(created).alias("created_date"), F.col("rmse").try_cast("double").alias("rmse")
    )
