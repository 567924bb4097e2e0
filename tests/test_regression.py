from datetime import datetime

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import regression as R
from tidemark.plans.ingest import fit_and_score


@pytest.fixture(scope="module")
def hourly(spark):
    time = F.lit(1_600_000_000_000) + F.col("id") * 3_600_000
    return spark.range(6000).select(
        "id", time.alias("time"), (F.hash(F.lit("s"), "id") % 1000).cast("double").alias("supply"),
        (F.col("id") * 0.25 + F.hour(F.timestamp_millis(time)) * 3 + (F.hash("id") % 100)).cast("double").alias("price"),
    )


def numpy_fit(df, features, label):
    data = np.array([[float(v) for v in r] for r in df.select(*features, label).collect()])
    x = np.column_stack([np.ones(len(data)), data[:, :-1]])
    return np.linalg.lstsq(x, data[:, -1], rcond=None)[0]


def test_fit_equals_numpy(hourly):
    features = R.feature_columns("supply")
    data = R.calendar_features(hourly, "time")
    model = R.fit(data, "price", features)
    np.testing.assert_allclose([model.intercept, *model.coefficients], numpy_fit(data, features, "price"), rtol=1e-6)


def test_nearly_dependent_features(hourly):
    # A supply that grows with time is almost a sum of year, month and day.
    features = R.feature_columns("supply")
    data = R.calendar_features(hourly.withColumn("supply", F.col("id") * 0.5), "time")
    model = R.fit(data, "price", features)
    np.testing.assert_allclose([model.intercept, *model.coefficients], numpy_fit(data, features, "price"), rtol=1e-6)


def test_constant_feature(hourly):
    data = R.calendar_features(hourly, "time").withColumn("year", F.lit(2020))
    features = ["hour", "year", "supply"]
    model = R.fit(data, "price", features)
    assert model.coefficients[1] == 0.0
    want = numpy_fit(data.drop("year"), ["hour", "supply"], "price")
    np.testing.assert_allclose([model.intercept, model.coefficients[0], model.coefficients[2]], want, rtol=1e-5)


def test_prediction_and_metric(hourly):
    predictions, metric = fit_and_score(hourly, "time", "price", ["supply"], F.col("id"), datetime(2024, 1, 1))
    pairs = np.array([tuple(r) for r in predictions.select("price", "prediction").collect()])
    row = metric.first()
    assert abs(row["rmse"] - np.sqrt(np.mean((pairs[:, 0] - pairs[:, 1]) ** 2))) < 1e-9
    assert row["created_date"] == datetime(2024, 1, 1)
    assert 1000 < len(pairs) < 1400


def test_null_feature_is_an_error(hourly):
    broken = R.calendar_features(hourly, "time").withColumn("supply", F.when(F.col("id") != 5, F.col("supply")))
    with pytest.raises(Exception):
        R.fit(broken, "price", ["hour", "supply"])
    model = R.fit(R.calendar_features(hourly, "time"), "price", ["hour", "supply"])
    with pytest.raises(PySparkException, match="NULL or NaN"):
        R.predict(model, broken, ["hour", "supply"]).collect()


def test_fit_is_one_job_and_does_not_depend_on_the_order(spark, hourly):
    features = R.feature_columns("supply")
    data = R.calendar_features(hourly, "time")
    context = spark.sparkContext
    context.setJobGroup("one-fit", "a single pass")
    first = R.fit(data, "price", features)
    context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("one-fit")
    # Adaptive execution runs the map side and the last step of the one aggregate apart.
    assert len(jobs) <= 2
    for n, order in ((1, "id"), (7, "price"), (13, "supply")):
        again = R.fit(data.repartition(n).sortWithinPartitions(F.desc(order)), "price", features)
        np.testing.assert_allclose([again.intercept, *again.coefficients], [first.intercept, *first.coefficients], rtol=1e-9)


def test_values_far_from_zero_and_dependent_features(spark):
    rows = spark.range(5000).select(
        (F.lit(1.0e9) + F.col("id") % 17).alias("a"), (F.col("id") % 23).cast("double").alias("b"), F.lit(7.25e8).alias("c"),
    ).withColumns({"d": F.col("a") - F.col("b") * 2, "y": F.col("a") * 3 - F.col("b") * 5 + 11})
    model = R.fit(rows, "y", ["a", "b", "c", "d"])
    worst = R.predict(model, rows, ["a", "b", "c", "d"]).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert worst < 1e-4 and model.coefficients[2] == 0.0
    plain = R.fit(rows, "y", ["a", "b"])
    np.testing.assert_allclose(plain.coefficients, [3, -5], rtol=1e-9)
    with pytest.raises(ValueError, match="no rows"):
        R.fit(rows.limit(0), "y", ["a"])
