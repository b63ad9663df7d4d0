"""Re-fit of the composite weights as the first principal component."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from pavilion.session import discard, materialize, new_folder


def finite_or_zero(value: Column) -> Column:
    """A feature as the fit sees it."""
    number = value.cast("double")
    return F.when(F.abs(number) < float("inf"), number).otherwise(F.lit(0.0))


def refit_weights(df: DataFrame, features: Sequence[str], positive: str) -> DataFrame:
    """(feature, weight, undefined) of the first component of the standardised features.

    Nulls count as zero, as in the scores, and so do infinite values: an average without a
    dismissal is undefined. ``undefined`` is the number of such values of the feature. The sign is
    set so that ``positive`` has a positive weight. Only the feature-by-feature covariance
    reaches the driver.
    """
    folder = new_folder(df.sparkSession, "refit")
    # Scaling and rotation each read the features, so they are written once.
    finite = materialize(df.select(*[finite_or_zero(F.col(c)).alias(c) for c in features]), "features", folder)
    infinite = [F.count_if(F.abs(F.col(c).cast("double")) == float("inf")).alias(c) for c in features]
    undefined = df.agg(*infinite).first()
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        PCA(k=1, inputCol="scaled", outputCol="component"),
    ]
    weights = Pipeline(stages=stages).fit(finite).stages[-1].pc.toArray()[:, 0]
    if weights[list(features).index(positive)] < 0:
        weights = -weights
    discard(df.sparkSession, folder)
    rows = [(name, float(w), undefined[name]) for name, w in zip(features, weights, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, weight double, undefined bigint")
