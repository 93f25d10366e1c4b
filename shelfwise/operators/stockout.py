"""Training and applying the stock-out model."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.schema import (
    DAILY_KEYS,
    FEATURE_COLUMNS,
    LABEL_COLUMN,
    PREDICTIONS_SCHEMA,
    PROBABILITY_COLUMN,
)

_WEIGHT = "_weight"
_VECTOR = "_vector"


@dataclass(frozen=True)
class StockoutModel:
    """A fitted logistic regression: one weight per feature column, and the intercept."""

    coefficients: tuple[float, ...]
    intercept: float
    rows: int


def training_set(
    features: DataFrame, missing_inventory: str = "zero", keep_keys: bool = False
) -> DataFrame:
    """Model inputs and label; a missing stock reading counts as 0, or drops the row."""
    if missing_inventory not in ("zero", "drop"):
        raise ValueError("missing_inventory is 'zero' or 'drop'")
    labelled = features.where(F.col(LABEL_COLUMN).isNotNull())
    if missing_inventory == "drop":
        labelled = labelled.where(F.col("on_hand_latest").isNotNull())
    stock = F.coalesce(F.col("on_hand_latest"), F.lit(0)).cast("decimal(38,0)")
    return labelled.select(
        *(DAILY_KEYS if keep_keys else ()),
        "total_qty_sold",
        "sales_event_count",
        stock.alias("on_hand_latest"),
        LABEL_COLUMN,
    )


def train_stockout(
    training: DataFrame,
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-12,
    tasks: int | None = None,
) -> StockoutModel:
    """Fit an L2-penalised logistic regression with a free intercept on unscaled inputs.

    ``c`` is the weight of the log-loss sum against half the squared norm of the
    weights; in Spark's mean-loss form that is a penalty of 1 / (c * rows).

    The inputs are small whole numbers, so equal rows are merged into one weighted
    row first: the iterations then run over the distinct rows, and the optimum is
    the same. ``tasks`` sets in how many tasks an iteration reads them; without it
    they stay as the merge left them.

    An empty set, one with a single label, one with a NULL input, and a fit that has
    not settled after ``max_iter`` iterations are refused.
    """
    merged = (
        training.groupBy(*FEATURE_COLUMNS, LABEL_COLUMN)
        .agg(F.count(F.lit(1)).cast("double").alias(_WEIGHT))
        .select(
            *[F.col(name).cast("double").alias(name) for name in FEATURE_COLUMNS],
            F.col(LABEL_COLUMN).cast("double").alias(LABEL_COLUMN),
            _WEIGHT,
        )
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    points = (
        VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol=_VECTOR)
        .transform(merged)
        .select(_VECTOR, LABEL_COLUMN, _WEIGHT)
    )
    try:
        rows = _checked_count(merged)
        fitted = LogisticRegression(
            featuresCol=_VECTOR,
            labelCol=LABEL_COLUMN,
            weightCol=_WEIGHT,
            family="binomial",
            regParam=1.0 / (c * rows),
            elasticNetParam=0.0,
            standardization=False,
            fitIntercept=True,
            maxIter=max_iter,
            tol=tol,
        ).fit(points if tasks is None else points.coalesce(tasks))
    finally:
        merged.unpersist()
    iterations = fitted.summary.totalIterations
    if iterations >= max_iter:
        raise RuntimeError(f"training has not settled after {iterations} iterations; raise max_iter")
    return StockoutModel(tuple(float(w) for w in fitted.coefficients), float(fitted.intercept), rows)


def _checked_count(merged: DataFrame) -> int:
    """Rows behind the merged ones; all inputs and both labels must be there."""
    row = merged.agg(
        F.sum(_WEIGHT).alias(_WEIGHT),
        F.min(LABEL_COLUMN).alias("low"),
        F.max(LABEL_COLUMN).alias("high"),
        *[F.sum(F.when(F.col(name).isNull(), F.col(_WEIGHT))).alias(name) for name in FEATURE_COLUMNS],
    ).first()
    if row[_WEIGHT] is None:
        raise ValueError("the training set is empty")
    missing = [f"{name} in {row[name]:.0f} rows" for name in FEATURE_COLUMNS if row[name]]
    if missing:
        raise ValueError(f"the training set has NULL inputs: {', '.join(missing)}; drop these rows or give them a value")
    if row["low"] == row["high"]:
        raise ValueError(f"the training set holds only label {row['low']:g}; two are needed")
    return int(row[_WEIGHT])


def _probability(model: StockoutModel) -> Column:
    terms = [
        F.lit(weight) * F.col(name).cast("double")
        for weight, name in zip(model.coefficients, FEATURE_COLUMNS, strict=True)
    ]
    logit = reduce(Column.__add__, terms, F.lit(model.intercept))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def score(training: DataFrame, model: StockoutModel) -> DataFrame:
    """Add the probability of the low-stock label, as a plain generated expression."""
    return training.withColumn(PROBABILITY_COLUMN, _probability(model))


def predictions(scored: DataFrame, keep_keys: bool = False) -> DataFrame:
    """The typed prediction table: inputs, label and probability."""
    return scored.select(
        *(DAILY_KEYS if keep_keys else ()),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTIONS_SCHEMA.fields],
    )
