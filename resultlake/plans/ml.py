"""Models on Spark ML, fitted and judged as DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import product

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.functions.columns import clip, finite, row_mean_std
from resultlake.operators.pick import seeded
from resultlake.operators.shape import attach


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, missing, mean, std) of each column; NaN and infinity count as missing."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), finite(c).alias("v")) for c in columns])).alias("m")).select("m.*")
    return long.groupBy("column").agg(F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("missing"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """Columns as (x - mean) / std, 0 where missing or constant; the scaler has one row for each column."""
    at = {r["column"]: (r["mean"], r["std"]) for r in scaler.collect()}
    return df.withColumns({c: F.coalesce((finite(c) - m) / s, F.lit(0.0)) if s else F.lit(0.0) for c, (m, s) in at.items()})


def ridge_line(df: DataFrame, xs: list[str], y: str, lam: float = 1e-3) -> dict[str, float]:
    """Coefficients of a ridge regression on standardized features, in the units of the raw ones."""
    ok = df.select(*[finite(c).alias(c) for c in xs], finite(y).alias("label")).dropna()
    stages = [VectorAssembler(inputCols=xs, outputCol="features"), LinearRegression(elasticNetParam=0.0, regParam=lam, standardization=True, solver="normal")]
    model = Pipeline(stages=stages).fit(ok).stages[-1]
    return dict(zip(xs, map(float, model.coefficients))) | {"intercept": float(model.intercept)}


def line_prediction(coefficients: dict[str, float]):  # noqa: ANN201
    """The prediction of a line as a column."""
    return reduce(lambda a, b: a + b, [F.col(c) * w for c, w in coefficients.items() if c != "intercept"], F.lit(coefficients["intercept"]))


def residual(df: DataFrame, y: str, base: str, name: str = "residual") -> DataFrame:
    """The target less a baseline."""
    return df.withColumn(name, F.col(y) - F.col(base))


def isotonic(df: DataFrame, key: str, y: str, pred: str, seed: int) -> DataFrame:
    """The rows of a seeded half with the prediction recalibrated on the other half, within [0, 1].

    The halves are those of the seeded order that samples are drawn by, so any engine can tell them.
    """
    half = df.withColumn("__h", F.substring(seeded([key], seed), 1, 1) < "8")
    model = IsotonicRegression(featuresCol=pred, labelCol=y, predictionCol="calibrated").fit(half.filter("__h").select(F.col(pred).cast("double").alias(pred), F.col(y).cast("double").alias(y)))
    out = model.transform(half.filter("NOT __h").withColumn(pred, F.col(pred).cast("double"))).drop("__h")
    return out.withColumn("calibrated", clip("calibrated", 0.0, 1.0))


def out_of_fold(df: DataFrame, key: str, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Every row with the prediction of a model that has not seen its fold; folds are by parity of the row's id."""
    folds = [df.filter(F.pmod(F.col(key), F.lit(2)) == i) for i in (0, 1)]
    return fit(folds[1])(folds[0]).unionByName(fit(folds[0])(folds[1]))


def ensemble(preds: list[DataFrame], key: str) -> DataFrame:
    """Mean and deviation of the predictions of several models."""
    named = [p.select(key, F.col("prediction").alias(f"p{i}")) for i, p in enumerate(preds)]
    both = reduce(lambda a, b: a.join(b, key), named)
    mean, std = row_mean_std([f"p{i}" for i in range(len(preds))])
    return both.withColumns({"prediction": mean, "sigma": std})


def train(df: DataFrame, y: str, xs: list[str], kind: str = "logistic", categories: list[str] = (), **options) -> PipelineModel:  # noqa: ANN003
    """A pipeline of indexed categories, assembled features and a model: logistic, mlp, gbt or line."""
    index = [StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep") for c in categories]
    features = VectorAssembler(inputCols=[*xs, *[f"{c}__i" for c in categories]], outputCol="features", handleInvalid="skip")
    if kind in ("gbt", "line"):
        model = (GBTRegressor if kind == "gbt" else LinearRegression)(labelCol=y, **options)
        return Pipeline(stages=[*index, features, model]).fit(df)
    label = StringIndexer(inputCol=y, outputCol="__label", handleInvalid="skip")
    if kind == "mlp":
        n = df.select(y).distinct().count()
        layers = [len(xs) + len(categories), *options.pop("hidden", (32,)), n]
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
        return Pipeline(stages=[*index, label, features, scaler, MultilayerPerceptronClassifier(labelCol="__label", featuresCol="scaled", layers=layers, seed=options.pop("seed", 0), **options)]).fit(df)
    return Pipeline(stages=[*index, label, features, LogisticRegression(labelCol="__label", **options)]).fit(df)


def fit_per_group(df: DataFrame, by: list[str], fit: Callable[[pd.DataFrame], dict[str, float]], names: list[str]) -> DataFrame:
    """Numbers that a library's model gives for each group (F04); a group is held by one task, so it must fit one.

    Lines need no library: ``reports.group_slopes`` makes them from sums, for groups of any size.
    """
    schema = T.StructType([*[df.schema[c] for c in by], *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{c: group[c].iloc[0] for c in by} | {n: float(v) for n, v in fit(group).items()}])[[*by, *names]]

    return df.groupBy(*by).applyInPandas(run, schema)


def class_weights(counts: DataFrame, mode: str = "none") -> DataFrame:
    """Weights of classes (y, n): none, inverse, sqrt or log of the inverse share, mean 1 over rows."""
    total = counts.agg(F.sum("n").alias("t"))
    share = F.col("n") / F.col("t")
    raw = {"none": F.lit(1.0), "inverse": 1 / share, "sqrt": 1 / F.sqrt(share), "log": F.log1p(1 / share)}[mode]
    c = attach(counts, total).withColumn("w", F.when(F.col("n") > 0, raw).otherwise(0.0))
    mean = c.agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("m"))
    return attach(c, mean).withColumn("weight", F.col("w") / F.col("m")).drop("t", "w", "m")


def joint_pick(df: DataFrame, key: str, a: str, b: str, weight: float = 0.3) -> DataFrame:
    """The choice with the largest log p(a) + weight log p(b): maps of probabilities, where a choice's last letter names its b."""
    long = df.select(key, b, F.explode(a).alias("choice", "p"))
    other = F.element_at(F.col(b), F.substring("choice", -1, 1))
    score = F.log(F.greatest("p", F.lit(1e-12))) + weight * F.log(F.greatest(F.coalesce(other, F.lit(0.0)), F.lit(1e-12)))
    return long.withColumn("score", score).groupBy(key).agg(F.max_by("choice", F.struct("score", "choice")).alias("choice"), F.max("score").alias("score"))


def sweep(fit: Callable[[dict], float], axes: dict[str, list], rounds: int = 2) -> list[dict]:
    """Coordinate descent: each axis in turn takes its best value, the others held; one entry for each trial, metric least best."""
    best = {k: v[0] for k, v in axes.items()}
    trials, seen = [], {}
    for r, axis in product(range(rounds), axes):
        for value in axes[axis]:
            now = best | {axis: value}
            key = tuple(sorted(now.items()))
            if key not in seen:
                seen[key] = fit(now)
                trials.append(now | {"metric": seen[key], "axis": axis, "round": r})
        best = dict(min((k for k in seen if all(dict(k)[a] == best[a] for a in axes if a != axis)), key=lambda k: (seen[k], k)))
    return trials


def plateau(metrics: list[tuple[int, float]], tolerance: float) -> int:
    """The smallest number of rows whose metric is within a tolerance of the best of larger ones."""
    for i, (rows, m) in enumerate(metrics):
        if m <= min(x for _, x in metrics[i:]) + tolerance:
            return rows
    return metrics[-1][0]
