"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.features import Words, ngram_indexes

SCALE = 4.0


@dataclass
class Ftrl:
    """Settings of the learner. ``max_rows``: the largest number of labelled rows that are learnt from,
    chosen by a hash of the id; ``trainers``: parts that learn apart and are averaged."""

    bits: int = 18
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.01
    epochs: int = 3
    max_rows: int = 20_000
    trainers: int = 4


@dataclass
class LinearModel:
    """Weights by hashed feature, and a bias."""

    weights: np.ndarray
    bias: float
    bits: int

    def score(self, text: Column) -> Column:
        """Probability of label 1; the bias alone decides for null, empty and blank texts."""
        weights, bias, bits = self.weights, self.bias, self.bits

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            memo = Words()
            for texts in batches:
                found = (ngram_indexes(t, memo, bits) for t in texts)
                dots = np.array([weights[x].sum() * (SCALE / max(1, len(x))) for x in found], dtype=float)
                yield pd.Series(1 / (1 + np.exp(-np.clip(dots + bias, -35, 35))))

        return scored(text.cast("binary"))


def ftrl_weights(examples: list, targets: np.ndarray, cfg: Ftrl) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes over ``(indexes, values)`` examples in the given order."""
    z, n = np.zeros(1 << cfg.bits), np.zeros(1 << cfg.bits)
    bias_z = bias_n = 0.0

    def proximal(z, n):
        return np.where(np.abs(z) <= cfg.l1, 0.0, (np.sign(z) * cfg.l1 - z) / ((cfg.beta + np.sqrt(n)) / cfg.alpha + cfg.l2))

    def free(z, n):
        return -z / ((cfg.beta + np.sqrt(n)) / cfg.alpha)

    for _ in range(cfg.epochs):
        for (index, value), y in zip(examples, targets):
            old_n = n[index]
            w, bias = proximal(z[index], old_n), free(bias_z, bias_n)
            error = 1 / (1 + np.exp(-np.clip(w @ value + bias, -35, 35))) - y
            step = error * value
            z[index] += step - (np.sqrt(old_n + step * step) - np.sqrt(old_n)) / cfg.alpha * w
            n[index] = old_n + step * step
            bias_z += error - (np.sqrt(bias_n + error * error) - np.sqrt(bias_n)) / cfg.alpha * bias
            bias_n += error * error
    return proximal(z, n), float(free(bias_z, bias_n))


def _trainer(cfg: Ftrl):
    def train(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["__order", "__id"], kind="stable")
        memo, examples = Words(), []
        for text in rows["__bytes"]:
            found = ngram_indexes(text, memo, cfg.bits)
            index, counts = np.unique(found, return_counts=True)
            examples.append((index, counts * (SCALE / max(1, len(found)))))
        weights, bias = ftrl_weights(examples, rows["__y"].to_numpy(dtype=float), cfg)
        used = np.flatnonzero(weights)
        return pd.DataFrame({"feature": np.append(used, -1), "weight": np.append(weights[used], bias), "rows": len(rows)})

    return train


def fit(docs: DataFrame, labels: DataFrame, cfg: Ftrl = Ftrl(), text: str = "text", key: str = "doc_id", label: str = "quality") -> LinearModel:
    """Fit on the rows of ``docs`` that ``labels`` (``key``, ``label``) names.

    At most ``max_rows`` labelled ids, the smallest by hash, are learnt from: a fixed number, so they may
    be broadcast to the scan, and no text but theirs moves. ``trainers`` tasks learn from a share each;
    their weights, averaged by rows, are ``2 ** bits`` numbers at most.

    Labels that are null or not 0 or 1 and null ids are left out; an id labelled twice counts as often as
    its rows; without any label the model is all zero and scores 0.5.
    """
    chosen = (
        labels.select(F.col(key).alias("__id"), F.col(label).cast("int").alias("__y"))
        .filter("__id IS NOT NULL AND __y IN (0, 1)")
        .withColumn("__order", F.xxhash64("__id"))
        .orderBy("__order", "__id", "__y")
        .limit(cfg.max_rows)
    )
    rows = (
        docs.select(F.col(key).alias("__doc"), F.col(text).cast("binary").alias("__bytes"))
        .join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
        .select("__id", "__order", "__y", "__bytes", F.pmod("__order", F.lit(cfg.trainers)).alias("trainer"))
    )
    parts = rows.groupBy("trainer").applyInPandas(_trainer(cfg), "feature long, weight double, rows long")
    found = parts.groupBy("feature").agg(F.sum(F.col("weight") * F.col("rows")).alias("weight"), F.sum("rows").alias("rows")).toPandas()
    weights = np.zeros(1 << cfg.bits)
    bias = found[found.feature < 0]
    if not len(bias):
        return LinearModel(weights, 0.0, cfg.bits)
    total = float(bias["rows"].iloc[0])
    inside = found[found.feature >= 0]
    weights[inside.feature.to_numpy()] = inside.weight.to_numpy() / total
    return LinearModel(weights, float(bias.weight.iloc[0]) / total, cfg.bits)
