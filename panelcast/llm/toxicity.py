"""Toxicity: positive-unlabelled learning with a non-negative risk estimator."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.features import Words, word_indexes


@dataclass
class PuConfig:
    """``max_rows``: the largest number of confirmed and of unlabelled texts learnt from, each the smallest
    by a hash of the id. No word is shut out by its share of the confirmed texts: one in ``least_texts`` of them is
    weighed by how surprising its count is at its rate in unlabelled text (root of the Poisson deviance). The weight
    rises from 0 to 1 over ``ramp`` of it, up to what the luckiest of as many chance words would reach, so the level
    follows the number of words that the confirmed texts hold."""

    bits: int = 18
    max_rows: int = 20_000
    least_texts: int = 3
    ramp: float = 2.0
    start: float = 0.5
    epochs: int = 60
    batch: int = 128
    rate: float = 0.3
    seed: int = 0


@dataclass
class WordModel:
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, text: Column) -> Column:
        """Probability-like score from 0 to 1; the bias alone decides for null, empty and blank texts."""
        weights, bias, bits = self.weights, self.bias, self.bits

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            memo = Words()

            def total(text):
                found = word_indexes(text, memo, bits)
                return weights[np.unique(found[weights[found] != 0])].sum()

            for texts in batches:
                sums = np.array([total(t) for t in texts], dtype=float)
                yield pd.Series(1 / (1 + np.exp(-np.clip(sums + bias, -35, 35))))

        return scored(text.cast("binary"))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def surprise_weights(positive: list, unlabelled: list, size: int, cfg: PuConfig) -> tuple[np.ndarray, np.ndarray]:
    """How much each feature counts, from 0 to 1 (see ``PuConfig``), and the log of its count over the expected one."""
    in_p = np.bincount(np.concatenate(positive), minlength=size)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=size)
    expected = len(positive) * (in_u + 0.5) / (len(unlabelled) + 1)
    above = in_p * np.log(np.maximum(in_p, 1) / expected) - (in_p - expected)
    surprise = np.where(in_p > expected, np.sqrt(2 * np.maximum(above, 0)), 0.0)
    chance = np.sqrt(2 * np.log(max(np.count_nonzero(in_p), 2)))
    strength = np.where(in_p >= cfg.least_texts, np.clip((surprise - chance + cfg.ramp) / cfg.ramp, 0, 1), 0.0)
    return strength, np.log(np.maximum(in_p, 1) / expected)


def nn_pu(positive: list, unlabelled: list, prior: float, size: int, cfg: PuConfig) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier over sets of feature indexes.

    The risk is ``prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])`` with the sigmoid loss; a
    step for which the second part is negative climbs that part instead, as the non-negative estimator
    prescribes.
    """
    strength, ratio = surprise_weights(positive, unlabelled, size, cfg)
    used = np.flatnonzero(strength)
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    # From the ratios on, the slopes are steep enough to learn from; from 0 on, many weak words flatten them first.
    scale, w, gathered = strength[used], cfg.start * np.clip(ratio[used], 0, 3), np.full(len(used), 1e-6)
    bias, bias_gathered = float(np.log(prior / (1 - prior))), 1e-6

    def packed(sets):
        kept = [x[x >= 0] for x in (place[s] for s in sets)]
        return kept, np.array([len(x) for x in kept])

    (p_sets, p_len), (u_sets, u_len) = packed(positive), packed(unlabelled)

    def rows(sets, lengths, chosen):
        index = np.concatenate([sets[i] for i in chosen])
        return index, np.repeat(np.arange(len(chosen)), lengths[chosen])

    rng = np.random.default_rng(cfg.seed)
    steps = max(1, len(unlabelled) // cfg.batch)
    per = min(len(positive), max(cfg.batch // 2, -(-len(positive) // steps)))
    for _ in range(cfg.epochs):
        of_u, of_p = rng.permutation(len(unlabelled)), rng.permutation(len(positive))
        for step in range(steps):
            us, ps = of_u[step::steps], of_p[np.arange(step * per, (step + 1) * per) % len(positive)]
            (pi, pr), (ui, ur) = rows(p_sets, p_len, ps), rows(u_sets, u_len, us)
            sp = _sigmoid(np.bincount(pr, (scale * w)[pi], len(ps)) + bias)
            su = _sigmoid(np.bincount(ur, (scale * w)[ui], len(us)) + bias)
            slope_p, slope_u = prior * sp * (1 - sp) / len(ps), su * (1 - su) / len(us)
            if su.mean() - prior * sp.mean() >= 0:
                grad_p, grad_u = -2 * slope_p, slope_u
            else:
                grad_p, grad_u = slope_p, -slope_u
            grad = scale * (np.bincount(pi, grad_p[pr], len(w)) + np.bincount(ui, grad_u[ur], len(w)))
            gathered += grad * grad
            w -= cfg.rate * grad / np.sqrt(gathered)
            grad = grad_p.sum() + grad_u.sum()
            bias_gathered += grad * grad
            bias -= 0.3 * cfg.rate * grad / np.sqrt(bias_gathered)
    weights = np.zeros(size)
    weights[used] = scale * w
    return weights, bias


def _word_sets(bits: int):
    @F.pandas_udf("array<int>")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = Words()
        for texts in batches:
            yield pd.Series([np.unique(word_indexes(t, memo, bits)).astype("int32") for t in texts])

    return sets


def _learner(prior: float, cfg: PuConfig):
    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["__order", "__id"], kind="stable")
        p, u = (list(rows.loc[rows["__p"] == k, "__set"]) for k in (True, False))
        if not p or not u:
            return pd.DataFrame({"feature": [-1], "weight": [-35.0]})
        weights, bias = nn_pu(p, u, prior, 1 << cfg.bits, cfg)
        used = np.flatnonzero(weights)
        return pd.DataFrame({"feature": np.append(used, -1), "weight": np.append(weights[used], bias)})

    return learn


def fit(
    docs: DataFrame, confirmed: DataFrame, prior: float, cfg: PuConfig = PuConfig(), text: str = "text", key: str = "doc_id"
) -> WordModel:
    """Learn from the texts that ``confirmed`` (``key``) names and from the rest of ``docs`` as it is.

    ``docs`` are the texts that may be learnt from; ``prior`` is the share of toxic ones among them. Both
    samples have a fixed bound (``max_rows``), so their ids may be broadcast to one scan and one task may
    learn from their sets of hashed words. Unlabelled texts are drawn from all of ``docs``, confirmed ones
    included, as the estimator assumes.

    Null ids are left out; without a confirmed or an unlabelled text the score is 0 throughout.
    """
    prior = min(max(float(prior), 1e-3), 0.999)

    def sample(ids: DataFrame, positive: bool) -> DataFrame:
        ids = ids.select(F.col(key).alias("__id")).filter("__id IS NOT NULL").withColumn("__order", F.xxhash64("__id"))
        return ids.dropDuplicates(["__id"]).orderBy("__order", "__id").limit(cfg.max_rows).withColumn("__p", F.lit(positive))

    # The unlabelled ids need no distinct step: a repeated id only takes more of the sample.
    every = docs.select(F.col(key).alias("__id")).filter("__id IS NOT NULL").withColumn("__order", F.xxhash64("__id"))
    unlabelled = every.orderBy("__order", "__id").limit(cfg.max_rows).distinct().withColumn("__p", F.lit(False))
    chosen = sample(confirmed, True).unionByName(unlabelled)
    found = (
        docs.select(F.col(key).alias("__doc"), F.col(text).cast("binary").alias("__bytes"))
        .join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
        .select("__id", "__order", "__p", _word_sets(cfg.bits)("__bytes").alias("__set"))
        .groupBy(F.lit(0).alias("one"))
        .applyInPandas(_learner(prior, cfg), "feature long, weight double")
        .toPandas()
    )
    weights = np.zeros(1 << cfg.bits)
    inside = found[found.feature >= 0]
    weights[inside.feature.to_numpy()] = inside.weight.to_numpy()
    bias = found[found.feature < 0].weight
    return WordModel(weights, float(bias.iloc[0]) if len(bias) else -35.0, cfg.bits)
