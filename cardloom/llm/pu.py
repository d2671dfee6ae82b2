"""Learning from positive and unlabelled examples with a non-negative risk.

With prior p of the positive class and a loss l, the risk of a score f is

    p E+[l(f)] + max(0, Eu[l(-f)] - p E+[l(-f)]),

the second term being the risk on negatives, which is never seen below zero but in
overfitted samples; then its gradient is turned round.  Classifiers are linear over
sparse features, with the logistic loss, so that a score is a probability.

The features of a document are a set of names.  Training sees at most ``POSITIVES``
confirmed and ``UNLABELLED`` other documents, chosen by a hash of doc_id; that bound
holds whatever the size of the tables, and is the only sample here.  Feature counts
come from a grouped aggregation, and of the features the ``FEATURES`` that tell the
two sets apart best are kept, so what reaches the driver is bounded too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .runtime import held, settle

POSITIVES, UNLABELLED, FEATURES = 4_000, 12_000, 4_096
#: Documents of the sample that a feature must occur in, and how clear (root of the likelihood ratio statistic) its difference between the sets must be.
LEAST, CLEAR = 3, 3.5
#: Training rounds, step and weight decay.
ROUNDS, STEP, DECAY = 400, 0.05, 1e-4


@dataclass
class Model:
    """Weights by feature name; a document's weights are summed and scaled by its number of features."""

    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    scaled: bool = True

    def score(self, features: set[str]) -> float:
        known = self.weights.keys() & features
        total = sum(self.weights[k] for k in sorted(known)) * _scale(len(features), self.scaled)
        return float(1 / (1 + np.exp(-np.clip(self.bias + total, -30, 30))))


def _scale(n: int, scaled: bool) -> float:
    return (n or 1) ** -0.5 if scaled else 1.0


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, float]:
    """((doc_id, text, positive) rows to learn from, prior): nothing of the held-out fold is used.

    The prior is the share of label 1 among all labelled documents of the other folds.
    Null labels and ids are left out; of a repeated id the greatest label counts,
    and the least of its texts (null only if there is no other).
    """
    seen = fold(F.col(doc_id), parts) != held_out
    labelled = labels.where(seen & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg((F.max(label) == 1).alias("positive"))
    prior = labelled.agg(F.avg(F.col("positive").cast("double"))).first()[0]
    confirmed = labelled.where("positive").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(POSITIVES)
    others = docs.where(seen).select(F.col(doc_id).alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(UNLABELLED)
    chosen = confirmed.withColumn("positive", F.lit(True)).unionByName(others.withColumn("positive", F.lit(False)))
    texts = docs.where(seen).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    wanted = chosen.groupBy("doc_id").agg(F.collect_list("positive").alias("sets"))
    # POSITIVES + UNLABELLED ids at most are broadcast
    found = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("sets").alias("sets"))
    return settle(found.select("doc_id", "text", F.explode("sets").alias("positive"))), float(prior or 0.0)


def fit(rows: DataFrame, prior: float, features: Callable[[str | None], set[str]], scaled: bool = True) -> Model:
    """A model of the positive class from (doc_id, text, positive) rows; constant if there is nothing to learn from."""

    @arrow_udf("array<string>")
    def named(texts: pa.Array) -> pa.Array:
        held("pu")
        return pa.array([sorted(features(x.as_py())) for x in texts], pa.list_(pa.string()))

    rows = settle(rows.select("doc_id", "positive", named("text").alias("names")))
    sizes = {r["positive"]: r["n"] for r in rows.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(True) or not sizes.get(False) or not 0 < prior < 1:
        return Model(float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    hits = [F.sum((F.col("positive") == side).cast("double")) for side in (True, False)]
    counts = rows.select("positive", F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("n"), *[h.alias(k) for h, k in zip(hits, ("a", "b"))])
    counts = counts.withColumn("z", _clearness(F.col("a"), F.col("b"), sizes[True], sizes[False]))
    kept = counts.where((F.col("n") >= LEAST) & (F.col("z") >= CLEAR)).orderBy(F.desc("z"), "name").limit(FEATURES).collect()
    if not kept:
        return Model(float(np.log(prior / (1 - prior))))
    names = {r["name"]: i for i, r in enumerate(kept)}

    @arrow_udf("array<int>")
    def numbered(lists: pa.Array) -> pa.Array:
        return pa.array([[names[x] for x in own.as_py() if x in names] for own in lists], pa.list_(pa.int32()))

    got = rows.select("doc_id", "positive", F.size("names").alias("n"), numbered("names").alias("own")).toArrow().sort_by([("doc_id", "ascending"), ("positive", "ascending")])
    positive = got["positive"].to_numpy().astype(bool)
    own = got["own"].combine_chunks()
    lengths = np.diff(own.offsets.to_numpy())
    scale = np.maximum(got["n"].to_numpy(), 1) ** -0.5 if scaled else np.ones(len(positive))
    row, column = np.repeat(np.arange(len(positive)), lengths), own.flatten().to_numpy()
    bias, weights = _descend(row, column, scale[row], positive, prior, len(names))
    return Model(bias, {k: float(weights[i]) for k, i in names.items()}, scaled)


def _clearness(a: Column, b: Column, n_a: int, n_b: int) -> Column:
    """Root of the likelihood ratio statistic for a of n_a against b of n_b; unlike a ratio of odds it is at ease with zero."""

    def part(seen: Column, of: int) -> Column:
        share = (a + b) / float(n_a + n_b)
        hit = F.when(seen > 0, seen * F.ln(seen / (of * share))).otherwise(0.0)
        return hit + F.when(seen < of, (of - seen) * F.ln((of - seen) / (of * (1 - share)))).otherwise(0.0)

    return F.sqrt(F.greatest(2 * (part(a, n_a) + part(b, n_b)), F.lit(0.0)))


def _descend(row: np.ndarray, column: np.ndarray, value: np.ndarray, positive: np.ndarray, prior: float, width: int) -> tuple[float, np.ndarray]:
    """Minimise the non-negative risk by Adam over the whole sample."""
    n_pos, n_other = positive.sum(), (~positive).sum()
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, ROUNDS + 1):
        f = np.bincount(row, value * theta[column], len(positive)) + theta[-1]
        chance = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        loss_negative = -np.log(np.maximum(1 - chance, 1e-12))
        negative_risk = loss_negative[~positive].mean() - prior * loss_negative[positive].mean()
        # derivatives by f: of the loss as a positive chance - 1, as a negative chance
        by_f = np.where(positive, -prior * chance / n_pos, chance / n_other)
        if negative_risk < 0:
            by_f = -by_f
        by_f = by_f + np.where(positive, prior * (chance - 1) / n_pos, 0.0)
        gradient = np.append(np.bincount(column, value * by_f[row], width), by_f.sum()) + DECAY * np.append(theta[:-1], 0.0)
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        theta = theta - STEP * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return float(theta[-1]), theta[:-1]


def score(model: Model, text: Column, features: Callable[[str | None], set[str]]) -> Column:
    """Chance of the positive class, 0 to 1, for each whole text; null counts as empty."""

    @arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        held("pu")
        found = pa.array([model.score(features(x.as_py())) for x in texts], pa.float64())
        pa.default_memory_pool().release_unused()  # workers live on beside the next stages
        return found

    return scored.asNondeterministic()(text)  # so that it runs once where a filter and the output both read it


def bins(prefix: str, share: float, edges: Iterable[float] = (0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)) -> str:
    """Name of the feature that a share falls into a bin."""
    return f"{prefix}>{sum(share > e for e in edges)}"
