"""Quality scores by positive-unlabelled learning.

Trusted good documents are positives; all documents, good and bad, are the
unlabelled web text. The share of good ones among the unlabelled, the class
prior, is estimated first: among the documents that a plain positive-against-
unlabelled model ranks highest hardly any is bad, so there the unlabelled
share divided by the positives' share is the prior. The model then minimises
the non-negative unbiased risk: the loss of positives, plus the loss of the
unlabelled as negatives less what the positives among them account for, which
may not fall below zero.

A document is a fixed number of measures of its whole text, made by built-in
functions; the model is a sum of one weight for each measure's interval.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.language import crc_of_id
from panelloom.llm.registry import query, table
from panelloom.llm.shared import trimmed

POSITIVES, UNLABELLED = 10_000, 20_000  # rows of the fit, at most; its bound
GOOD_FROM = 0.3
INTERVALS = 16  # of each measure
L2, SMOOTH, STEPS, RATE = 1e-6, 3e-4, 1500, 0.1  # weights of neighbouring intervals are drawn together
DELTA = 0.1  # the prior's bounds hold with this probability of error
_SPACE = r"[\x20\x09-\x0D]+"


def measures(text: Column) -> dict[str, Column]:
    """What a text, not null, looks like; shares are of its characters, words or lines."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda w: F.trim(w) != "")
    n_chars, n_words, n_lines = F.length(text), F.size(words), F.size(lines)
    share = lambda n, of: F.when(of > 0, n / of).otherwise(0.0)
    # characters of a class, told from how much shorter the text is without them; the root tells small shares apart
    without = lambda pattern: F.sqrt(share(n_chars - F.length(F.regexp_replace(text, pattern, "")), n_chars))
    return {
        "words": F.log1p(n_words.cast("double")),
        "distinct": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), n_lines),
        "word_length": share(n_chars, n_words),
        "line_length": F.log1p(share(n_chars, n_lines)),
        "capitals": without(r"\p{Lu}+"),
        "digits": without(r"\p{N}+"),
        "symbols": without(r"[\p{S}#%&*@/\\_|]+"),
        "stops": without(r"[.,;:]+"),
        "calls": without(r"[!?]+"),
        "brackets": without(r"[\p{Ps}\p{Pe}\"']+"),
        "spaces": without(r"\s+"),
    }


MEASURES = ["words", "distinct", "distinct_lines", "word_length", "line_length", "capitals", "digits", "symbols", "stops", "calls",
            "brackets", "spaces"]


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``measures``, an array of doubles off the whole text; a null text is empty."""
    found = measures(F.coalesce("text", F.lit("")))
    return docs.withColumn("measures", F.array(*[found[m].cast("double") for m in MEASURES]))


@dataclass(frozen=True)
class Model:
    prior: float
    edges: np.ndarray  # by measure, the upper bounds of its intervals but the last
    weights: np.ndarray  # by measure and interval
    bias: float

    def places(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], 1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        at = self.places(x)
        return self.bias + self.weights[np.arange(at.shape[1]), at].sum(1) if len(x) else np.zeros(0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _loss(z: np.ndarray) -> float:
    """Mean logistic loss of positives with logits ``z``; of negatives it is the one of ``-z``."""
    return float(np.logaddexp(0, -z).mean())


def risk(z_positive: np.ndarray, z_unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """The positive and the negative part of the unbiased risk; the latter counts as 0 where it is below."""
    return prior * _loss(z_positive), _loss(-z_unlabelled) - prior * _loss(-z_positive)


def _edges(x: np.ndarray) -> np.ndarray:
    """Interval bounds of each measure: half of them even in rank, half even in value, so that rare extremes stand apart."""
    ranks = np.quantile(x, np.linspace(0, 1, INTERVALS // 2 + 1)[1:-1], axis=0)
    low, high = x.min(0), x.max(0)
    steps = low + (high - low) * np.linspace(0, 1, INTERVALS // 2 + 2)[1:-1, None]
    return np.sort(np.concatenate([ranks, steps]), 0).T


def minimised(positive: np.ndarray, unlabelled: np.ndarray, prior: float, edges: np.ndarray, plain: bool = False) -> Model:
    """The model of least risk by full gradient steps; with ``plain``, unlabelled rows are taken as negatives as they are.

    Where the negative part of the risk has fallen below zero, the step goes
    against its gradient alone, which undoes the overfitting.
    """
    model = Model(prior, edges, np.zeros((len(edges), edges.shape[1] + 1)), 0.0)
    at_p, at_u = model.places(positive), model.places(unlabelled)
    column, width = np.arange(len(edges)), edges.shape[1] + 1
    flat_p, flat_u = at_p + column * width, at_u + column * width
    w, bias = np.zeros(len(edges) * width), 0.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sums = lambda flat, r: np.append(np.bincount(flat.ravel(), np.repeat(r, flat.shape[1]), len(w)), r.sum())
    for step in range(1, STEPS + 1):
        z_p, z_u = bias + w[flat_p].sum(1), bias + w[flat_u].sum(1)
        as_negative = sums(flat_u, _sigmoid(z_u) / len(z_u))
        if plain:
            slope = sums(flat_p, -_sigmoid(-z_p) / len(z_p)) + as_negative
        else:
            below = as_negative - prior * sums(flat_p, _sigmoid(z_p) / len(z_p))
            slope = prior * sums(flat_p, -_sigmoid(-z_p) / len(z_p)) + below
            if risk(z_p, z_u, prior)[1] < 0:
                slope = -below
        grid = w.reshape(len(edges), width)
        uneven = np.pad(np.diff(grid, axis=1), ((0, 0), (1, 1)))
        slope += np.append(L2 * w - SMOOTH * np.diff(uneven, axis=1).ravel(), 0.0)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return Model(prior, edges, w.reshape(len(edges), width), float(bias))


def class_prior(z_positive: np.ndarray, z_unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled rows, off logits of rows that the ranking model has not seen.

    Above a threshold, the unlabelled share divided by the positives' share
    is the prior plus what negatives stand there too; the threshold is the
    one with the smallest upper bound of that ratio.
    """
    if not len(z_positive) or not len(z_unlabelled):
        return 0.5
    cuts = np.unique(z_positive)
    of_p = 1 - np.searchsorted(np.sort(z_positive), cuts, "left") / len(z_positive)
    of_u = 1 - np.searchsorted(np.sort(z_unlabelled), cuts, "left") / len(z_unlabelled)
    off = lambda n: np.sqrt(np.log(4 / DELTA) / (2 * n))
    bound = of_u / of_p + (off(len(z_positive)) + off(len(z_unlabelled))) / of_p
    return float(np.clip((of_u / of_p)[np.argmin(bound)], 0.01, 0.99))


def learned(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """Prior and model of measured rows. Without rows of both kinds, every score is a half."""
    if not len(positive) or not len(unlabelled):
        return Model(0.5, np.zeros((len(MEASURES), 1)), np.zeros((len(MEASURES), 2)), 0.0)
    edges = _edges(np.concatenate([positive, unlabelled]))
    ranking = minimised(positive[::2], unlabelled[::2], 0.5, edges, plain=True)
    prior = class_prior(ranking.logits(positive[1::2]), ranking.logits(unlabelled[1::2]))
    return minimised(positive, unlabelled, prior, edges)


def _sample(docs: DataFrame, n: int, among: DataFrame | None = None) -> np.ndarray:
    """Measures of ``n`` rows of ``docs`` at most, repeated rows once, chosen by a hash of the row; ``among`` has the ids to choose from.

    Only doc_ids and hashes are shuffled, a task hands on ``n`` of them at
    most; the texts of the rows chosen are then looked up and measured where
    they are.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    spot = F.xxhash64("doc_id", "text_key", F.lit(12))
    rows = keyed.select("doc_id", "text_key").distinct()
    if among is not None:
        rows = rows.join(among, "doc_id", "left_semi")
    chosen = rows.orderBy(spot, "doc_id", "text_key").limit(n).select("doc_id", "text_key", spot.alias("spot"))
    found = measured(keyed.join(F.broadcast(chosen), ["doc_id", "text_key"])).select("spot", "doc_id", "text_key", "measures")
    once = found.groupBy("spot", "doc_id", "text_key").agg(F.first("measures").alias("measures"))
    got = sorted((r["spot"], r["doc_id"], r["text_key"], r["measures"]) for r in once.collect())
    return np.array([r[3] for r in got], np.float64).reshape(len(got), len(MEASURES))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """The model of ``docs`` (doc_id, text), positives being those that ``labels`` (doc_id, quality) gives quality 1.

    At most ``positives`` and ``unlabelled`` rows are measured, and only their
    measures reach the driver, a fixed number of doubles a row whatever the
    texts. Other labels are not used. Rows without doc_id and labels without
    document teach nothing.
    """
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return learned(_sample(docs, positives, good), _sample(docs, unlabelled))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("measures")
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(MEASURES))
            scores = pa.array(_sigmoid(model.logits(x)), pa.float64())
            kept = [n for n in batch.schema.names if n != "measures"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), scores], names=[*kept, "score"])

    return trimmed(run)


def score(docs: DataFrame, model: Model, threshold: float = GOOD_FROM) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text); predicted is 1 from ``threshold`` on.

    The score is the chance of being good. Only ``text`` is looked at, the
    whole of it; a null text is empty and gets the score of one. Repeated rows
    score alike, an empty table gives no rows, further columns are ignored.
    """
    rows = measured(docs.select("doc_id", "text")).select("doc_id", "measures")
    schema = docs.select("doc_id").schema.add("score", "double")
    return rows.mapInArrow(_scored(model), schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query("op12_pu_quality")
def op12_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id(5) == 0
    model = fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
