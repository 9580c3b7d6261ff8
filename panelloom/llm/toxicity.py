"""Toxicity scores by a counterfactual-regularised linear classifier.

A text is the set of its words and word beginnings, hashed. A logistic model
is fitted with an L1 penalty on a bounded sample of labelled documents. For
labelled texts that mention an identity term, the same text with the terms of
its group exchanged is a counterfactual; the squared change of the score
between the two is penalised, so that mentioning a group does not count by
itself.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm.language import crc_of_id
from panelloom.llm.registry import query, table
from panelloom.llm.shared import trimmed

ROWS_PER_LABEL = 3_000  # labelled documents of each label in the fit, at most; with the next two the bound of the fit
CHARS_PER_LABEL = 64_000_000  # characters of their texts, all together
LONGEST = 1_000_000  # characters of a text that is learned from
BITS = 22
BEGINNINGS = (4, 5, 6)
L1, FAIRNESS, STEPS = 2e-3, 4.0, 400
TOXIC_FROM = 0.7
REMEMBERED = 300_000  # words whose features a worker keeps

# Identity terms by group; a term is exchanged for the next one of its group.
GROUPS = [
    ["women", "men"],
    ["woman", "man"],
    ["girls", "boys"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    ["black", "white", "asian", "latino"],
    ["gay", "straight", "lesbian", "bisexual"],
    ["immigrants", "natives", "refugees"],
    ["frauen", "männer"],
    ["christen", "muslime", "juden"],
    ["femmes", "hommes"],
    ["chrétiens", "musulmans", "juifs"],
    ["mujeres", "hombres"],
    ["cristianos", "musulmanes", "judíos"],
]

_WORD = re.compile(r"\w+")


def features_of(word: str) -> tuple[int, ...]:
    mask = (1 << BITS) - 1
    names = [f"w {word}", *(f"b {word[:n]}" for n in BEGINNINGS if len(word) >= n)]
    return tuple(zlib.crc32(n.encode("utf-8", "replace")) & mask for n in names)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def exchanged(words: set[str], groups: list[list[str]]) -> set[str] | None:
    """The words with every identity term exchanged, or None if there is none."""
    follower = {term: group[(k + 1) % len(group)] for group in groups for k, term in enumerate(group)}
    if not any(w in follower for w in words):
        return None
    return {follower.get(w, w) for w in words}


def _featured(groups: list[list[str]]):
    def features(words: set[str]) -> list[int]:
        return sorted({f for w in words for f in features_of(w)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            real, swapped = [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                other = exchanged(words, groups)
                real.append(features(words))
                swapped.append(features(other) if other is not None else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(real, kind), pa.array(swapped, kind)],
                names=["label", "real", "swapped"],
            )

    return trimmed(run)


class _Sparse:
    """0/1 rows as column numbers, with the two products that a gradient needs."""

    def __init__(self, rows: list[np.ndarray], columns: int):
        self.flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.shape = (len(rows), columns)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, w[self.flat], self.shape[0])

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, r[self.owner], self.shape[1])


Model = tuple[float, dict[int, float]]


def train(
    labels: np.ndarray, real: list[np.ndarray], swapped: list[np.ndarray | None], fairness: float = FAIRNESS
) -> Model:
    """Bias and non-zero weights. Labels weigh alike whatever their numbers; with one label only, a constant."""
    n = len(labels)
    if not n or labels.min() == labels.max():
        rate = float(labels.mean()) if n else 0.5
        return math.log((rate + 0.01) / (1.01 - rate)), {}
    weight = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    # a feature whose documents weigh no more than the penalty would keep weight 0
    most = np.bincount(np.concatenate(real), np.repeat(weight, [len(r) for r in real]), 1 << BITS)
    used = np.flatnonzero(most > L1)
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))

    def rows(lists: list[np.ndarray]) -> _Sparse:
        return _Sparse([p[p >= 0] for p in (place[x] for x in lists)], len(used))

    x = rows(real)
    pairs = [i for i, s in enumerate(swapped) if s is not None]
    a, b = rows([real[i] for i in pairs]), rows([swapped[i] for i in pairs])
    w, bias, seen, seen_bias = np.zeros(len(used)), 0.0, np.full(len(used), 1e-8), 1e-8
    for _ in range(STEPS):
        error = (1 / (1 + np.exp(-np.clip(x.times(w) + bias, -40, 40))) - labels) * weight
        slope = x.back(error)
        if pairs:
            change = (a.times(w) - b.times(w)) * (2 * fairness / len(pairs))
            slope += a.back(change) - b.back(change)
        seen += slope**2
        rate = 0.5 / np.sqrt(seen)
        w = w - rate * slope
        w = np.sign(w) * np.maximum(np.abs(w) - rate * L1, 0)
        seen_bias += error.sum() ** 2
        bias -= 0.5 / math.sqrt(seen_bias) * error.sum()
    some = np.flatnonzero(w)
    return float(bias), dict(zip(used[some].tolist(), w[some].tolist()))


def fit(docs: DataFrame, labels: DataFrame, groups: list[list[str]] = GROUPS, per_label: int = ROWS_PER_LABEL) -> Model:
    """The model of ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic).

    At most ``per_label`` documents of each label, chosen by a hash, and at
    most ``CHARS_PER_LABEL`` of their text are turned into features by tasks;
    only the features reach the driver. Rows that repeat doc_id and text count
    once. Rows without label or doc_id, labels without document and texts
    beyond ``LONGEST`` teach nothing; a document with several labels is taken
    with each.
    """
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).where("label in (0, 1)").distinct()
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    rows = keyed.select("doc_id", "text_key", F.coalesce(F.length("text"), F.lit(0)).alias("n")).where(F.col("n") <= LONGEST).distinct()
    # the rank is limited in every task before rows are shuffled
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("doc_id", "text_key", F.lit(3)), "doc_id", "text_key")
    chosen = rows.join(labels, "doc_id").withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= per_label)
    so_far = Window.partitionBy("label").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = chosen.withColumn("total", F.sum("n").over(so_far)).where(F.col("total") <= CHARS_PER_LABEL)
    # 2 * per_label narrow rows at most: small enough to send to every task
    sample = keyed.join(F.broadcast(chosen.select("doc_id", "text_key", "label")), ["doc_id", "text_key"])
    sample = sample.groupBy("label", "doc_id", "text_key").agg(F.first("text").alias("text")).select("label", "text")
    rows = sample.mapInArrow(_featured(groups), "label int, real array<int>, swapped array<int>").toArrow()
    return train(rows.column("label").to_numpy().astype(np.int64), _lists(rows.column("real")), _lists(rows.column("swapped")))


def _lists(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    """The lists of a column as views of its flat values, null as None."""
    found: list[np.ndarray | None] = []
    for part in column.chunks:
        values, known = part.values.to_numpy(), part.is_valid().to_pylist()
        found += [values[a:b] if there else None for a, b, there in zip(part.offsets[:-1].to_pylist(), part.offsets[1:].to_pylist(), known)]
    return found


def _scored(model: Model):
    bias, weights = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            scores = []
            for text in batch.column("text"):
                present: set[int] = set()
                for word in words_of(text.as_py()):
                    own = known.get(word)
                    if own is None:
                        if len(known) > REMEMBERED:
                            known.clear()
                        own = known[word] = tuple(f for f in features_of(word) if f in weights)
                    present.update(own)
                z = bias + sum(weights[f] for f in sorted(present))
                scores.append(1 / (1 + math.exp(-max(min(z, 40), -40))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in batch.schema.names), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "score"],
            )

    return trimmed(run)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1, higher: more likely toxic) and predicted (1 from 0.7 on).

    Only ``text`` is looked at, the whole of it. A null or empty text has no
    features and gets the model's constant. Repeated rows score alike;
    further columns pass through, but ``score`` and ``predicted`` are replaced.
    """
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields]).add("score", "double")
    scored = docs.mapInArrow(_scored(model), schema)
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


@query("op9_counterfactual_toxicity")
def op9_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id(3) == 1
    model = fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )
