"""The classifier against plain re-computation, its risk against nudged weights, and held-out labels."""

from __future__ import annotations

import re
import zlib
from dataclasses import replace

import numpy as np

from panelloom.llm import pu_quality as pq
from panelloom.llm import registry
from panelloom.llm.registry import table

SF_DIR = "/root/testdata/sf0.1"


def plain_measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [w for w in text.split("\n") if w.strip(" ")]
    n = len(text)
    share = lambda a, b: a / b if b else 0.0
    of = lambda pattern: share(sum(map(len, re.findall(pattern, text))), n) ** 0.5
    return [
        np.log1p(len(words)), share(len(set(words)), len(words)), share(len(set(lines)), len(lines)), share(n, len(words)),
        np.log1p(share(n, len(lines))), of("[A-ZÉÄ]+"), of("[0-9]+"), of(r"[#%&*@/\\_|$<=>^~+`]+"), of("[.,;:]+"), of("[!?]+"),
        of(r"[\[\](){}\"']+"), of(r"[ \t\n\x0b\f\r]+"),
    ]


def mixed(spark, n=600, bad=0.3, seed=4):
    rnd = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        junk = rnd.random() < bad
        words = [f"w{k}" for k in rnd.integers(0, 900, 60)]
        docs.append((i, " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words) + ".", "x", 0.5))
        if not junk and rnd.random() < 0.5:
            labels.append((i, 1, "t"))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, measures string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, text string"),
    )


def test_measures_of_whole_texts(spark):
    texts = [None, "", " \n", "Ab ab, CD! 12\n\nÉé (x) [y] \"z\"\nab", "a | b # $ % & *\n\n\nline\nline", "x" * 500_000 + " y", "word, " * 200_000 + "!!!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pq.measured(docs).collect():
        assert np.allclose(row.measures, plain_measures(row.text), atol=1e-12), row.doc_id


def test_prior_is_found_and_junk_told(spark):
    docs, labels = mixed(spark)
    model = pq.fit(docs, labels)
    assert abs(model.prior - 0.7) < 0.07
    got = pq.score(docs, model)
    assert got.columns == ["doc_id", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    for r in docs.collect():
        assert rows[r.doc_id].predicted == int("!!" not in r.text) == int(rows[r.doc_id].score >= 0.3)


def test_scores_are_the_models(spark):
    docs, labels = mixed(spark, n=200)
    model = pq.fit(docs, labels)
    texts = [None, "", "A plain text.", "A plain text.", "!!! " * 100_000]
    odd = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, measures string")
    got = [r.score for r in sorted(pq.score(odd, model).collect(), key=lambda r: r.doc_id)]
    for text, found in zip(texts, got):
        z = model.bias + sum(model.weights[k][sum(e < v for e in model.edges[k])] for k, v in enumerate(plain_measures(text)))
        assert abs(found - 1 / (1 + np.exp(-z))) < 1e-9
    assert got[0] == got[1] and got[2] == got[3]
    assert pq.score(odd.limit(0), model).collect() == []


def test_risk_is_near_its_least(spark):
    rnd = np.random.default_rng(1)
    good, bad = rnd.normal(0.25, 1, (3_000, 12)), rnd.normal(-0.25, 1, (900, 12))  # they overlap, so the least risk is not zero
    positive, unlabelled = good[:1_000], np.concatenate([good[1_000:], bad])
    edges = pq._edges(np.concatenate([positive, unlabelled]))
    prior = 2_000 / 2_900
    model = pq.minimised(positive, unlabelled, prior, edges)

    def total(m):
        a, b = pq.risk(m.logits(positive), m.logits(unlabelled), prior)
        return a + max(b, 0) + pq.L2 / 2 * (m.weights**2).sum() + pq.SMOOTH / 2 * (np.diff(m.weights, axis=1) ** 2).sum()

    least = total(model)
    assert least < total(pq.minimised(positive, unlabelled, prior, edges, plain=True))
    for k in range(12):
        for by in (-0.5, 0.5):
            weights = model.weights.copy()
            weights[k] += by * np.sign(np.arange(weights.shape[1]) - weights.shape[1] / 2)
            assert total(replace(model, weights=weights)) > least - 1e-4
    assert total(replace(model, bias=model.bias + 0.5)) > least


def test_prior_of_known_mixtures():
    rnd = np.random.default_rng(7)
    for prior in (0.2, 0.5, 0.9):
        positive = rnd.normal(2, 1, 4_000)
        unlabelled = np.where(rnd.random(8_000) < prior, rnd.normal(2, 1, 8_000), rnd.normal(-2, 1, 8_000))
        assert abs(pq.class_prior(positive, unlabelled) - prior) < 0.04
    assert pq.class_prior(np.zeros(0), np.zeros(3)) == 0.5


def test_sample_is_bounded_whatever_repeats(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i % 5}") for i in range(900)] + [(None, "x"), (7, None)], "doc_id long, text string")
    kept = docs.where("doc_id is not null")
    assert len(pq._sample(kept, 6)) == 6 and len(pq._sample(kept, 100)) == 16  # 15 different rows and the null text
    assert np.array_equal(pq._sample(kept, 10), pq._sample(kept.repartition(7), 10))
    labels = spark.createDataFrame([(0, 1), (0, 1), (None, 1), (55, 1)], "doc_id long, quality int")
    assert 0 < pq.fit(docs, labels).prior < 1
    nothing = pq.fit(docs, labels.limit(0))
    assert {r.score for r in pq.score(docs, nothing).collect()} == {0.5}
    assert pq.fit(docs.limit(0), labels).prior == 0.5


def test_held_out_quality(spark):
    got = registry.QUERIES["op12_pu_quality"](spark, SF_DIR)
    rows = got.join(table(spark, SF_DIR, "labels"), "doc_id").collect()
    assert got.count() == table(spark, SF_DIR, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held_out = [r for r in rows if r.held_out]
    good, bad = [r for r in held_out if r.quality], [r for r in held_out if not r.quality]
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(r.predicted for r in bad) <= 0.2 * len(bad)
    better = np.array([r.score for r in good])[:, None] > np.array([r.score for r in bad])
    assert better.mean() > 0.99
