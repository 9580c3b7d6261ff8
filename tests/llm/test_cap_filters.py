from __future__ import annotations

import math

import numpy as np

from panelloom.llm import cap_filters

SCHEMA = "vec_id long, embedding array<float>, label int, size string, node string, copies string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, None, None, None) for i, v, y in rows], SCHEMA)


def brute(rows, cosine=0.98):
    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        x = np.array(v, np.float32).astype(float)
        return x / np.linalg.norm(x) if np.linalg.norm(x) else None

    units = [unit(v) for _, v, _ in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            x, y = units[a], units[b]
            if x is not None and y is not None and rows[a][2] is not None and rows[a][2] == rows[b][2]:
                if len(x) == len(y) and x @ y >= cosine:
                    links[a] += 1
                    links[b] += 1
                    parent[root(a)] = root(b)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        low.setdefault(root(k), []).extend([] if i is None else [i])
    return sorted(((i, links[k], min(low[root(k)], default=None)) for k, (i, _, _) in enumerate(rows)), key=repr)


def found(got):
    rows = got.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr)


def clusters(n, size=64, seed=1):
    rng = np.random.default_rng(seed)
    rows, centre = [], None
    for i in range(n):
        if i % 12 == 0:
            centre = rng.normal(size=size)
        v = centre + rng.normal(size=size) * rng.choice([0.0, 0.05, 0.1, 0.14, 0.2])
        rows.append((1000 - i, [float(x) for x in np.float32(v)], int(i // 24 % 3)))
    return rows


def test_against_all_pairs(spark):
    rows = clusters(360)
    assert found(cap_filters.near_vectors(table(spark, rows))) == brute(rows)


def test_large_cluster_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=32)
    rows = [(i, [float(x) for x in np.float32(centre + 0.1 * rng.normal(size=32))], 7) for i in range(150)]
    assert found(cap_filters.near_vectors(table(spark, rows))) == brute(rows)


def test_odd_vectors_repeats_and_empty(spark):
    v, w = [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 3.0], 1), (5, [1.0, float("nan"), 3.0], 1),
        (6, [1.0, float("inf"), 3.0], 1), (7, v, None), (8, v, 1), (8, v, 1), (9, w, 1), (10, v, 2), (11, v + [0.0], 1),
        (None, w, 1), (None, [3.0, -2.0, 1.0], 1), (12, [1e-30, 0.0, 0.0], 3), (13, [1e30, 0.0, 0.0], 3),
    ]
    assert found(cap_filters.near_vectors(table(spark, rows))) == brute(rows)
    assert cap_filters.near_vectors(table(spark, [])).collect() == []


def test_recall_of_directions_at_the_threshold():
    rng = np.random.default_rng(3)
    code = cap_filters._Code(64, 128)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * z
    met = [bool(set(a) & set(b)) for a, b in zip(code.directions(x), code.directions(y))]
    assert np.mean(met) > 0.999


def test_very_small_and_very_large_numbers(spark):
    rows = [(1, [1e-200, 2e-200], 1), (2, [2e-200, 4e-200], 1), (3, [1e200, 2e200], 1), (4, [5e-324, 1e-323], 1), (5, [1e308, -1e308], 1)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found(cap_filters.near_vectors(wide)) == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1), (5, 0, 5)]


def test_hot_direction_is_sent_in_few_copies(spark, monkeypatch):
    """Blocks grow with their direction, and tiles of a block find chains that run through several of them."""
    monkeypatch.setattr(cap_filters, "BLOCK", 8)
    turn = [(i, [math.cos(i * 0.004), math.sin(i * 0.004)], 1) for i in range(300)]
    rows = [(i, [float(x) for x in np.float32(v)], y) for i, v, y in turn]
    assert found(cap_filters.near_vectors(table(spark, rows))) == brute(rows)
    sizes = [(100, 64, 80), (10_000, 64, 800), (4_000_000, 64, 8192), (4_000_000, 4096, 2048)]
    df = spark.createDataFrame(sizes, "n long, size int, wanted long")
    assert all(r.wanted == r.b for r in df.withColumn("b", cap_filters._block_size(df["n"], df["size"])).collect())
