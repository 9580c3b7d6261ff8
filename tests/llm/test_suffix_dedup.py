from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.llm import anchors, loser_tree, suffix_dedup

LENGTH = anchors.LENGTH


def brute(rows):
    """Removed runs of each row."""
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (t or "").encode()
        for p in range(len(data) - LENGTH + 1):
            first.setdefault(data[p : p + LENGTH], i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        hit = bytearray(len(data))
        for p in range(len(data) - LENGTH + 1):
            if i is not None and first[data[p : p + LENGTH]] < i:
                hit[p : p + LENGTH] = b"\1" * LENGTH
        edges = np.flatnonzero(np.diff(np.r_[0, np.frombuffer(bytes(hit), np.uint8), 0]))
        out.append((i, len(data), edges.reshape(-1, 2).tolist(), bytes(c for c, h in zip(data, hit) if not h)))
    return out


def found(table):
    return sorted(
        ((r.doc_id, r.n_bytes, [[s.start, s.stop] for s in r.spans], bytes(r.kept)) for r in table.collect()), key=repr
    )


@pytest.mark.parametrize("chunk,hot", [(1 << 20, 64), (3000, 64), (3000, 1)])
def test_against_all_windows(spark, documents, chunk, hot):
    rnd = random.Random(chunk + hot)
    passages = ["".join(rnd.choice("abé \0") for _ in range(rnd.choice([40, 50, 51, 80, 300]))) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [rnd.choice(passages) if rnd.random() < 0.6 else "".join(rnd.choice("xyzß ") for _ in range(30)) for _ in range(rnd.randrange(8))]
        rows.append((rnd.randrange(10_000) * 100 + i, "".join(parts)))
    rows += [(7, None), (8, ""), (9, "a" * 49), (10, "a" * 50), (11, "a" * 400), (5, "a" * 120), (rows[0][0], rows[0][1])]
    rows += [(None, rows[1][1]), (None, None), (1_000_001, "q" + rows[3][1] * 3)]
    got = suffix_dedup.cut_repeats(documents(rows, "spans int, other string"), chunk, hot)
    assert found(got) == sorted(brute(rows), key=repr)
    assert got.columns == ["doc_id", "other", "n_bytes", "spans", "kept"]


def test_many_buckets_and_blobs(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", 500)
    monkeypatch.setattr(suffix_dedup, "PARTITION", 4_000)
    rows = [(i, prose(i % 9, 60) + prose(100 + i % 31, 25) + str(i)) for i in range(120)]
    assert found(suffix_dedup.cut_repeats(documents(rows), 2_000, 4, outbox=3_000)) == sorted(brute(rows), key=repr)


def test_long_text_and_empty_table(spark, documents, prose):
    long = prose(4, 200_000)
    rows = [(1, prose(9, 40)), (2, long), (3, "head " + long[1000:5000] + " tail")]
    got = found(suffix_dedup.cut_repeats(documents(rows)))
    assert got[2][2] and b"head" in got[2][3] and len(got[2][3]) < 60 and got[1][2] == []
    assert suffix_dedup.cut_repeats(documents([])).collect() == []


def test_texts_stay_text(spark, documents):
    passage = "é" * 40
    rows = [(1, passage), (2, "a" + "é" * 26), (3, None)]
    docs = documents(rows)
    got = suffix_dedup.without_repeats(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: passage, 2: "a", 3: ""}


def test_hash_column_of_the_query(spark, documents):
    kept = suffix_dedup.cut_repeats(documents([(1, "x" * 60), (2, "y" + "x" * 60)])).collect()
    assert {hashlib.sha256(r.kept).hexdigest() for r in kept} == {hashlib.sha256(x).hexdigest() for x in (b"x" * 60, b"y")}


def test_anchors_of_equal_windows_agree(monkeypatch):
    rnd = random.Random(2)
    for part in (64, 1 << 20):
        monkeypatch.setattr(anchors, "PART", part)
        texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.choice([0, 10, 49, 50, 51, 120, 400]))) for _ in range(10)]
        texts.append(b"a" * 300)
        data, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        a = anchors.find(data, starts)
        place = {}
        for at, first, last, text in zip(a.at, a.first, a.last, a.text):
            assert first <= last <= at and at + anchors.GRAM <= first + LENGTH
            for p in range(first, last + 1):
                assert p not in place and starts[text] <= p and p + LENGTH <= starts[text + 1]
                place[p] = at - p
        assert len(place) == sum(max(len(t) - LENGTH + 1, 0) for t in texts)
        by_window = {}
        for p, offset in place.items():
            assert by_window.setdefault(data[p : p + LENGTH].tobytes(), offset) == offset


def test_merge_keeps_order_and_shared_lengths():
    rnd = random.Random(5)
    for _ in range(60):
        runs = []
        for _ in range(rnd.randint(1, 9)):
            strings = sorted(bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(0, 20)))
            matrix = np.zeros((len(strings), 12), np.uint8)
            for i, s in enumerate(strings):
                matrix[i, : len(s)] = list(s)
            run = loser_tree.decode(*loser_tree.front_code(matrix, np.array([len(s) for s in strings], np.int64)))
            assert run[0] == strings
            runs.append(run)
        source, shared = loser_tree.merge(runs)
        place, out = [0] * len(runs), []
        for r in source:
            out.append(runs[r][0][place[r]])
            place[r] += 1
        assert out == sorted(s for r in runs for s in r[0])
        for a, b, n in zip(out, out[1:], shared[1:]):
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def exchanged(spark, rows, chunk, outbox=suffix_dedup.OUTBOX, parts=6):
    """Blobs, their bytes and the suffixes in them, as the exchange gets them; one task makes all."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    chunks = docs.mapInArrow(suffix_dedup._chunks(chunk), "chunk long, size long, docs binary").collect()
    table = spark.createDataFrame([(c.chunk, c.docs) for c in chunks], "chunk long, docs binary").coalesce(1)
    dealt = table.mapInArrow(suffix_dedup._deal_grams(parts, 32), "part int, chunk long, n int, grams binary").repartitionById(parts, "part")
    answers = dealt.mapInArrow(suffix_dedup._answer_grams, "chunk long, part int, answer binary").groupBy("chunk")
    answers = answers.agg(F.collect_list(F.struct("part", "answer")).alias("answers"))
    asked = table.join(answers, "chunk", "left").coalesce(1)
    sent = asked.mapInArrow(suffix_dedup._deal_suffixes(parts, 10 * parts, 32, outbox), "part int, chunk long, blob binary")
    runs = sent.where("chunk is null").collect()
    suffixes = sum(len(suffix_dedup._unpacked(bytes(r.blob), suffix_dedup.RUNS)[4]) for r in runs)
    return len(chunks), len(runs), sum(len(r.blob) for r in runs), suffixes


def test_exchange_does_not_grow_with_the_number_of_chunks(spark, prose):
    """The same texts in 20 and in 200 chunks: as many blobs, and bytes by the suffixes sent."""
    rows = [(i, prose(i % 300, 120) + " " + prose(10_000 + i, 120)) for i in range(1_200)]
    size = sum(len(t.encode()) for _, t in rows)
    few, many = exchanged(spark, rows, -(-size // 20)), exchanged(spark, rows, -(-size // 200))
    assert 19 <= few[0] <= 22 and 190 <= many[0] <= 240
    assert few[1] == many[1] == 6  # one blob a partition
    assert many[2] / many[3] < 1.6 * few[2] / few[3]
    assert exchanged(spark, rows, -(-size // 200), outbox=1)[1] > 600  # unless each chunk sends its own


def test_partitions_follow_bytes(spark):
    table = lambda n, size: spark.createDataFrame([(size,)] * n, "size long")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert suffix_dedup._dealing(spark, table(1, 10)) == (least, least)
    parts, buckets = suffix_dedup._dealing(spark, table(500, 8 << 20))
    assert parts == 250 and buckets % parts == 0 and buckets * suffix_dedup.BUCKET >= 500 * (8 << 20)
    assert suffix_dedup._dealing(spark, table(5_000, 8 << 20))[0] == 2_500


def test_blobs_round_trip():
    rnd = np.random.default_rng(3)
    arrays = [rnd.integers(0, 200, n).astype(k) for n, k in zip((0, 5, 1, 7), (np.uint8, np.int64, np.int32, np.int64))]
    back = suffix_dedup._unpacked(suffix_dedup._packed(*arrays), [a.dtype.type for a in arrays])
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, back))
