"""The audit against a plain replay of every order."""

from __future__ import annotations

import random
import re
from itertools import permutations

from panelloom.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def replayed(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in docs) else set()
        rows.append((doc_id, lang or "", fails))
    out = []
    for part in {p for _, p, _ in rows}:
        mine = [(i, f) for i, p, f in rows if p == part]
        removed = {}
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                lost = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                failing = sum(letter in f for _, f in mine)
                only = sum(f == {letter} for _, f in mine)
                out.append((part, "".join(order), step, len(left), len(lost), failing - len(lost), only, sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)))
                removed[letter] = removed.get(letter, 0) + len(lost)
        out = [r if r[0] != part or len(r) > 9 else (*r, removed[r[1][r[2] - 1]]) for r in out]
    return sorted(out)


def audit(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, lang string, n long, fails string").repartition(4)
    l = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit_filters(d, l)
    assert sorted(got.columns) == sorted(COLUMNS)
    return sorted(tuple(r[c] for c in COLUMNS) for r in got.collect())


def test_every_order(spark):
    rnd = random.Random(3)
    long = " ".join(f"word{i}" for i in range(250))
    texts = [None, "", "a", long, long + " #", "same " * 220, "LOUD " * 220, long.upper(), "a b c", "é" * 300, long.replace(" ", "\x0b\n"), "|"]
    docs = [(i, rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for i in range(120)]
    docs += [(5, long, "en"), (5, long, "en"), (5, "other", "de"), (None, long, "en"), (None, "", None), (500, "word " * 300_000, "xx")]
    docs += [(1_000 + i, "one text of a third of all rows", "en") for i in range(60)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 140, 2)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1), (9_999, 1, 1)]
    assert audit(spark, docs, labels) == replayed(docs, labels)


def test_empty_tables(spark):
    assert audit(spark, [], [(1, 1, 1)]) == []
    got = audit(spark, [(1, "a", "en")], [])
    assert len(got) == 600 and got == replayed([(1, "a", "en")], [])


def test_only_smaller_ids_make_a_copy(spark):
    d = spark.createDataFrame([(3, "x", "a"), (2, "x", "b"), (2, "x", "b"), (9, "y", "a"), (None, "x", "a")], "doc_id long, text string, lang string")
    got = {(r.doc_id, r.part): ("E" in r.fails, r.n) for r in filter_audit.failures(d).collect()}
    assert got == {(3, "a"): (True, 1), (2, "b"): (False, 2), (9, "a"): (False, 1), (None, "a"): (False, 1)}
