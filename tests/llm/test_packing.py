from __future__ import annotations

import random
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, "<|endoftext|> in a text", "a b   c", "tab\t\ttab  \n\n x", "don't we'll I'VE", "日本語 text ſ ŉ", "\x1c\x1d a\x85b", "🙂 🙂"]


def test_pieces_round_trip(spark, documents, prose):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(i, prose(i, 7 * i)) for i in range(40)] + [(100 + i, t) for i, t in enumerate(ODD)]
    rows += [(200, prose(3, 30_000)), (None, "no id"), (201, "twice"), (201, "twice")]
    pieces = packing.token_pieces(documents(rows), *packing.public_vocabulary(), capacity=64).collect()
    by = defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by[i], key=lambda p: p.start)[:: 2 if i == 201 else 1]
        assert [p.piece for p in own] == list(range(len(own)))
        assert [x for p in own for x in struct.unpack(f"<{p.length}I", p.ids)] == ids
        assert all(p.length == 64 for p in own[1:]) and sum(p.length for p in own) == len(ids)


@pytest.mark.parametrize("capacity", [64, 1024])
def test_places_have_no_gaps(spark, capacity):
    rnd = random.Random(capacity)
    rows = [(i, k, rnd.choice([1, 2, capacity // 3, capacity // 2 + 1, capacity, rnd.randrange(1, capacity)]), "x") for i in range(300) for k in range(2)]
    rows += [(7, 0, 5, "again")] * 50 + [(None, 0, 3, "no id")] * 2
    table = spark.createDataFrame(rows, "doc_id long, piece int, length long, nth string")
    got = packing.pack_pieces(table, capacity)
    assert got.columns == ["doc_id", "piece", "length", "nth", "sequence_id", "offset"]
    got = got.collect()
    assert Counter((r.doc_id, r.piece, r.length, r.nth) for r in got) == Counter(rows)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == packed_one_by_one([r[2] for r in rows], capacity)


def packed_one_by_one(lengths, capacity):
    """Bins of the same rule, one at a time: the longest piece left and the fullest combination with it."""
    left, bins = Counter(lengths), 0
    while left := +left:
        longest = max(left)
        left[longest] -= 1
        left -= Counter(packing.fullest(left, capacity - longest))
        bins += 1
    return bins


def test_fills_are_close_to_the_least_possible():
    rnd = random.Random(4)
    counts = Counter(min(1024, max(1, int(rnd.lognormvariate(5.5, 1)))) for _ in range(20_000))
    bins = sum(times for _, times in packing.plan(counts))
    least = -(-sum(n * c for n, c in counts.items()) // 1024)
    assert least <= bins <= least * 1.001 + 1


def test_both_libraries_give_the_same_ids():
    slow, fast = packing.Encoder(PATH), packing.Encoder(*packing.public_vocabulary())
    rnd = random.Random(12)
    chars = [chr(c) for c in range(0x180)]
    texts = [a + b for a in chars for b in rnd.sample(chars, 12)]
    texts += [a + " " + b + "\n\n " + a for a, b in zip(chars, rnd.sample(chars, len(chars)))]
    texts += ["".join(rnd.choice(chars + [" ", " ", "e", "t", "'s"] * 40) for _ in range(300)) for _ in range(300)]
    for text in texts:
        assert fast.ids(text) == slow.ids(text), repr(text)


def test_empty_table(spark, documents):
    pieces = packing.token_pieces(documents([]), *packing.public_vocabulary())
    assert packing.pack_pieces(pieces).collect() == []


def test_fullest_is_best_of_all_combinations():
    rnd = random.Random(6)
    for _ in range(150):
        lengths = [rnd.randrange(1, 40) for _ in range(rnd.randrange(1, 9))]
        room = rnd.randrange(1, 90)
        sums = {0}
        for n in lengths:
            sums |= {s + n for s in sums}
        picked = packing.fullest(Counter(lengths), room)
        assert sum(picked) == max(s for s in sums if s <= room)
        assert not Counter(picked) - Counter(lengths)


def test_plan_is_bounded_and_uses_every_piece():
    counts = {n: 10**12 // n for n in range(1, 1025)}
    entries = packing.plan(counts)
    used = Counter()
    for combination, times in entries:
        assert sum(combination) <= 1024 and times > 0
        for n in combination:
            used[n] += times
    assert used == counts and len(entries) < 1024 * 9
