"""Repair plans against a plain search over all edits, the damage against a plain version, whole conversations by hand."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from panelloom.llm import conversation_repair as cr
from panelloom.llm import registry, transfer

SCHEMA = "conv_id long, turn long, role string, text string"
SF_DIR = "/root/testdata/sf0.001"


def faults_of(rows):
    """(kind, fault) of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fault = transfer.BLANK if not bare else transfer.DUPLICATE if (role, text) in seen else transfer.TRUNCATED if bare[-1] not in ".!?" else transfer.OK
        seen.add((role, text))
        out.append(("sua".find(role[0]) if role and role[0] in "sua" else 3, fault))
    return out


def cheapest(turns):
    """(cost, audit) by shortest paths over (turns done, roles so far), where all strings of equal cost are compared."""
    best = {(0, ""): (0, "")}
    shape = re.compile(r"s?(ua)*u?")

    def short(roles):  # only the first and the last role and whether there is a pair matter
        return roles if len(roles) <= 3 else roles[: 1 if roles[0] == "s" else 0] + "ua" + ("u" if roles[-1] == "u" else "")

    def offer(table, n, roles, value):
        key = n, short(roles)
        if shape.fullmatch(roles) and (key not in table or value < table[key]):
            table[key] = value

    def inserted(table):
        for _ in range(3):
            for (n, roles), (cost, audit) in list(table.items()):
                for role in "ua":
                    offer(table, n, roles + role, (cost + 5, audit + "I"))
        return table

    for n, (kind, fault) in enumerate(turns):
        after = {}
        for (_, roles), (cost, audit) in inserted(best).items():
            offer(after, n + 1, roles, (cost + 2, audit + "D"))
            if fault in (transfer.BLANK, transfer.DUPLICATE):
                continue
            more = 5 if fault == transfer.TRUNCATED else 0
            if kind < 3:
                offer(after, n + 1, roles + "sua"[kind], (cost + more, audit + "K"))
            for role in "ua":
                offer(after, n + 1, roles + role, (cost + more + 1, audit + "R"))
        best = after
    return min(v for (_, roles), v in inserted(best).items() if re.fullmatch(r"(s?(ua)+)?", roles))


def applied(rows, audit):
    """The repaired (role, text) rows."""
    out, at, last = [], 0, ""
    for edit in audit:
        new = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append((new, ""))
        else:
            if edit in "KR":
                out.append((rows[at][0] if edit == "K" else new, rows[at][1]))
            at += 1
            if edit == "D":
                continue
        last = out[-1][0][0]
    assert at == len(rows)
    return out


def random_rows(rnd, n):
    return [(rnd.choice(["user", "user", "assistant", "assistant", "system", "tool", ""]), rnd.choice(["", " ", "a.", "b!", "c", "d? \n", f"{rnd.random()}."])) for _ in range(n)]


@pytest.mark.parametrize("rules", [0, 3, 200])
def test_plans_are_the_cheapest(rules):
    rnd = random.Random(rules)
    pairs, made = [], transfer.SYMBOLS
    for _ in range(rules):  # any grammar gives the same results
        pairs.append((rnd.randrange(made), rnd.randrange(made)))
        made += 1
    grammar = transfer.Grammar([[p] for p in pairs])
    for _ in range(400):
        rows = random_rows(rnd, rnd.randrange(9))
        turns = faults_of(rows)
        plan = grammar.plan("".join(chr(transfer.FIRST + transfer.symbol(*t)) for t in turns))
        assert (plan.cost, plan.audit) == cheapest(turns)
        assert (plan.blank, plan.duplicate, plan.truncated) == tuple(sum(f == w for _, f in turns) for w in (2, 3, 1))
        kinds = [k for k, _ in turns]
        assert plan.illegal == sum((a, b) not in {(0, 1), (1, 2), (2, 1)} for a, b in zip(kinds, kinds[1:]))


def test_rules_expand_to_what_they_replace():
    rnd = random.Random(5)
    run = [rnd.choice([0, 0, 4, 8, 15]) for _ in range(300)]
    rounds, table = [], {n: [n] for n in range(transfer.SYMBOLS)}
    left = run
    for _ in range(6):
        counts = {}
        for pair in transfer.counted(left):
            counts[pair] = counts.get(pair, 0) + 1
        chosen = sorted(counts, key=lambda p: (-counts[p], p))[:3]
        numbered = {p: len(table) + k for k, p in enumerate(chosen)}
        for p, n in numbered.items():
            table[n] = table[p[0]] + table[p[1]]
        left = transfer.replaced(left, numbered)
        rounds.append(chosen)
    assert [x for n in left for x in table[n]] == run and len(left) < 150
    assert list(transfer.counted([7, 7, 7, 7, 7])) == [(7, 7), (7, 7)]
    text = "".join(chr(transfer.FIRST + n) for n in run)
    assert transfer.Grammar(rounds).plan(text) == transfer.Grammar([]).plan(text)


def plain(rows):
    """The query's row of each conversation, from (conv_id, turn, role, text)."""
    found = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(name.encode()) % 20
        out = found.setdefault(conv, [])
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        out += [(turn is not None, turn or 0, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    result = []
    for conv, damaged in found.items():
        damaged.sort()
        kept = [(r, t) for _, _, r, t in damaged]
        turns = [t for known, t, _, _ in damaged if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = faults_of(kept)
        cost, audit = cheapest(faults)
        kinds = [k for k, _ in faults]
        illegal = sum((a, b) not in {(0, 1), (1, 2), (2, 1)} for a, b in zip(kinds, kinds[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in applied(kept, audit))
        count = lambda w: sum(f == w for _, f in faults)
        result.append((conv, gaps, count(2), count(3), count(1), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(result, key=repr)


def query_rows(rows):
    damaged = cr.damaged(rows)
    return sorted(map(tuple, cr.repaired_digests(damaged, cr.repair(damaged)).collect()), key=repr)


def test_odd_conversations(spark):
    rnd = random.Random(2)
    rows = [(conv, turn, *one) for conv in range(60) for turn, one in enumerate(random_rows(rnd, rnd.randrange(1, 12)))]
    rows += [(100, t, "user", "again.") for t in range(300)]  # one text many times
    rows += [(101, 1, "user", "x.")] * 40 + [(101, 1, "user", "a.")] * 3  # ties and repeated rows
    rows += [(None, t, "user", "n.") for t in range(4)] + [(102, None, None, None), (102, None, "user", "q"), (102, 7, None, "z.")]
    rows += [(103, 0, "system", "s."), (103, 5, "assistant", "word " * 200_000 + "."), (104, 2**40, "user", "far!"), (104, 0, "unit", "near!")]
    rnd.shuffle(rows)
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", audit string, copies_ int, cost long").repartition(5)
    assert query_rows(table) == plain(rows)
    assert query_rows(table.limit(0)) == []
    assert {r.conv_id for r in cr.repair(cr.damaged(table)).collect()} == {r[0] for r in rows}


def test_dropped_conversations_stay(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = query_rows(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA))
    assert row == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_one_very_long_conversation(spark):
    rows = spark.range(60_000).selectExpr(
        "1L as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role", "concat('t', id, if(id % 7 = 0, '', '.')) as text"
    )
    (row,) = cr.repair(rows).collect()
    turns = [(1 if i % 3 == 0 else 2, transfer.TRUNCATED if i % 7 == 0 else transfer.OK) for i in range(60_000)]
    assert (row.cost, row.audit) == cheapest(turns) and row.truncated == 8572 and row.gaps == 0


def test_repaired_turns(spark):
    rows = spark.createDataFrame(
        [(1, 0, "system", "s."), (1, 1, "tool", "t."), (1, 2, "user", "u."), (2, 0, "assistant", "a."), (3, 4, "user", "cut")], SCHEMA
    )
    planned = cr.repair(rows)
    got = sorted(map(tuple, cr.repaired_turns(rows, planned).collect()), key=lambda r: r[:2])
    by_conv = {}
    for conv, place, edit, turn, role, text in got:
        assert place == len(by_conv.setdefault(conv, []))
        by_conv[conv].append((edit, turn, role, text))
    audits = {r.conv_id: r.audit for r in planned.collect()}
    assert audits == {1: "KRR", 2: "D", 3: "D"}
    assert by_conv == {1: [("K", 0, "system", "s."), ("R", 1, "user", "t."), ("R", 2, "assistant", "u.")]}


def test_query(spark):
    rows = registry.table(spark, SF_DIR, "conversations")
    got = sorted(map(tuple, registry.QUERIES["op11_conversation_repair"](spark, SF_DIR).collect()), key=repr)
    assert got == plain([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])
