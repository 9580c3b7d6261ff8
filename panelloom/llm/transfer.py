"""Repair costs of a run of turns as min-plus matrices, composed along a Re-Pair grammar.

A turn is one of sixteen symbols, its role's kind and its fault. Between the
turns a conversation is in one of four states: nothing kept yet, a system turn
kept, a user's turn last, an assistant's turn last. A run of turns is then a
matrix: for each state before and after it, the cheapest edits that lead from
one to the other, and among those of equal cost the smallest string of their
initials. Matrices multiply, so the matrix of a grammar rule is the product of
the two it stands for, whatever conversation it occurs in.

The strings are ropes: an entry only knows the state in the middle. Two
strings of the same run end in the edit of its last turn, so none is a proper
part of another's beginning; comparing products therefore needs no more than
the ranks of the parts' strings within their own matrices.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

KINDS = "sua"  # initials of a role that may be kept; other roles have the kind after these
OK, TRUNCATED, BLANK, DUPLICATE = range(4)
FAULTS = 4
SYMBOLS = (len(KINDS) + 1) * FAULTS
FIRST = ord("a")  # the character of symbol 0 in a sequence
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}  # kinds that may follow each other: su, ua, au
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
REMEMBERED = 4096  # turns up to which the string of a rule's entry is kept
NEVER = (1 << 62, "")


def symbol(kind: int, fault: int) -> int:
    return kind * FAULTS + fault


def _inserted(state: int) -> list[tuple[int, int, str]]:
    """(state, cost, edits) that insertions alone lead to; more than two never pay."""
    if state == USER:
        return [(USER, 0, ""), (ASSISTANT, INSERT, "I")]
    return [(state, 0, ""), (USER, INSERT, "I"), (ASSISTANT, 2 * INSERT, "II")]


def _edited(state: int, kind: int, fault: int) -> list[tuple[int, int, str]]:
    """(state, cost, edit) of one turn."""
    found = [(state, DELETE, "D")]
    if fault in (BLANK, DUPLICATE):
        return found
    extra = LEFT_TRUNCATED if fault == TRUNCATED else 0
    following = ASSISTANT if state == USER else USER
    found.append((following, REROLE + extra, "R"))
    if kind + 1 == following or (kind + 1 == SYSTEM and state == START):
        found.append((kind + 1, extra, "K"))
    return found


ENDINGS = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}


@dataclass(frozen=True)
class Transfer:
    """A run of turns: costs and ranks by 4 * before + after, and what its turns add up to."""

    costs: tuple[int, ...]
    ranks: tuple[int, ...]
    edits: tuple[str, ...] | None  # of a single turn
    middle: tuple[int, ...] | None  # of a rule, the state between its two parts
    parts: tuple[int, int] | None
    turns: int
    first: int
    last: int
    faults: tuple[int, int, int, int]
    illegal: int


def of_symbol(number: int) -> Transfer:
    kind, fault = divmod(number, FAULTS)
    best = [NEVER] * 16
    for before in STATES:
        for between, cost, edits in _inserted(before):
            for after, more, edit in _edited(between, kind, fault):
                at = 4 * before + after
                best[at] = min(best[at], (cost + more, edits + edit))
    order = {e: k for k, e in enumerate(sorted({e for _, e in best}))}
    faults = tuple(int(k == fault) for k in range(FAULTS))
    return Transfer(
        tuple(c for c, _ in best), tuple(order[e] for _, e in best), tuple(e for _, e in best), None, None, 1, kind, kind, faults, 0
    )


def of_pair(a: Transfer, b: Transfer, parts: tuple[int, int]) -> Transfer:
    entries, middle = [], []
    for before in STATES:
        for after in STATES:
            ways = [
                (a.costs[4 * before + k] + b.costs[4 * k + after], a.ranks[4 * before + k], b.ranks[4 * k + after], k) for k in STATES
            ]
            cost, *string, k = min(ways)
            entries.append((min(cost, NEVER[0]), tuple(string)))
            middle.append(k)
    order = {s: k for k, s in enumerate(sorted({s for _, s in entries}))}
    return Transfer(
        tuple(c for c, _ in entries),
        tuple(order[s] for _, s in entries),
        None,
        tuple(middle),
        parts,
        a.turns + b.turns,
        a.first,
        b.last,
        tuple(x + y for x, y in zip(a.faults, b.faults)),
        a.illegal + b.illegal + ((a.last, b.first) not in LEGAL),
    )


def replaced(run: Sequence[int], pairs: dict[tuple[int, int], int]) -> Sequence[int]:
    """``run`` with every pair replaced by its rule, those that come first in ``pairs`` first."""
    present = set(zip(run, run[1:]))
    for pair, rule in pairs.items():
        if pair not in present:
            continue
        out, at, last = [], 0, len(run) - 1
        while at <= last:
            if at < last and run[at] == pair[0] and run[at + 1] == pair[1]:
                out.append(rule)
                at += 2
            else:
                out.append(run[at])
                at += 1
        run = out
    return run


def counted(run: Sequence[int]) -> Iterable[tuple[int, int]]:
    """The pairs of neighbours in ``run``; of a repeated symbol's pairs those that do not overlap."""
    previous = None
    for pair in zip(run, run[1:]):
        if pair == previous and pair[0] == pair[1]:
            previous = None
            continue
        previous = pair
        yield pair


@dataclass(frozen=True)
class Plan:
    """What the turns of a conversation are and the cheapest edits that repair it."""

    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str


class Grammar:
    """The rules of all rounds and their matrices, each made once from the two it stands for."""

    def __init__(self, rounds: Sequence[Sequence[tuple[int, int]]]):
        self.table = [of_symbol(n) for n in range(SYMBOLS)]
        self.rounds: list[dict[tuple[int, int], int]] = []
        self.known: dict[tuple[int, int], str] = {}
        for pairs in rounds:
            numbered = {}
            for pair in pairs:
                numbered[pair] = len(self.table)
                self.table.append(of_pair(self.table[pair[0]], self.table[pair[1]], pair))
            self.rounds.append(numbered)

    def coded(self, sequence: str) -> Sequence[int]:
        run: Sequence[int] = [c - FIRST for c in sequence.encode("ascii")]
        for pairs in self.rounds:
            run = replaced(run, pairs)
        return run

    def edits(self, number: int, at: int) -> str:
        """The rope of one entry of a symbol's or rule's matrix as a string."""
        one = self.table[number]
        if one.edits is not None:
            return one.edits[at]
        text = self.known.get((number, at))
        if text is None:
            k = one.middle[at]
            text = self.edits(one.parts[0], at // 4 * 4 + k) + self.edits(one.parts[1], 4 * k + at % 4)
            if one.turns <= REMEMBERED:
                self.known[number, at] = text
        return text

    def plan(self, sequence: str) -> Plan:
        run = self.coded(sequence)
        costs, ranks = [0, NEVER[0], NEVER[0], NEVER[0]], [0] * 4
        back, faults, illegal, previous = [], [0] * FAULTS, 0, None
        for number in run:
            one = self.table[number]
            ways = [min((costs[k] + one.costs[4 * k + j], ranks[k], one.ranks[4 * k + j], k) for k in STATES) for j in STATES]
            order = {s: k for k, s in enumerate(sorted({w[1:3] for w in ways}))}
            costs, ranks = [min(w[0], NEVER[0]) for w in ways], [order[w[1:3]] for w in ways]
            back.append([w[3] for w in ways])
            faults = [x + y for x, y in zip(faults, one.faults)]
            illegal += one.illegal + (previous is not None and (previous, one.first) not in LEGAL)
            previous = one.last
        cost, _, tail, state = min((costs[j] + c, ranks[j], e, j) for j, (c, e) in ENDINGS.items())
        pieces = [tail]
        for number, came in zip(reversed(run), reversed(back)):
            pieces.append(self.edits(number, 4 * came[state] + state))
            state = came[state]
        return Plan(faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal, cost, "".join(reversed(pieces)))
