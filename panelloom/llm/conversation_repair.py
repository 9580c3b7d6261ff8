"""Conversation structure repair by grammar-compressed dynamic programming.

Every conversation is reduced to a string of symbols, one a turn: the kind of
its role and its first fault. Re-Pair replaces frequent neighbours by rules,
counted over the sequences of all conversations; each rule's min-plus transfer
matrix is made once, bottom-up (``transfer``), and serves every conversation
the rule occurs in. What the rules leave is multiplied out, so the number of
rules decides about speed and never about results.

A conversation's turns pass through a task in order, as a sorted stream that
spills, and only one byte a turn is held; the checksum of the repaired text
has to be taken in this order anyway.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import transfer
from panelloom.llm.registry import query, table
from panelloom.llm.shared import trimmed, written
from panelloom.llm.transfer import Grammar, Plan

RULES_A_ROUND = 64
MOST_RULES = 512  # rules of the grammar; what they do not cover is evaluated symbol by symbol
KNOWN_PLANS = 50_000  # plans of short sequences that a task keeps
SHORT = 64
_SPACE = r"[\x20\x09-\x0D]"
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
_ROLES = {transfer.USER: "user", transfer.ASSISTANT: "assistant"}  # of turns given a role or inserted


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) damaged by a checksum of conv_id and turn, with ``copies``.

    One row in twenty each is dropped (no copies), emptied, loses its full
    stops, is repeated (two copies) or becomes a user's. Null roles and texts
    are one space, and so are null numbers in the checksum.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    role, text = filled("role"), filled("text")
    return conversations.select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    )


def _in_order() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]


def _letters() -> Column:
    """The symbols of a row's copies; every copy but the first repeats it."""
    at = F.position(F.substring("role", 1, 1), F.lit(transfer.KINDS))
    kind = F.when((F.col("role") == "") | (at == 0), len(transfer.KINDS)).otherwise(at - 1)
    is_blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(rf"[.!?]{_SPACE}*\z")
    fault = F.when(is_blank, transfer.BLANK).when(F.col("nth") > 1, transfer.DUPLICATE)
    fault = fault.when(cut, transfer.TRUNCATED).otherwise(transfer.OK)
    again = F.when(is_blank, transfer.BLANK).otherwise(transfer.DUPLICATE)
    as_letter = lambda f: F.char(kind * transfer.FAULTS + f + transfer.FIRST)
    return F.when(F.col("copies") < 1, "").otherwise(F.concat(as_letter(fault), F.repeat(as_letter(again), F.col("copies") - 1)))


def _sequenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(iter(batches), None)
    if first is None:
        return
    id_type = first.schema.field("conv_id").type
    done: list[tuple] = []
    current, letters, low, high, turns = None, None, None, None, 0

    def closed() -> tuple:
        return current, (high - low + 1 - turns) if turns else 0, "".join(letters)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        ids, gaps, sequences = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array(gaps, pa.int64()), pa.array(sequences, pa.string())], names=["conv_id", "gaps", "sequence"]
        )

    for one in chain([first], batches):
        for conv_id, turn, found in zip(*(one.column(n).to_pylist() for n in ("conv_id", "turn", "letters"))):
            if letters is None or conv_id != current:
                if letters is not None:
                    done.append(closed())
                current, letters, low, high, turns = conv_id, [], None, None, 0
            letters.append(found)
            if found and turn is not None and turn != high:
                low, high, turns = turn if low is None else low, turn, turns + 1
        if len(done) >= 1000:
            yield batch(done)
            done = []
    if letters is not None:
        yield batch([*done, closed()])


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, sequence) for every conv_id of ``rows`` (conv_id, turn, role, text, copies).

    ``sequence`` has a symbol for each copy of each row, in the order of turn,
    nulls first; rows of one turn stand in the order of role and text, copies
    of one next to each other. ``gaps`` is the number of turns missing between
    the smallest and the largest. Null roles and texts must have been filled.
    """
    names = ["conv_id", "turn", "role", "text", "copies"]
    together = rows.select(*names).repartition("conv_id").withColumn("lost", F.col("copies") < 1)
    # the same clustering serves the window, so rows move once
    nth = F.expr("row_number() over (partition by conv_id, lost, role, text order by turn asc nulls first)")
    lettered = together.withColumn("nth", nth).withColumn("letters", _letters())
    ordered = lettered.sortWithinPartitions(*_in_order()).select("conv_id", "turn", "letters")
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType().add("conv_id", kind).add("gaps", "long").add("sequence", "string")
    return ordered.mapInArrow(trimmed(_sequenced), schema)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [[c - transfer.FIRST for c in s.encode("ascii")] for s in batch.column("sequence").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(runs, pa.list_(pa.int32())), batch.column("n")], names=["run", "n"])


def _recoded(pairs: dict[tuple[int, int], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [transfer.replaced(r, pairs) for r in batch.column("run").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.list_(pa.int32())), batch.column("n")], names=["run", "n"])

    return trimmed(run)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[int, int], int] = {}
    for batch in batches:
        for run, n in zip(batch.column("run").to_pylist(), batch.column("n").to_pylist()):
            for pair in transfer.counted(run):
                found[pair] = found.get(pair, 0) + n
    if found:  # at most one row for each two of the grammar's symbols
        a, b = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(list(found.values()), pa.int64())], names=["a", "b", "n"])


def grammar(found: DataFrame, most: int = MOST_RULES, a_round: int = RULES_A_ROUND) -> list[list[tuple[int, int]]]:
    """Re-Pair rules, round by round, of all sequences in ``found`` (sequence).

    Equal sequences are coded once and weigh by their number. A round takes
    the ``a_round`` most frequent pairs that occur twice or more and replaces
    them in that order. Only the pairs chosen reach the driver, ``most`` in all.
    """
    distinct = found.groupBy("sequence").agg(F.count("*").alias("n"))
    runs = written(distinct.mapInArrow(trimmed(_coded), "run array<int>, n long"), "runs")
    rounds, number = [], transfer.SYMBOLS
    while (room := min(a_round, most - sum(map(len, rounds)))) > 0:
        counts = runs.mapInArrow(trimmed(_pairs), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        best = counts.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(room).collect()
        if not best:
            break
        pairs = [(r["a"], r["b"]) for r in best]
        runs = written(runs.mapInArrow(_recoded(dict(zip(pairs, range(number, number + room)))), "run array<int>, n long"), "runs")
        rounds.append(pairs)
        number += len(pairs)
    return rounds


def _planned(rounds: list[list[tuple[int, int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, known = Grammar(rounds), {}

        def plan(sequence: str) -> Plan:
            if len(sequence) > SHORT:
                return rules.plan(sequence)
            found = known.get(sequence)
            if found is None:
                if len(known) >= KNOWN_PLANS:
                    known.clear()
                found = known[sequence] = rules.plan(sequence)
            return found

        for batch in batches:
            plans = [plan(s) for s in batch.column("sequence").to_pylist()]
            columns = [pa.array([getattr(p, n) for p in plans], pa.int64()) for n in _COUNTS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("gaps"), *columns, pa.array([p.audit for p in plans], pa.string())],
                names=["conv_id", "gaps", *_COUNTS, "audit"],
            )

    return trimmed(run)


def plans(found: DataFrame, rounds: list[list[tuple[int, int]]]) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of ``sequences`` under a grammar."""
    schema = T.StructType([found.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in ("gaps", *_COUNTS)]])
    return found.mapInArrow(_planned(rounds), schema.add("audit", "string"))


def _edited(audit: str, at: int, state: int, role: str | None, copies: int) -> Iterator[tuple[int, int, str]]:
    """The edits from ``at`` on up to the last that belongs to a row, or without a role those at the end.

    Yields where the audit goes on, the state and the edit.
    """
    while at < len(audit) and (copies or role is None):
        edit = audit[at]
        at += 1
        copies -= edit != "I"
        if edit == "K":
            state = transfer.KINDS.index(role[0]) + 1
        elif edit != "D":
            state = transfer.ASSISTANT if state == transfer.USER else transfer.USER
        yield at, state, edit


def _walked(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Of a stream that has a conversation's plan before its rows: ("plan", values), then ("turn", edit, turn, role, text)."""
    audit, at, state = "", 0, transfer.START
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        rows = [batch.column(n).to_pylist() for n in ("turn", "role", "text", "copies")]
        for values, (turn, role, text, copies) in zip(zip(*columns), zip(*rows)):
            if copies is None:  # the next conversation's plan
                for _, state, edit in _edited(audit, at, state, None, 0):
                    yield "turn", edit, None, _ROLES[state], ""
                audit, at, state = values[-1], 0, transfer.START
                yield "plan", values
                continue
            for at, state, edit in _edited(audit, at, state, role, copies):
                if edit == "I":
                    yield "turn", edit, None, _ROLES[state], ""
                elif edit != "D":
                    yield "turn", edit, turn, role if edit == "K" else _ROLES[state], text
    for _, state, edit in _edited(audit, at, state, None, 0):
        yield "turn", edit, None, _ROLES[state], ""


def _digested(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(iter(batches), None)
        if first is None:
            return
        types = [first.schema.field(n).type for n in names]
        done, values, digest, some = [], None, None, False

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done), [*types, pa.string()])]
            return pa.RecordBatch.from_arrays(columns, names=[*names, "repaired_sha256"])

        for what, *event in _walked(chain([first], batches), names):
            if what == "plan":
                if values is not None:
                    done.append((*values, digest.hexdigest()))
                if len(done) >= 1000:
                    yield batch()
                    done = []
                values, digest, some = event[0], hashlib.sha256(), False
                continue
            _, _, role, text = event
            digest.update(f"{chr(10) if some else ''}{role}:{text}".encode())
            some = True
        if values is not None:
            done.append((*values, digest.hexdigest()))
            yield batch()

    return trimmed(run)


def _turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(iter(batches), None)
    if first is None:
        return
    kinds = [first.schema.field("conv_id").type, pa.int64(), pa.string(), first.schema.field("turn").type, pa.string(), pa.string()]
    done, conv_id, place = [], None, 0
    batch = lambda: pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=["conv_id", "place", "edit", "turn", "role", "text"]
    )
    for what, *event in _walked(chain([first], batches), ["conv_id", "audit"]):
        if what == "plan":
            conv_id, place = event[0][0], 0
            continue
        edit, turn, role, text = event
        done.append((conv_id, place, edit, turn, role, text))
        place += 1
        if len(done) >= 1000:
            yield batch()
            done = []
    if done:
        yield batch()


def _streamed(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """A conversation's plan and then its rows in order, all in one task."""
    both = filled(rows).unionByName(planned, allowMissingColumns=True)
    by_id, *order = _in_order()
    return both.repartition("conv_id").sortWithinPartitions(by_id, F.col("copies").isNotNull(), *order)


def repaired_turns(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the turns of ``rows`` after the edits of ``plans``, numbered from 0.

    ``edit`` is K for a turn kept, R for one given another role, I for an
    empty one inserted, which has no turn number.
    """
    schema = T.StructType().add("conv_id", rows.schema["conv_id"].dataType).add("place", "long").add("edit", "string")
    schema = schema.add("turn", rows.schema["turn"].dataType).add("role", "string").add("text", "string")
    return _streamed(rows, planned.select("conv_id", "audit")).mapInArrow(trimmed(_turned), schema)


def repaired_digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``planned`` with ``repaired_sha256``, the hash of the repaired turns as ``role:text``, a line each."""
    schema = T.StructType([*planned.schema.fields]).add("repaired_sha256", "string")
    return _streamed(rows, planned).mapInArrow(_digested(planned.columns), schema)


def repair(rows: DataFrame) -> DataFrame:
    """``plans`` of ``rows`` (conv_id, turn, role, text, and copies where rows stand for several).

    A turn's first fault counts: blank (nothing but white space), duplicate
    (role and text seen earlier), truncated (no full stop at its end). Keeping
    a turn costs nothing, giving it another role 1, deleting it 2, which blank
    and duplicate ones must be; an empty turn inserted costs 5, and so does a
    truncated one that stays. ``audit`` has the initials of the cheapest edits
    that leave ``(system? (user assistant)+)?`` by the roles' initials, the
    smallest such string where several cost the same.

    A null role or text is one space. Rows without conv_id are one
    conversation; a conversation whose rows have no copies left has zeros and
    an empty audit. Repeated rows are duplicates of each other. An empty table
    gives no rows; further columns are ignored.
    """
    found = written(sequences(filled(rows)), "sequences")
    return plans(found, grammar(found))


def filled(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) without null roles, texts and copies, and nothing else."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    copies = F.coalesce("copies", F.lit(1)).cast("int") if "copies" in rows.columns else F.lit(1)
    return rows.select("conv_id", "turn", space("role"), space("text"), copies.alias("copies"))


_CRC = (
    "list_reduce([4294967295::bigint] || flatten(list_transform(str_split({0}, ''), lambda z: [ascii(z)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])), "
    "lambda c, z: case when z >= 0 then xor(c, z) else xor(c >> 1, (c & 1) * 3988292384) end)"
)


def _plus(state: str, cost: str | int, edit: str) -> str:
    return f"case when {state} is not null then {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}} end"


def _least(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda z: z is not null))[1]"


_W = {
    "w0": "s0",
    "w1": "s1",
    "w2": _least("s2", _plus("s0", 5, "I"), _plus("s1", 5, "I"), _plus("s3", 5, "I")),
    "w3": _least("s3", _plus("s2", 5, "I"), _plus("s0", 10, "II"), _plus("s1", 10, "II")),
}
_N = {
    "n0": _plus("w0", 2, "D"),
    "n1": _least(_plus("w1", 2, "D"), f"case when stays and r = 's' then {_plus('w0', 'x', 'K')} end"),
    "n2": _least(
        _plus("w2", 2, "D"),
        f"case when stays then {_plus('opened', '1 + x', 'R')} end",
        f"case when stays and r = 'u' then {_plus('opened', 'x', 'K')} end",
    ),
    "n3": _least(
        _plus("w3", 2, "D"), f"case when stays then {_plus('w2', '1 + x', 'R')} end", f"case when stays and r = 'a' then {_plus('w2', 'x', 'K')} end"
    ),
}
_listed = lambda named: ", ".join(f"{sql} {name}" for name, sql in named.items())

_SQL = f"""
with recursive
src as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') "text",
    xor({_CRC.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")}, 4294967295) % 20 hit
  from conversations
),
dam as (
  select conv_id, turn, case when hit = 4 then 'user' else role end role,
    case when hit = 1 then '' when hit = 2 then regexp_replace("text", '[.!?]', '', 'g') else "text" end "text",
    unnest(range(case when hit = 0 then 0 when hit = 3 then 2 else 1 end)) copy
  from src
),
ord as (
  select *, left(role, 1) r, row_number() over (partition by conv_id order by turn nulls first, role, "text", copy) rn,
    row_number() over (partition by conv_id, role, "text" order by turn nulls first, copy) nth
  from dam
),
flt as (
  select *, case when not regexp_matches("text", '[^\\x20\\x09-\\x0D]') then 'b' when nth > 1 then 'd'
      when not regexp_matches("text", '[.!?][\\x20\\x09-\\x0D]*$') then 't' else '' end f,
    coalesce(rn > 1 and lag(r) over (partition by conv_id order by rn) || r not in ('su', 'ua', 'au'), false) bad
  from ord
),
ids as (select distinct conv_id from conversations),
dp as (
  select conv_id, 0::bigint rn, {{'c': 0, 'a': ''}} s0, null::struct(c integer, a varchar) s1, null::struct(c integer, a varchar) s2,
    null::struct(c integer, a varchar) s3
  from ids
  union all
  select conv_id, rn, {", ".join(_N.values())}
  from (
    select *, {_least("w0", "w1", "w3")} opened
    from (
      select dp.conv_id, flt.rn, r, f in ('', 't') stays, case when f = 't' then 5 else 0 end x, {_listed(_W)}
      from dp join flt on flt.conv_id is not distinct from dp.conv_id and flt.rn = dp.rn + 1
    )
  )
),
fin as (
  select conv_id, {_least("s0", "s3", _plus("s1", 10, "II"), _plus("s2", 5, "I"))} best
  from dp where rn = coalesce((select max(rn) from flt where flt.conv_id is not distinct from dp.conv_id), 0)
),
let as (select conv_id, best.a[i] e, i from (select *, unnest(range(1, len(best.a) + 1)) i from fin)),
num as (select *, count(*) filter (where e <> 'I') over (partition by conv_id order by i) rn from let),
emi as (
  select num.conv_id, num.i, e, role, case when e = 'I' then '' else "text" end "text",
    coalesce(sum(case when e = 'K' and r = 's' then 0 else 1 end) over (partition by num.conv_id order by num.i rows between unbounded preceding and 1 preceding), 0) before
  from num left join flt on flt.conv_id is not distinct from num.conv_id and flt.rn = num.rn
  where e <> 'D'
),
rep as (
  select conv_id, string_agg(case when e = 'K' then role when before % 2 = 0 then 'user' else 'assistant' end || ':' || "text", chr(10) order by i) t
  from emi group by conv_id
),
cnt as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where f = 'b') b,
    count(*) filter (where f = 'd') d, count(*) filter (where f = 't') t, count(*) filter (where bad) i
  from flt group by conv_id
)
select ids.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(b, 0)::bigint blank, coalesce(d, 0)::bigint duplicate,
  coalesce(cnt.t, 0)::bigint truncated, coalesce(i, 0)::bigint illegal, best.c::bigint as "cost", best.a as audit,
  sha256(coalesce(rep.t, '')) repaired_sha256
from ids
left join cnt on cnt.conv_id is not distinct from ids.conv_id
left join fin on fin.conv_id is not distinct from ids.conv_id
left join rep on rep.conv_id is not distinct from ids.conv_id
"""


@query("op11_conversation_repair", _SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repaired_digests(rows, repair(rows))
