"""Preference formatting: one prompt and two masked completions for a pair of conversations.

Chosen and rejected conversations are compared turn by turn; the turns before
the first that differs are their longest common prefix and are rendered once,
as the prompt. What follows is rendered for each side, with the span of
characters that the loss covers. Everything is a row a turn, so a long
conversation is never gathered in one task; ``assembled`` joins the rendered
turns of a pair where whole strings are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.registry import query, table
from panelloom.llm.shared import written
from panelloom.operators.ordered import with_lookback

TURN = ["pair_id", "turn", "role", "text"]
START, END, BREAK = "<|im_start|>", "<|im_end|>", "\n"
TRAINED = "assistant"


def _head(role: str) -> Column:
    return F.concat(F.lit(START), F.coalesce(F.col(role), F.lit("unknown")), F.lit(BREAK))


def preference_turns(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, turn, role, rendered, loss_start, loss_stop) from two tables (pair_id, turn, role, text).

    ``part`` is ``prompt`` for turns before the first turn number at which the
    two sides differ, taken from the chosen side, and ``chosen`` or
    ``rejected`` from there on. ``loss_start`` and ``loss_stop`` are characters
    of ``rendered``: an assistant's text and end mark in a completion, empty
    elsewhere. A side without a turn that the other has differs there. Equal
    conversations are all prompt. A null role is rendered as ``unknown``, a
    null text as empty, and both equal only nulls. Repeated rows are taken
    once; different rows of one turn are all kept. Rows without pair_id or
    turn cannot be placed: they are ``unplaced`` and carry no loss. Further
    columns are ignored.
    """
    sides = chosen.select(*TURN, F.lit(False).alias("first"), F.lit(False).alias("last"))
    lost = rejected.select(*TURN, F.lit(True).alias("first"), F.lit(True).alias("last"))
    return _parted(sides.unionByName(lost))


def _parted(sides: DataFrame) -> DataFrame:
    """The turns of both sides: ``first`` is false where the chosen side has a row, ``last`` true where the rejected one has.

    A row that is known to stand on both sides comes once; rows where both are
    null belong to none.
    """
    rows = sides.groupBy(*TURN).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    rows = written(rows, "turns")  # read for the cuts and again for the turns
    placed = F.col("pair_id").isNotNull() & F.col("turn").isNotNull()
    cuts = rows.where(placed & (F.col("first") == F.col("last"))).groupBy("pair_id").agg(F.min("turn").alias("cut"))
    rows = rows.join(cuts, "pair_id", "left")
    part = F.when(F.col("pair_id").isNull() | F.col("turn").isNull(), F.array(F.lit("unplaced")))
    part = part.when(F.col("first").isNull(), F.array(F.lit("unpaired")))
    part = part.when(F.col("cut").isNull() | (F.col("turn") < F.col("cut")), F.array(F.lit("prompt")))
    part = part.when(F.col("first") != F.col("last"), F.array(F.lit("chosen"), F.lit("rejected")))
    part = part.otherwise(F.array(F.when(F.col("first"), "rejected").otherwise("chosen")))
    return _rendered(rows.withColumn("part", F.explode(part)))


def _rendered(rows: DataFrame) -> DataFrame:
    body = F.concat(F.coalesce("text", F.lit("")), F.lit(END))
    trained = F.col("part").isin("chosen", "rejected") & F.coalesce(F.col("role") == TRAINED, F.lit(False))
    start = F.length(_head("role")).cast("long")
    return rows.select(
        "pair_id",
        "part",
        "turn",
        "role",
        F.concat(_head("role"), body, F.lit(BREAK)).alias("rendered"),
        F.when(trained, start).otherwise(F.lit(0).cast("long")).alias("loss_start"),
        F.when(trained, start + F.length(body)).otherwise(F.lit(0).cast("long")).alias("loss_stop"),
    )


def assembled(turns: DataFrame) -> DataFrame:
    """(pair_id, prompt, chosen, rejected), whole strings; for pairs whose conversations fit one row."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "rendered")))
    text = F.array_join(F.transform(ordered, lambda t: t["rendered"]), "")
    parts = turns.where("part != 'unplaced'").groupBy("pair_id", "part").agg(text.alias("text"))
    one = lambda name: F.coalesce(F.max(F.when(F.col("part") == name, F.col("text"))), F.lit(""))
    return parts.groupBy("pair_id").agg(*[one(name).alias(name) for name in ("prompt", "chosen", "rejected")])


def reply_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides from plain conversations (conv_id, turn, role, text).

    Chosen is a conversation up to its last assistant turn; rejected is the
    same with that turn replaced by the last assistant turn of the
    conversation with the next number. Conversations without an assistant or
    a next one make no pair, and turns after the last assistant turn are left
    out; ``turns_of_all`` keeps them.
    """
    rows = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = _last_replies(rows)
    other = last.select((F.col("pair_id") - 1).alias("pair_id"), F.col("reply.text").alias("other"))
    pairs = last.select("pair_id", F.col("reply.turn").alias("at")).join(other, "pair_id")
    joined = rows.join(pairs, "pair_id").where(F.col("turn") <= F.col("at"))
    return _sides(joined.select("pair_id", "turn", "role", "text"), pairs)


def _last_replies(rows: DataFrame) -> DataFrame:
    """(pair_id, reply): turn and text of each conversation's last assistant turn."""
    said = rows.where((F.col("role") == TRAINED) & F.col("pair_id").isNotNull() & F.col("turn").isNotNull())
    return said.groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("reply"))


def _sides(chosen: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    replaced = pairs.select("pair_id", F.col("at").alias("turn"), F.lit(TRAINED).alias("role"), F.col("other").alias("text"))
    return chosen, chosen.join(pairs, "pair_id").where(F.col("turn") < F.col("at")).select(chosen.columns).unionByName(replaced)


def turns_of_all(conversations: DataFrame) -> DataFrame:
    """``preference_turns`` of plain conversations (conv_id, turn, role, text), every row of which is in the result.

    Sides are as in ``reply_pairs``, but the rejected reply is that of the
    next conversation in the order of conv_id that has one, whatever lies
    between; the last conversation takes the first one's. What makes no pair
    has the part ``unpaired`` and carries no loss: turns after the last
    assistant turn, conversations without an assistant, and one that no other
    reply can be set against. Rows without conv_id or turn are ``unplaced``.
    """
    rows = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    pairs = written(_next_replies(_last_replies(rows)), "pairs")
    known = rows.join(pairs.select("pair_id", "at"), "pair_id", "left")
    inside = (F.col("turn") <= F.col("at")) | F.col("pair_id").isNull() | F.col("turn").isNull()
    before = F.col("turn") < F.col("at")  # these stand on both sides
    sides = known.select(*TURN, F.when(inside, F.lit(False)).alias("first"), F.when(inside, before).alias("last"))
    replaced = pairs.select("pair_id", F.col("at").alias("turn"), F.lit(TRAINED).alias("role"), F.col("other").alias("text"))
    lost = replaced.withColumns({"first": F.lit(True), "last": F.lit(True)})
    return _parted(sides.unionByName(lost))


def _next_replies(last: DataFrame) -> DataFrame:
    """(pair_id, at, other): each conversation's last reply's turn, and the text of the next conversation's."""
    replies = last.select("pair_id", F.col("reply.turn").alias("at"), F.col("reply.text").alias("other"), F.lit(1).alias("all"))
    before = lambda df, w: df.withColumn("before", F.lag(F.struct("pair_id", "at")).over(w))
    seen = with_lookback(replies, ["all"], ["pair_id"], 1, before)
    ends = seen.groupBy("all").agg(F.max(F.struct("pair_id", "at")).alias("end"))
    first = seen.where("before is null").join(ends, "all").where(F.col("pair_id") != F.col("end.pair_id"))
    return seen.where("before is not null").select("before.*", "other").unionByName(first.select("end.*", "other"))


_SQL = f"""
with s as (select distinct conv_id pair_id, turn, role, text from conversations),
l as (
  select pair_id, turn "at", max(text) reply from s
  where role = '{TRAINED}' and pair_id is not null
    and turn = (select max(turn) from s t where t.pair_id = s.pair_id and t.role = '{TRAINED}')
  group by all
),
n as (
  select pair_id, "at", count(*) over () n, lead(pair_id) over (order by pair_id) following,
    lead(reply) over (order by pair_id) "next", first_value(reply) over (order by pair_id) "first"
  from l
),
p as (select pair_id, "at", case when following is null then "first" else "next" end other from n where n > 1),
c as (select s.* from s join p using (pair_id) where turn <= "at"),
r as (
  select c.* from c join p using (pair_id) where turn < "at"
  union all select pair_id, "at", '{TRAINED}', other from p
),
m as (
  select pair_id, turn, role, text, bool_or(k) c, bool_or(not k) r
  from (select *, true k from c union all select *, false from r) group by pair_id, turn, role, text
),
cut as (select pair_id, min(turn) cut from m where not (c and r) group by pair_id),
parts as (
  select m.*, 'prompt' part from m left join cut using (pair_id) where cut is null or turn < cut
  union all select m.*, 'chosen' from m join cut using (pair_id) where turn >= cut and c
  union all select m.*, 'rejected' from m join cut using (pair_id) where turn >= cut and r
  union all select *, true, true, 'unplaced' from s where pair_id is null or turn is null
  union all select s.*, true, true, 'unpaired' from s left join p using (pair_id)
    where pair_id is not null and turn is not null and ("at" is null or turn > "at")
)
select pair_id, part, turn, role,
  '{START}' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '{END}' || chr(10) rendered,
  case when part in ('chosen', 'rejected') and role = '{TRAINED}' then length('{START}' || role || chr(10)) else 0 end loss_start,
  case when part in ('chosen', 'rejected') and role = '{TRAINED}'
    then length('{START}' || role || chr(10) || coalesce(text, '') || '{END}') else 0 end loss_stop
from parts
"""


@query("op7_preference_formatting", _SQL)
def op7_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns_of_all(table(spark, sf_dir, "conversations"))
