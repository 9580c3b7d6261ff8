"""Filter interaction audit: what each of five quality filters does in every order they could be applied in.

A document's failures are independent of the order, so each document is
reduced once to the set of filters it fails. Four of them look at the text
alone. The fifth, a copy of an earlier document, is an existential self-join:
a left semi join on the text's hash, the exact text and a smaller doc_id. The
ids it finds are united with the other failures, and documents are counted by
combination of failures. All orders are then told from those counts.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.registry import query, table
from panelloom.llm.shared import written

FILTERS = "ABCDE"  # too short, repetitive, shouting, symbols, copy
COPY = "E"
FEWEST_WORDS = 200
_SPACE = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions under which a text, not null, fails the filters A to D."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    length = F.length(text)
    capitals = length - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": n < FEWEST_WORDS,
        "B": distinct.cast("long") * 100 < n.cast("long") * 50,
        "C": capitals.cast("long") * 100 > length.cast("long") * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text, text_key, n_chars): what tells a row from others, beside its text."""
    text = F.coalesce("text", F.lit(""))
    part = F.coalesce("lang", F.lit("")).alias("part")
    return docs.select("doc_id", part, text.alias("text")).withColumns(
        {"text_key": F.xxhash64("text"), "n_chars": F.length("text")}
    )


def copies(docs: DataFrame, facts: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose whole text an earlier doc_id has, each as often as it stands there.

    ``facts`` holds their keys; only texts whose key stands under several ids
    are looked at. The join's right side is one row a text, the smallest of
    its ids, which exists exactly where any smaller one does, so a text that
    a third of the rows share meets one row there and not all of its copies.
    """
    shared = (
        facts.groupBy("text_key", "n_chars").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    )
    # written first: with its size known, texts are not dealt out to meet a table that is small
    shared = written(shared.select("text_key", "n_chars"), "shared")
    some = _rows(docs).join(shared, ["text_key", "n_chars"], "left_semi")
    earlier = some.groupBy("text_key", "text").agg(F.min("doc_id").alias("doc_id"))
    a, b = some.alias("a"), earlier.alias("b")
    same = (F.col("a.text_key") == F.col("b.text_key")) & (F.col("a.text") == F.col("b.text"))
    return a.join(b, same & (F.col("b.doc_id") < F.col("a.doc_id")), "left_semi").drop("text")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails, n): for each document of ``docs`` (doc_id, text, lang) the letters of the filters it fails.

    A null text is empty, a null lang the part "". Repeated rows are one row
    here, ``n`` tells of how many. A row without doc_id is neither a copy nor
    makes others copies. Further columns are ignored.
    """
    rows = _rows(docs)
    bits = [F.when(fails, _bit(letter)).otherwise(0) for letter, fails in text_failures(F.col("text")).items()]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    key = ["doc_id", "part", "text_key", "n_chars"]
    facts = written(rows.select(*key, mask.alias("mask"), F.lit(1).cast("long").alias("n")), "facts")
    marked = copies(docs, facts).select(*key, F.lit(_bit(COPY)).alias("mask"), F.lit(0).cast("long").alias("n"))
    both = facts.unionByName(marked).groupBy(*key).agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    letters = [F.when(F.col("mask").bitwiseAND(_bit(c)) != 0, c).otherwise("") for c in FILTERS]
    return both.select("doc_id", "part", F.concat(*letters).alias("fails"), "n")


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and combination of failures.

    ``good`` and ``toxic`` count those that some row of ``labels`` (doc_id,
    quality, toxic) gives the label 1; labels that are null or without
    document count nothing.
    """
    one = lambda c: F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    joined = failed.join(known, "doc_id", "left")
    count = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    return joined.groupBy("part", "fails").agg(F.sum("n").alias("n"), count("good").alias("good"), count("toxic").alias("toxic"))


def audited(counts: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    From ``combinations``: a row for each part, each order of the filters and
    each step of it. A part has at most 32 combinations, so the 600 steps of
    its orders make at most 19,200 rows, summed before they are shuffled.
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )
    letter, before = F.substr("filter_order", "step", F.lit(1)), F.substr("filter_order", F.lit(1), F.col("step") - 1)
    here = F.contains("fails", letter)
    gone = reduce(lambda a, b: a | b, [F.contains(before, F.lit(c)) & F.contains("fails", F.lit(c)) for c in FILTERS])
    total = lambda when, c="n": F.sum(F.when(when, F.col(c)).otherwise(0))
    found = steps.groupBy("part", "filter_order", "step", letter.alias("letter")).agg(
        total(~gone & ~here).alias("kept"),
        total(~gone & here).alias("removed"),
        total(gone & here).alias("redundant"),
        total(F.col("fails") == letter).alias("unique_fails"),
        total(~gone & here, "good").alias("good_lost"),
        total(~gone & here, "toxic").alias("toxic_lost"),
    )
    all_orders = Window.partitionBy("part", "letter")
    return found.withColumn("shapley", F.sum("removed").over(all_orders)).drop("letter")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` (doc_id, text, lang) with ``labels`` (doc_id, quality, toxic); empty tables give no rows."""
    return audited(combinations(failures(docs), labels))


_SQL = f"""
with d as (select doc_id, coalesce(lang, '') part, coalesce(text, '') t from documents),
w as (select doc_id, part, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') words, min(doc_id) over (partition by t) low from d),
f as (
  select doc_id, part,
    case when len(words) < {FEWEST_WORDS} then 'A' else '' end
    || case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end
    || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when low < doc_id then 'E' else '' end fails
  from w
),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) toxic
      from labels group by doc_id),
c as (select part, fails, count(*) n, coalesce(sum(good), 0) good, coalesce(sum(toxic), 0) toxic
      from f left join l using (doc_id) group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
o as (
  select a.x || b.x || c.x || d.x || e.x filter_order
  from x a, x b, x c, x d, x e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
s as (select filter_order, step, filter_order[step] letter, filter_order[1:step - 1] earlier from o, (select unnest(range(1, 6)) step)),
r as (
  select part, filter_order, step, letter, n, good, toxic, fails, contains(fails, letter) here,
    step > 1 and regexp_matches(fails, '[' || earlier || '_]') gone
  from c, s
),
g as (
  select part, filter_order, step, letter,
    sum(case when not gone and not here then n else 0 end) kept,
    sum(case when not gone and here then n else 0 end) removed,
    sum(case when gone and here then n else 0 end) redundant,
    sum(case when fails = letter then n else 0 end) unique_fails,
    sum(case when not gone and here then good else 0 end) good_lost,
    sum(case when not gone and here then toxic else 0 end) toxic_lost
  from r group by all
)
select part, filter_order, cast(step as integer) step, cast(kept as bigint) kept, cast(removed as bigint) removed,
  cast(redundant as bigint) redundant, cast(unique_fails as bigint) unique_fails, cast(good_lost as bigint) good_lost,
  cast(toxic_lost as bigint) toxic_lost, cast(sum(removed) over (partition by part, letter) as bigint) shapley
from g
"""


@query("op13_filter_interaction_audit", _SQL)
def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
