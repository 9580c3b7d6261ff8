"""Typed values: join keys, casts with the contract's rounding, growth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelloom.functions.names import SPACE_CLASS, strip_space


def text_key(key: Column) -> Column:
    """An identifier as trimmed text; whole numbers never go through a double.

    ``51234567890``, ``51234567890.0`` and ``5.123456789E10`` are one key.
    Anything that is not a whole number is kept as it is. Nulls stay null.

    The optimizer repeats a join key in the filters it infers, so the common
    spellings, with blanks around and at most one zero behind a point, come
    first and cost one short pattern.
    """
    text = key.cast("string")
    bare = strip_space(text)
    whole = rf"^[{SPACE_CLASS}]*(\d+)(?:\.0*)?[{SPACE_CLASS}]*$"
    scientific = F.when(bare.rlike(r"^\d+(\.\d+)?[eE]\+?\d+$"), bare).try_cast("decimal(38,9)")
    number = F.when(scientific == F.floor(scientific), F.floor(scientific).cast("string"))
    return (
        F.when(text.rlike(r"^ *\d+(\.0?)? *\z"), F.substring_index(F.trim(text), ".", 1))
        .when(text.rlike(whole), F.regexp_extract(text, whole, 1))
        .otherwise(F.coalesce(number, bare))
    )


def date_key(key: Column, strict: bool = True) -> Column:
    """A period as a date, whether it came as a date or as a date-time text.

    Text that is no date raises in strict mode and becomes null otherwise.
    Stripping by hand is left to texts the plain cast cannot read.
    """
    bare = strip_space(key.cast("string"))
    return F.coalesce(key.try_cast("date"), bare.cast("date") if strict else bare.try_cast("date"))


def trimmed_text(value: Column) -> Column:
    return F.trim(value.cast("string"))


def category(value: Column) -> Column:
    return F.lower(F.trim(value.cast("string")))


def rounded_count(value: Column, strict: bool = True) -> Column:
    """A whole number out of decimal text; halves go away from zero.

    Text that is no such number raises in strict mode and becomes null otherwise.
    """
    exact = "decimal(38,6)"
    if strict:
        return F.round(value.cast(exact), 0).cast("bigint")
    return F.round(value.try_cast(exact), 0).try_cast("bigint")


def misfit(value: Column, typed: Column) -> Column:
    """Why ``value`` has no ``typed`` number; null where it has one, or is null itself."""
    finite = F.abs(value.cast("string").try_cast("double")) < float("inf")
    reason = F.when(F.coalesce(finite, F.lit(False)), "out of range").otherwise("not a number")
    return F.when(value.isNotNull() & typed.isNull(), reason)


def rounded_count_of_double(value: Column) -> Column:
    """A whole number out of a double; halves go to the even neighbour."""
    return F.rint(value).cast("bigint")


def growth_pct(now: Column, before: Column) -> Column:
    """Change against ``before`` in percent, two digits; null when that is 0.

    Computed on decimals: the rounding sees the exact quotient's digits.
    """
    base = F.nullif(before.cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    change = (now - before).cast("decimal(19,0)")
    return F.round(change * F.lit(100) / base, 2).cast("double")
