"""Column-name clean-up, for names held in cells and for a frame's own columns.

The character classes are spelled out with Unicode properties so that a cell
cleaned on an executor and a column name cleaned on the driver agree, also on
accented letters, non-breaking spaces and control separators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE_CLASS = r"\p{Z}\t-\r\x1c-\x1f\x85"
WORD_CLASS = r"\p{L}\p{N}_"

# The characters of the space class, one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_space(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(SPACES))


def single_spaced(text: Column) -> Column:
    """Trim, and turn each run of white space into one space; case is kept."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE_CLASS}]+", " "))


def snake_case(text: Column) -> Column:
    """Drop punctuation, trim, join the words with underscores, lower-case."""
    words = F.regexp_replace(text, rf"[^{WORD_CLASS}{SPACE_CLASS}]+", "")
    return F.lower(F.regexp_replace(strip_space(words), rf"[{SPACE_CLASS}]+", "_"))


def single_spaced_name(name: str) -> str:
    return " ".join(name.split())


def snake_case_name(name: str) -> str:
    kept = (c for c in name if c == "_" or c.isalnum() or c.isspace())
    return "_".join("".join(kept).split()).lower()


def rename_all(df: DataFrame, rule) -> DataFrame:
    """Apply a name rule to every column of ``df``."""
    return df.toDF(*[rule(name) for name in df.columns])
