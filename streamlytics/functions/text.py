"""Splitting lines into words."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blank and all control characters below it.
WHITESPACE = "".join(chr(code) for code in range(1, 33))


def strip_ws(column: Column) -> Column:
    """Trim blanks and control characters (plain ``trim`` takes off blanks only)."""
    return F.trim(column, F.lit(WHITESPACE))


def split_parts(column: Column, sep: str, drop_trailing_empty: bool = True) -> Column:
    """Split on a literal separator.

    Empty parts at the end are dropped by default: ``"a,,b,,"`` gives ``a``, ``""``, ``b``, and a
    line of separators gives nothing, while an empty line gives one empty part.
    """
    pattern = re.escape(sep)
    if not drop_trailing_empty:
        return F.split(column, pattern)
    if len(sep) == 1:
        kept = F.rtrim(column, F.lit(sep))
    else:
        kept = F.regexp_replace(column, f"(?:{pattern})+$", "")
    only_separators = (kept == "") & (column != "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(F.split(kept, pattern))


def tokenize(
    lines: DataFrame,
    sep: str = ",",
    column: str = "value",
    normalise: bool = True,
    drop_empty: bool = False,
    drop_trailing_empty: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per word. ``normalise`` lower-cases and trims; ``drop_empty`` filters empty words.

    Case and trim work on the exploded word, which keeps them in generated code.
    """
    words = lines.select(*keep, F.explode(split_parts(F.col(column), sep, drop_trailing_empty)).alias("word"))
    if normalise:
        words = words.withColumn("word", strip_ws(F.lower("word")))
    return words.filter("word is not null and word <> ''") if drop_empty else words
