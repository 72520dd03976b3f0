"""Delimited lines to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from streamlytics.functions.barrier import once
from streamlytics.functions.text import split_parts, strip_ws


def _parsed(lines: DataFrame, schema: StructType, sep: str, column: str) -> tuple[DataFrame, Column]:
    """Attach the trimmed and cast fields as struct ``__f``; also a test for lines that do not fit."""
    fields = []
    for position, spec in enumerate(schema, start=1):
        value = F.try_element_at("__parts", F.lit(position))
        if isinstance(spec.dataType, StringType):
            value = strip_ws(value)
        else:
            # Casts to numbers pass over surrounding blanks and control characters by themselves.
            value = value.try_cast(spec.dataType)
        fields.append(value.alias(spec.name))
    record = F.struct(F.size("__parts").alias("__n"), *fields)
    rows = once(once(lines, split_parts(F.col(column), sep), "__parts"), record, "__f").drop("__parts")
    bad = F.col("__f.__n") < len(schema)
    for spec in schema:
        if not isinstance(spec.dataType, StringType):
            bad = bad | F.col(f"__f.`{spec.name}`").isNull()
    return rows, F.coalesce(bad, F.lit(True))


def _fields(schema: StructType, record: str = "__f") -> list[Column]:
    return [F.col(f"{record}.`{spec.name}`").alias(spec.name) for spec in schema]


def parse_delimited(
    lines: DataFrame, schema: StructType, sep: str = ",", column: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Split, trim and cast; a short or wrongly typed line fails the job, whatever filters follow.

    Extra fields are ignored.
    """
    rows, bad = _parsed(lines, schema, sep, column)
    failure = F.raise_error(F.concat(F.lit("cannot parse line: "), F.coalesce(F.col(column), F.lit("null"))))
    checked = once(rows, F.when(bad, failure).otherwise(F.col("__f")), "__ok")
    return checked.select(*keep, *_fields(schema, "__ok"))


def split_delimited(
    lines: DataFrame, schema: StructType, sep: str = ",", column: str = "value", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Tolerant twin of :func:`parse_delimited`: ``(typed rows, rejected lines)``."""
    rows, bad = _parsed(lines, schema, sep, column)
    return rows.filter(~bad).select(*keep, *_fields(schema)), rows.filter(bad).drop("__f")
