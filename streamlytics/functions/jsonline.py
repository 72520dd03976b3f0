"""Fault-tolerant JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from streamlytics.functions.barrier import once

CORRUPT = "__corrupt"
END = "__end"


def _as_text(schema: StructType) -> StructType:
    """The same shape with every leaf read as text, so ``"3"`` and ``3`` both serve an INT field."""
    return StructType([
        StructField(f.name, _as_text(f.dataType) if isinstance(f.dataType, StructType) else StringType())
        for f in schema
    ])


def _leaf(raw: Column, target) -> Column:
    if isinstance(target, StringType):
        return raw
    value = raw.try_cast(target)
    if isinstance(target, IntegralType):
        value = F.coalesce(value, raw.try_cast("double").try_cast(target))
    return value


def _typed(prefix: str, schema: StructType, defaults: dict) -> tuple[list[Column], list[Column]]:
    """Typed columns of a struct, and a test for each non-text leaf that does not convert."""
    values, faults = [], []
    for spec in schema:
        raw = F.col(f"{prefix}.`{spec.name}`")
        if isinstance(spec.dataType, StructType):
            inner, inner_faults = _typed(f"{prefix}.`{spec.name}`", spec.dataType, {})
            faults += inner_faults
            value = F.when(raw.isNotNull(), F.struct(*inner))
        else:
            value = _leaf(raw, spec.dataType)
            if not isinstance(spec.dataType, StringType):
                faults.append(raw.isNotNull() & (raw != "") & value.isNull())
            if spec.name in defaults:
                value = F.coalesce(value, F.lit(defaults[spec.name]).cast(spec.dataType))
        values.append(value.alias(spec.name))
    return values, faults


def _parsed(lines: DataFrame, schema: StructType, column: str) -> DataFrame:
    """Attach the parsed record as ``__j.r``, and as ``__j.w`` whether it is the whole line; both once per line."""
    shape = StructType([*_as_text(schema).fields, StructField(CORRUPT, StringType())])
    record = F.from_json(F.col(column), shape, {"columnNameOfCorruptRecord": CORRUPT})
    # The parser stops at the record's closing brace. Read as an array, the line and an end mark are two elements only if
    # nothing but blanks follows the record; the mark is a hash of the line, which no line can hold itself.
    mark = F.xxhash64(F.lit(END), F.col(column)).cast("string")
    listed = F.from_json(
        F.concat(F.lit("["), F.col(column), F.lit(f',{{"{END}":"'), mark, F.lit('"}]')), f"array<struct<{END}: string>>")
    whole = F.transform(listed, lambda x: F.coalesce(x[END], F.lit(""))) == F.array(F.lit(""), mark)
    return once(lines, F.struct(record.alias("r"), whole.alias("w")), "__j")


def _ok(faults: list[Column]) -> Column:
    ok = F.col("__j.r").isNotNull() & F.col(f"__j.r.{CORRUPT}").isNull() & F.col("__j.w")
    for fault in faults:
        ok = ok & ~fault
    return F.coalesce(ok, F.lit(False))


def split_json(
    lines: DataFrame, schema: StructType, column: str = "value", defaults: dict | None = None,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(records, rejected lines)``; missing fields are null, or their default."""
    values, faults = _typed("__j.r", schema, defaults or {})
    parsed, ok = _parsed(lines, schema, column), _ok(faults)
    return parsed.filter(ok).select(*keep, *values), parsed.filter(~ok).drop("__j")


def parse_json(
    lines: DataFrame, schema: StructType, column: str = "value", defaults: dict | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Records of the well-formed lines; the others are dropped (:func:`split_json` keeps them)."""
    return split_json(lines, schema, column, defaults, keep)[0]
