"""The Python function surface: scalar, lifecycle, table-valued and metric functions.

Hot paths in this package use column expressions; these are the hooks for a user's own code.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from streamlytics.functions.ip import IPV4
from streamlytics.operators.enrich import prefix_table
from streamlytics.session import materialize



def register_ip_parser(spark: SparkSession, ranges: DataFrame, name: str = "ip_parser") -> None:
    """Register ``ip_parser(ip)`` giving ``province-city`` (``---`` when unknown) for use in SQL.

    A SQL function over a view of the ranges, which plans as the join of ``enrich_ip`` on the /16: the ranges stay
    a table of any size, and nothing of them passes through the driver.
    """
    view = f"{name}_ranges"
    materialize(prefix_table(ranges), "ip_prefixes").createOrReplaceTempView(view)
    steps = ", ".join(str(1 << k) for k in range(16, -1, -1))
    number = " + ".join(f"try_cast(split_part(ip, '.', {i + 1}) AS BIGINT) * {1 << (24 - 8 * i)}" for i in range(4))
    number = f"CASE WHEN ip RLIKE r'{IPV4}' THEN {number} END"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}_in(segments ARRAY<STRUCT<
            start_ip: BIGINT, end_ip: BIGINT, province: STRING, city: STRING>>, number BIGINT) RETURNS STRING
        RETURN coalesce(element_at(transform(array(get(segments, aggregate(array({steps}), 0, (n, step) ->
            IF(n + step <= size(segments) AND get(segments, n + step - 1).start_ip <= number, n + step, n)) - 1)),
            s -> IF(s.end_ip >= number, coalesce(s.province, '-') || '-' || coalesce(s.city, '-'), NULL)), 1), '---')""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(ip STRING) RETURNS STRING
        RETURN {name}_in(
            (SELECT first(r.segments) FROM {view} r WHERE r.prefix = floor(({number}) / {1 << 16})), {number})""")


def map_with_lifecycle(
    df: DataFrame,
    schema: str,
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    setup: Callable[[], object] = lambda: None,
    teardown: Callable[[object], None] = lambda handle: None,
) -> DataFrame:
    """Row function with one ``setup`` and one ``teardown`` per task, fed in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        handle = setup()
        try:
            for batch in batches:
                yield apply(handle, batch)
        finally:
            teardown(handle)

    return df.mapInPandas(run, schema)


@F.udtf(returnType="word string")
class SplitWords:
    """``split_words(text, sep)``: one row per part, for ``LATERAL`` use in SQL, which Spark does not allow to functions on
    Arrow arrays; :func:`~streamlytics.functions.text.split_parts` and ``explode`` do the same without Python."""

    def eval(self, text: str, sep: str):
        if text is not None:
            parts = text.split(sep)
            while len(parts) > 1 and parts[-1] == "":
                parts.pop()
            if parts != [""] or text == "":
                for part in parts:
                    yield (part,)


def register_split_words(spark: SparkSession, name: str = "split_words") -> None:
    spark.udtf.register(name, SplitWords)


def counted(df: DataFrame, name: str = "rows_passed") -> tuple[DataFrame, Observation]:
    """Count rows as they pass; read ``observation.get[name]`` after the action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias(name)), observation
