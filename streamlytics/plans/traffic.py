"""Traffic per domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics import schemas
from streamlytics.functions.delimited import parse_delimited
from streamlytics.operators.aggregate import keyed_sum


def heavy_access(lines: DataFrame, floor: float = 4000) -> DataFrame:
    """Access rows above a traffic floor."""
    return parse_delimited(lines, schemas.ACCESS).filter(F.col("traffic") > floor)


def domain_traffic(lines: DataFrame) -> DataFrame:
    """Total traffic per domain from ``time,domain,traffic`` lines."""
    return keyed_sum(parse_delimited(lines, schemas.ACCESS), "domain", "traffic")
