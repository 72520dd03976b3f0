"""Record types. All ``time``/``ts`` columns are epoch milliseconds, as the feeds deliver them."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
    "BINARY": T.BinaryType(), "TIMESTAMP": T.TimestampType(),
}


def _schema(fields: str) -> T.StructType:
    """``name TYPE`` pairs to a schema (the built-in parser needs a running session)."""
    pairs = (field.split() for field in fields.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


ACCESS = _schema("time BIGINT, domain STRING, traffic DOUBLE")

APP_EVENT = _schema(
    "device STRING, deviceType STRING, os STRING, event STRING, net STRING, channel STRING, uid STRING, "
    "nu INT, nu2 INT, ip STRING, time BIGINT, version STRING, province STRING, city STRING"
).add("product", _schema("category STRING, name STRING"))
# Numeric fields that fall back to 0 when the feed leaves them out.
APP_EVENT_DEFAULTS = {"nu": 0, "nu2": 0, "time": 0}

# Warehouse row; the order of the columns is the order of the insert statement.
ETL_EVENT = _schema(
    "device STRING, deviceType STRING, os STRING, event STRING, net STRING, channel STRING, uid STRING, "
    "nu INT, ip STRING, time BIGINT, version STRING, province STRING, city STRING"
)
ETL_DEFAULTS = {"nu": 0, "time": 0}
ETL_COLUMNS = ["id", *ETL_EVENT.fieldNames(), "day", "hour", "ingest_time"]

SHOPPING = _schema("user_id BIGINT, itemId BIGINT, categoryId BIGINT, behavior STRING, ts BIGINT")
ORDER = _schema("orderId STRING, time BIGINT, money DOUBLE")
ITEM = _schema("itemId INT, orderId STRING, time BIGINT, sku STRING, amount DOUBLE, money DOUBLE")
PURCHASE = _schema("time BIGINT, user_id STRING, book STRING, money DOUBLE")
KEYED_NUMBER = _schema("key BIGINT, value BIGINT")
IP_RANGE = _schema("start_ip BIGINT, end_ip BIGINT, province STRING, city STRING")

KAFKA_ROW = _schema(
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT"
)
