"""The SQL side: views, group-by sums and tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.operators.window import windowed


def domain_traffic_sql(access: DataFrame, view: str = "access") -> DataFrame:
    access.createOrReplaceTempView(view)
    return access.sparkSession.sql(f"select domain, sum(traffic) as traffics from {view} group by domain")


def tumble_purchases(purchases: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Spending per user and tumbling window."""
    return windowed(purchases, ["user_id"], [F.sum("money").alias("total")], size)


def tumble_purchases_sql(purchases: DataFrame, size: str = "10 seconds", view: str = "purchases") -> DataFrame:
    purchases.createOrReplaceTempView(view)
    return purchases.sparkSession.sql(
        f"""
        select unix_millis(window.start) as w_start, unix_millis(window.end) as w_end, user_id,
               sum(money) as total
        from {view} group by window(ts, '{size}'), user_id
        """
    )
