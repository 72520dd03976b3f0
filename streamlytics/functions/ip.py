"""IPv4 text to a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def ip_to_long(column: str | Column) -> Column:
    """Dotted IPv4 to BIGINT; null for anything that is not an address."""
    ip = F.col(column) if isinstance(column, str) else column
    octets = [F.split_part(ip, F.lit("."), F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    number = octets[0] * (1 << 24) + octets[1] * (1 << 16) + octets[2] * (1 << 8) + octets[3]
    return F.when(ip.rlike(IPV4), number)
