"""Column and row functions: tokenising, parsing, calendar keys, guards and the UDF surface."""

from streamlytics.functions.clock import day_hour, event_ts, format_ms, local_date, window_label
from streamlytics.functions.delimited import parse_delimited, split_delimited
from streamlytics.functions.guards import ingest_time, not_equal, poison_guard, quarantine_poison
from streamlytics.functions.ip import ip_to_long
from streamlytics.functions.jsonline import parse_json, split_json
from streamlytics.functions.text import strip_ws, tokenize

__all__ = [
    "day_hour", "event_ts", "format_ms", "ingest_time", "ip_to_long", "local_date", "not_equal",
    "parse_delimited", "parse_json", "poison_guard", "quarantine_poison", "split_delimited", "split_json",
    "strip_ws", "tokenize", "window_label",
]
