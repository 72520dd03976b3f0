"""Structured Streaming twins: watermarks, stateful processors, per-batch operators and sinks."""

from streamlytics.streaming.batches import late_split_stream, top_n_stream
from streamlytics.streaming.eventtime import filter_above_watermark, unique_count_stream, with_event_time
from streamlytics.streaming.sinks import (
    BatchTable, csv_sink, fan_out, hash_sink, jdbc_batch_sink, jdbc_upsert_sink, set_sink, sketch_sink, start,
)
from streamlytics.streaming.stateful import (
    average_every_stream, expiring_totals, first_seen_stream, top_n_on_timer,
)

__all__ = [
    "BatchTable", "average_every_stream", "csv_sink", "expiring_totals", "fan_out", "filter_above_watermark",
    "first_seen_stream", "hash_sink", "jdbc_batch_sink", "jdbc_upsert_sink", "late_split_stream", "set_sink",
    "sketch_sink", "start", "top_n_on_timer", "top_n_stream", "unique_count_stream", "with_event_time",
]
