"""Relational and event-time operators. Unless noted, each takes and returns a lazy DataFrame."""

from streamlytics.operators.aggregate import (
    changelog, count_by, count_grouping_sets, keyed_combine, keyed_reduce, keyed_sum, latest_only,
    running_sum, salted_count, word_count,
)
from streamlytics.operators.bloom import Bloom, bloom_parts, first_seen_bloom
from streamlytics.operators.cogroup import co_group, count_between, left_outer
from streamlytics.operators.combine import connect_flat_map, connect_map, union_all
from streamlytics.operators.sets import cardinalities, container_counts, containers, merge_containers
from streamlytics.operators.distinct import (
    bitmap_counts, exact_counts, hll_counts, hll_sketches, rolling_distinct,
)
from streamlytics.operators.enrich import enrich_ip
from streamlytics.operators.joins import repair_late_items, windowed_left_join
from streamlytics.operators.late import flag_late, split_late
from streamlytics.operators.routing import hash_exchange, route, set_parallelism
from streamlytics.operators.running import Running, running
from streamlytics.operators.sequence import average_every, first_seen
from streamlytics.operators.topk import top_lists, top_n
from streamlytics.operators.window import cumulative_pv_uv, sliding_count, windowed

__all__ = [
    "Bloom", "Running", "average_every", "bitmap_counts", "bloom_parts", "cardinalities", "container_counts", "containers",
    "co_group", "count_between", "first_seen_bloom", "left_outer", "merge_containers", "changelog", "connect_flat_map", "connect_map", "count_by",
    "count_grouping_sets", "cumulative_pv_uv", "enrich_ip", "exact_counts", "first_seen", "flag_late",
    "hash_exchange", "hll_counts", "hll_sketches", "keyed_combine", "keyed_reduce", "keyed_sum", "latest_only",
    "repair_late_items", "rolling_distinct", "route", "running", "running_sum", "salted_count",
    "set_parallelism", "sliding_count", "split_late", "top_lists", "top_n", "union_all", "windowed",
    "windowed_left_join", "word_count",
]
