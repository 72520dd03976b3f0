"""Readers: files, sockets, in-memory rows, generators, JDBC and Kafka."""

from streamlytics.sources.files import csv_view, elements, number_sequence, socket_lines, text_lines
from streamlytics.sources.generate import access_rows, access_stream
from streamlytics.sources.jdbc import jdbc_query, jdbc_table
from streamlytics.sources.kafka import kafka_lines, kafka_records, read_kafka, record_id
from streamlytics.sources.settings import JobSettings, load_settings

__all__ = [
    "JobSettings", "access_rows", "access_stream", "csv_view", "elements", "jdbc_query", "jdbc_table",
    "kafka_lines", "kafka_records", "load_settings", "number_sequence", "read_kafka", "record_id",
    "socket_lines", "text_lines",
]
