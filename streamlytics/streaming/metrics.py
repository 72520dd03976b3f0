"""Metrics of a running stream: aggregates that Spark observes as rows pass, gathered for each micro-batch into a table."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from streamlytics.streaming.sinks import BatchTable


def observed(df: DataFrame, name: str, *aggregates: Column) -> DataFrame:
    """``df`` unchanged, with named aggregates counted as its rows pass."""
    return df.observe(name, *aggregates)


class MetricsTable(StreamingQueryListener):
    """Writes the metrics ``name`` of each micro-batch to a table, under the number of the micro-batch: a replayed one
    replaces itself. Triggers without data report no metrics and leave the table alone."""

    def __init__(self, spark: SparkSession, table: BatchTable, name: str):
        self.spark, self.table, self.name = spark, table, name
        self.ended: dict[str, threading.Event] = {}
        self.failed: list[BaseException] = []

    def _event(self, run_id) -> threading.Event:
        return self.ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(event.runId)

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None or not event.progress.numInputRows:
            return
        try:
            self.table.write(self.spark.createDataFrame([row]), event.progress.batchId)
        except Exception as error:  # shown by wait(): a listener's own errors are only logged
            self.failed.append(error)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()

    def wait(self, run_id, seconds: float = 60) -> None:
        """Until all events of a run that has ended are in the table: they come a little after the run's end."""
        if not self._event(run_id).wait(seconds):
            raise TimeoutError("the listener has not heard of the end of the query")
        if self.failed:
            raise self.failed[0]
