"""Job settings from a ``key=value`` properties file."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Property names and defaults of existing job files, including the
# misspelt replay key, so those files keep working.
REQUIRED = ("bootstrap.servers", "kafka.input.topics")
DEFAULTS = {
    "group.id": "test1",
    "enable.auto.commit": "false",
    "auto.offset.reset": "earliest",
    "is.from.begining": "false",
    "checkpoint.interval": "5000",
}


@dataclass(frozen=True)
class JobSettings:
    """Parsed settings. ``group.id`` and ``enable.auto.commit`` are accepted but unused: offsets
    live in the query's own checkpoint."""

    values: dict[str, str] = field(default_factory=dict)

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.values.get(key, default)

    @property
    def topics(self) -> list[str]:
        return [t.strip() for t in self.values["kafka.input.topics"].split(",") if t.strip()]

    @property
    def reader_options(self) -> dict[str, str]:
        """Options for ``readStream.format("kafka")``."""
        options = {
            "kafka.bootstrap.servers": self.values["bootstrap.servers"],
            "subscribe": ",".join(self.topics),
        }
        if self.values["is.from.begining"] == "true":
            options["startingTimestamp"] = "0"
        else:
            options["startingOffsets"] = self.values["auto.offset.reset"]
        return options

    @property
    def trigger(self) -> dict[str, str]:
        """Keyword argument for ``writeStream.trigger``."""
        return {"processingTime": f"{int(self.values['checkpoint.interval'])} milliseconds"}

    def checkpoint(self, spark: SparkSession, query: str) -> str:
        """Checkpoint folder of one query; stable over restarts, kept when the query stops."""
        from streamlytics.session import shared_dir

        root = self.values.get("checkpoint.path")
        if root:
            return f"{root.rstrip('/')}/{query}"
        return shared_dir(spark, "jobs", query, unique=False)


def parse_settings(text: str) -> JobSettings:
    values = dict(DEFAULTS)
    for line in text.splitlines():
        line = line.strip()
        if line and not line.startswith(("#", "!")):
            key, _, value = line.partition("=")
            values[key.strip()] = value.strip()
    missing = [key for key in REQUIRED if not values.get(key)]
    if missing:
        raise KeyError(f"missing required settings: {', '.join(missing)}")
    return JobSettings(values)


def load_settings(path: str) -> JobSettings:
    with open(path, encoding="utf-8") as handle:
        return parse_settings(handle.read())
