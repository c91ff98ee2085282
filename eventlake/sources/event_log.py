"""The event log as a stream or a batch, whatever carries it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas as S

LOG_COLUMNS = S.LOG.fieldNames()


def broker_options(
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    max_offsets: int | None = None,
    security: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. One topic by name or all topics that match a pattern.

    ``earliest`` only matters for a new checkpoint: nothing published before is missed.
    ``security`` holds client settings such as ``sasl.mechanism``, without the ``kafka.`` prefix.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": "earliest"}
    options["subscribe" if topic else "subscribePattern"] = topic or pattern
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    for key, value in (security or {}).items():
        options[f"kafka.{key}"] = value
    return options


def stream_log(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    """Streaming log with the broker columns.

    ``fmt="kafka"`` needs the connector on the class path. File formats read a folder
    of log segments with the same columns; ``maxFilesPerTrigger`` limits a batch.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(S.LOG)
    rows = reader.load(path) if path else reader.load()
    return rows.select(*LOG_COLUMNS)


def batch_log(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(S.LOG)
    rows = reader.load(path) if path else reader.load()
    return rows.select(*LOG_COLUMNS)


def matching_topics(log: DataFrame, pattern: str) -> DataFrame:
    """Topic subscription by pattern for logs that are files; the whole name must match."""
    return log.filter(F.col("topic").rlike(f"^(?:{pattern})$"))
