"""Publishing to a log of files: encoded events, keyed, a folder per batch that appears as a whole or not at all.

The sink is a Python data source for streams. Each task writes the rows of its log partitions to a staging folder of its own
and reports it; the commit on the driver gathers what successful tasks reported in one folder and renames that into place,
named by stream and batch. A batch that is replayed finds its folder there and changes nothing. Readers never see staging
folders, whose names start with an underscore.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from eventlake import schemas as S
from eventlake.functions.contract import Contract
from eventlake.operators.events import publish_counters, publish_encode

FORMAT = "keyed_log"
PARTITIONS = 3
#: Parts that a log partition is written in side by side, so that no task holds the whole of it.
SLICES = 32
#: What is written; place counts the rows of a log partition's slice within a batch, in steps of SLICES.
WRITTEN = S.row(key=T.BinaryType(), value=T.BinaryType(), topic=S.STRING, partition=T.IntegerType(), timestamp=T.TimestampType())
#: Offsets of a batch start here times its number: they rise, and no batch needs to know the one before.
BATCH_OFFSETS = 1 << 32


@dataclass
class Written(WriterCommitMessage):
    folders: list[str]


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.base = f"{options['path'].rstrip('/')}/stream={options['stream']}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = _file_system(self.base)
        folder = f"{base}/_staging-{uuid.uuid4().hex}"
        sink, counts = None, {}
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                place = []
                sliced = "slice" in batch.schema.names  # else a partition is one slice
                slices = batch.column("slice").to_pylist() if sliced else [0] * batch.num_rows
                for at in zip(batch.column("partition").to_pylist(), slices, strict=True):
                    counts[at] = counts.get(at, -1) + 1
                    place.append(counts[at] * SLICES + at[1])
                batch = batch.drop_columns(["slice"]) if sliced else batch
                batch = batch.append_column("place", pa.array(place, pa.int64()))
                if sink is None:
                    fs.create_dir(folder, recursive=True)
                    sink = pq.ParquetWriter(f"{folder}/rows.parquet", batch.schema, filesystem=fs)
                sink.write_batch(batch)
        except BaseException:
            if sink is not None:
                sink.close()
                fs.delete_dir(folder)
            raise
        if sink is not None:
            sink.close()
        return Written([folder] if sink is not None else [])

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803 - named by Spark
        fs, base = _file_system(self.base)
        target = f"{base}/batch={batchId}"
        folders = [folder for message in messages if message for folder in message.folders]
        if folders and fs.get_file_info(target).type == pafs.FileType.NotFound:
            whole = f"{base}/_batch-{uuid.uuid4().hex}"
            fs.create_dir(whole)
            for number, folder in enumerate(folders):
                fs.move(f"{folder}/rows.parquet", f"{whole}/part-{number:05d}.parquet")
            fs.move(whole, target)
        self.abort(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        """Staging folders of tasks that reported go; those of lost executors stay, and nobody reads them."""
        fs, _ = _file_system(self.base)
        for message in messages:
            for folder in message.folders if message else ():
                if fs.get_file_info(folder).type != pafs.FileType.NotFound:
                    fs.delete_dir(folder)


class KeyedLog(DataSource):
    """``writeStream.format("keyed_log")`` with the options ``path`` and ``stream``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return WRITTEN

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> _Writer:  # noqa: N802
        return _Writer(self.options)


def publish(
    events: DataFrame,
    path: str,
    checkpoint: str,
    contract: Contract,
    topic: str = "events",
    stream: str = "publish",
    partitions: int = PARTITIONS,
) -> dict[str, int]:
    """Publish a stream of parsed events, drain and stop: how many were ``published`` and ``rejected``.

    Rows of a key stay in one partition of the log. A partition is dealt out in slices by the whole row, so that a hot key is
    spread as well; a row's slice is part of its offset. The counts are taken on the way, not by a second pass.
    """
    spark = events.sparkSession
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package
    spark.dataSource.register(KeyedLog)
    observed = events.observe("publish", *publish_counters(events, contract))
    encoded = publish_encode(observed, contract).select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        F.current_timestamp().alias("timestamp"),
        # the value too: rows of one key are in all slices
        F.pmod(F.xxhash64("value", "key"), F.lit(SLICES)).cast("int").alias("slice"),
    )
    query = (
        encoded.repartition(partitions * SLICES, "partition", "slice")
        .writeStream.format(FORMAT)
        .option("path", path)
        .option("stream", stream)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    counts = {"published": 0, "rejected": 0}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get("publish")
        for name in counts:
            counts[name] += row[name] if row else 0
    return counts


def published_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """What was published, with the columns of the log; the offset names a row within its topic and partition."""
    schema = T.StructType([*WRITTEN.fields, *S.row(place=T.LongType(), stream=S.STRING, batch=T.LongType()).fields])
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    offset = F.col("batch") * BATCH_OFFSETS + F.col("place")
    return reader.parquet(path).withColumn("offset", offset).select(*S.LOG.fieldNames())
