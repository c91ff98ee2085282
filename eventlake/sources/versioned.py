"""A keyed table of parquet files with versions and a change feed.

Open-source Spark cannot MERGE into plain parquet. This helper only lays out the
files that Spark writes and reads; all row work is DataFrame operations.

    <path>/_table.json                              schema, keys, bucket count
    <path>/data/_version=N/_kind=state/_bucket=B/   state rows of bucket B as of version N
    <path>/data/_version=N/_kind=change/_bucket=B/  change rows of version N
    <path>/commits/N.json                           one line: which version holds each bucket

A key always falls into the same bucket. A merge reads and rewrites only the
buckets its source touches; the new commit points to the older files of all
others. The commit file is renamed into place last. Files of a version without
a commit are never read, so a job that dies half-way leaves no trace in results.

One writer per table at a time, which a stream's checkpoint already guarantees.
Each commit also records how far every feeding stream has come, so progress and
data change together: a replayed batch is recognised and skipped.

Sizing: choose ``buckets`` so that one bucket is about 1 GB or less of parquet.
The commit file and the driver hold one small number per bucket, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators import upsert as U
from eventlake.session import sql_conf

# Names of the layout columns; the leading underscore keeps them apart from table columns.
BUCKET, KIND, VERSION = "_bucket", "_kind", "_version"
#: By which a merge is dealt out: so many slices of each bucket, told by the same hash.
SLICE, SLICES = "_bucket_slice", 16


class Files:
    """The few file-system calls needed, through Hadoop.

    Publishing relies on a rename that fails where the name is taken. HDFS does that in one step; a local disk
    and object stores look first, so there only one writer per table at a time is safe.
    """

    def __init__(self, spark: SparkSession, base: str):
        self._jvm = spark.sparkContext._jvm
        self._base = self._path(base)
        self._fs = self._base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(path)]

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def first_line(self, path: str) -> str:
        """The first line of a text file, read alone; compressed files are told by their ending."""
        where = self._path(path)
        conf = self._fs.getConf()
        codec = self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        stream = self._fs.open(where)
        try:
            plain = codec.createInputStream(stream) if codec is not None else stream
            reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(plain, "UTF-8"))
            return reader.readLine() or ""
        finally:
            stream.close()

    def put_new(self, path: str, text: str) -> None:
        """Create a file that appears whole or not at all, and never replaces one."""
        if self.exists(path):
            raise FileExistsError(path)
        folder, name = path.rsplit("/", 1)
        hidden = self._path(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if not self._fs.rename(hidden, self._path(path)):
            raise FileExistsError(path)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when this checkpoint was made."""
    return json.loads(Files(spark, checkpoint).read_text(f"{checkpoint}/metadata"))["id"]


@dataclass(frozen=True)
class Commit:
    version: int
    buckets: dict[int, int] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    changed: tuple[int, ...] = ()

    def to_json(self) -> str:
        body = {
            "version": self.version,
            "buckets": {str(k): v for k, v in sorted(self.buckets.items())},
            "applied": self.applied,
            "changed": list(self.changed),
        }
        return json.dumps(body) + "\n"

    @staticmethod
    def from_json(text: str) -> Commit:
        body = json.loads(text)
        return Commit(
            body["version"],
            {int(k): v for k, v in body["buckets"].items()},
            body["applied"],
            tuple(body["changed"]),
        )


NO_COMMIT = Commit(0)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 bucket_by: Sequence[str], buckets: int):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema, self.keys = schema, tuple(keys)
        self.bucket_by, self.buckets = tuple(bucket_by), buckets
        self._files = Files(spark, self.path)

    # -- opening ---------------------------------------------------------------

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        bucket_by: Sequence[str] | None = None,
        buckets: int = 16,
    ) -> VersionedTable:
        """Open the table, creating it first where it is missing."""
        files, description = Files(spark, path), f"{path.rstrip('/')}/_table.json"
        if files.exists(description):
            return cls.open(spark, path)
        table = cls(spark, path, schema, keys, bucket_by or keys, buckets)
        body = {
            "schema": schema.jsonValue(),
            "keys": list(table.keys),
            "bucket_by": list(table.bucket_by),
            "buckets": buckets,
        }
        files.make_folder(f"{table.path}/commits")
        files.put_new(description, json.dumps(body))
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VersionedTable:
        body = json.loads(Files(spark, path).read_text(f"{path.rstrip('/')}/_table.json"))
        schema = T.StructType.fromJson(body["schema"])
        return cls(spark, path, schema, body["keys"], body["bucket_by"], body["buckets"])

    # -- versions --------------------------------------------------------------

    def versions(self) -> list[int]:
        names = self._files.names(f"{self.path}/commits")
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith("."))

    def commit(self, version: int | None = None) -> Commit:
        known = self.versions()
        if version is None:
            if not known:
                return NO_COMMIT
            version = known[-1]
        elif version == 0:
            return NO_COMMIT
        elif version not in known:
            raise ValueError(f"no version {version} in {self.path}")
        return Commit.from_json(self._files.read_text(self._commit_path(version)))

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:012d}.json"

    def _folder(self, version: int, kind: str | None = None, bucket: int | None = None) -> str:
        path = f"{self.path}/data/{VERSION}={version}"
        return path if kind is None else f"{path}/{KIND}={kind}/{BUCKET}={bucket}"

    def already_applied(self, stream: str, batch_id: int) -> bool:
        return self.commit().applied.get(stream, -1) >= batch_id

    # -- reading ---------------------------------------------------------------

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def slice_of(self) -> Column:
        """A finer bucket; the rows of a slice are all in one bucket."""
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets * SLICES)).cast("int")

    def _read(self, paths: Iterable[str], partitions: T.StructType) -> DataFrame:
        paths = list(paths)
        schema = T.StructType(self.schema.fields + partitions.fields)
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths)

    def read(self, version: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """State rows as of a version (the latest by default), optionally of some buckets only."""
        return self._state(self.commit(version), only).select(*self.schema.fieldNames())

    def _state(self, commit: Commit, only: Iterable[int] | None = None) -> DataFrame:
        wanted = set(commit.buckets if only is None else only)
        paths = [
            self._folder(v, "state", b)
            for b, v in sorted(commit.buckets.items())
            if b in wanted
        ]
        return self._read(paths, T.StructType([T.StructField(BUCKET, T.IntegerType())]))

    def buckets_of_keys(self, rows: DataFrame) -> list[int]:
        """Buckets that rows with the bucketing columns fall into: at most ``buckets`` numbers."""
        found = rows.select(self.bucket_of().alias(BUCKET)).distinct().collect()
        return sorted(r[BUCKET] for r in found)

    def lookup(self, **key) -> DataFrame:
        """Point lookup: only the key's bucket is read."""
        probe = self.spark.range(1).select(*[F.lit(key[c]).alias(c) for c in self.bucket_by])
        rows = self.read(only=self.buckets_of_keys(probe))
        for name, value in key.items():
            rows = rows.filter(F.col(name).eqNullSafe(F.lit(value)))
        return rows

    def changes(self, after: int, upto: int | None = None) -> DataFrame:
        """Change rows of the committed versions in ``(after, upto]``, with ``_commit_version``."""
        return self.changes_in([v for v in self.versions() if v > after and (upto is None or v <= upto)])

    def changes_in(self, versions: Iterable[int]) -> DataFrame:
        paths = [self._folder(v, "change", b) for v in sorted(versions) for b in self.commit(v).changed]
        extra = T.StructType(
            [T.StructField(U.CHANGE_TYPE, T.StringType()), T.StructField(VERSION, T.LongType())]
        )
        rows = self._read(paths, extra)
        return rows.select(
            U.CHANGE_TYPE, *self.schema.fieldNames(), F.col(VERSION).alias(U.COMMIT_VERSION)
        )

    def current_rows(self, keys: DataFrame) -> DataFrame:
        """The latest row of each given key that still has one; reads only their buckets."""
        rows = self.read(only=self.buckets_of_keys(keys))
        return self.matching(rows, keys, "left_semi")

    def missing_keys(self, keys: DataFrame) -> DataFrame:
        """The given keys that have no row any more."""
        rows = self.read(only=self.buckets_of_keys(keys))
        return self.matching(keys, rows, "left_anti")

    def matching(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys])
        on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.keys]
        return left.join(right, on, how)

    # -- writing ---------------------------------------------------------------

    def merge(
        self,
        source: DataFrame,
        *,
        stream: str | None = None,
        batch_id: int | None = None,
        verdicts: Callable[[DataFrame, DataFrame, str], DataFrame] | None = None,
        touched: list[int] | None = None,
        all_buckets: bool = False,
        **options,
    ) -> Commit:
        """Merge a source with unique keys and commit the next version.

        ``verdicts(state, source, co_partition)`` replaces the standard merge where
        the rules differ. ``all_buckets`` is for merges that act on keys the source lacks.
        """
        last = self.commit()
        if stream is not None and last.applied.get(stream, -1) >= batch_id:
            return last
        source = source.withColumn(BUCKET, self.bucket_of())
        if touched is None:
            found = source.select(BUCKET).distinct().collect()
            touched = sorted(r[BUCKET] for r in found)
        if all_buckets:
            touched = sorted(set(touched) | set(last.buckets))
        applied = dict(last.applied) | ({stream: batch_id} if stream is not None else {})
        if not touched:
            return self._publish(Commit(last.version + 1, last.buckets, applied)) if stream else last

        build = verdicts or (lambda t, s, by: U.merge(t, s, self.keys, co_partition=by, **options))
        columns = [*self.schema.fieldNames(), BUCKET, self.slice_of().alias(SLICE)]
        state = self._state(last, touched).select(*columns).repartition(SLICE)
        arriving = source.select(*columns).repartition(SLICE)
        version = last.version + 1
        # Both sides are shuffled once, by slice. The join and the write reuse that layout without a
        # second shuffle; a bucket is the work of as many tasks as its size asks for, each with a file of its own.
        with sql_conf(self.spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
            self._write(build(state, arriving, SLICE), version)
        held = {b for b in last.buckets if b not in set(touched)}
        wrote_state = self._written(version, "state")
        buckets = {b: last.buckets[b] for b in held} | {b: version for b in wrote_state}
        return self._publish(Commit(version, buckets, applied, tuple(self._written(version, "change"))))

    def _write(self, verdicts: DataFrame, version: int) -> None:
        """State rows and change rows in one pass over the verdicts."""

        def output(kind: str, change: str | None, column: str) -> Column:
            return F.struct(
                F.lit(kind).alias("kind"),
                F.lit(change).cast("string").alias("change"),
                F.col(column).alias("row"),
            )

        def change(name: str, column: str) -> Column:
            return output("change", name, column)

        state = output("state", None, U.NEW)

        outputs = (
            F.when(F.col(U.ACTION) == U.INSERT, F.array(state, change(U.INSERT, U.NEW)))
            .when(
                F.col(U.ACTION) == U.UPDATE,
                F.array(state, change(U.PREIMAGE, U.OLD), change(U.POSTIMAGE, U.NEW)),
            )
            .when(F.col(U.ACTION) == U.DELETE, F.array(change(U.DELETE, U.OLD)))
            .otherwise(F.array(state))
        )
        rows = verdicts.select(F.explode(outputs).alias("_out")).select(
            *[F.col(f"_out.row.{c}").alias(c) for c in self.schema.fieldNames()],
            F.col("_out.change").alias(U.CHANGE_TYPE),
            F.col("_out.kind").alias(KIND),
            F.col(f"_out.row.{BUCKET}").alias(BUCKET),
        )
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            KIND, BUCKET
        ).parquet(self._folder(version))

    def _written(self, version: int, kind: str) -> list[int]:
        names = self._files.names(f"{self._folder(version)}/{KIND}={kind}")
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))

    def _publish(self, commit: Commit) -> Commit:
        self._files.put_new(self._commit_path(commit.version), commit.to_json())
        return commit

    def delete(self, gone: Callable[[Column], Column]) -> Commit:
        """Remove the rows for which ``gone(row)`` is true, as a merge: the change feed tells of each."""
        nothing = self.spark.createDataFrame([], self.schema)
        return self.merge(nothing, all_buckets=True, delete_missing=gone, unique_source=True)

    def replace(self, rows: DataFrame, files_per_bucket: int = 1) -> Commit:
        """Write the given rows as the complete next state, e.g. after expiry; no change rows."""
        last = self.commit()
        version = last.version + 1
        spread = F.pmod(F.hash(*self.keys), F.lit(files_per_bucket))
        out = rows.select(*self.schema.fieldNames()).withColumn(BUCKET, self.bucket_of())
        (
            out.withColumn(KIND, F.lit("state"))
            .repartition(BUCKET, spread)
            .sortWithinPartitions(BUCKET, *self.keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(KIND, BUCKET)
            .parquet(self._folder(version))
        )
        buckets = {b: version for b in self._written(version, "state")}
        return self._publish(Commit(version, buckets, dict(last.applied)))

    def compact(self) -> Commit:
        """Rewrite small files, sorted by key, so that key filters skip row groups."""
        return self.replace(self.read())

    # -- following ---------------------------------------------------------------

    def commit_stream(self, max_commits_per_batch: int) -> DataFrame:
        """Stream of commit files: one row per committed version, each delivered once."""
        reader = self.spark.readStream.schema("version bigint")
        return reader.option("maxFilesPerTrigger", max_commits_per_batch).json(f"{self.path}/commits")

    def follow(
        self,
        apply: Callable[[DataFrame, int], None],
        checkpoint: str,
        max_commits_per_batch: int = 100,
    ) -> None:
        """Drain the change feed: ``apply(change_rows, batch_id)`` per batch of new versions.

        The stream carries version numbers; the change rows are read from the files of
        exactly these committed versions, so half-written versions cannot leak in.
        """
        path = self.path

        def on_batch(commits: DataFrame, batch_id: int) -> None:
            versions = [r["version"] for r in commits.collect()]  # at most max_commits_per_batch
            if versions:
                apply(VersionedTable.open(commits.sparkSession, path).changes_in(versions), batch_id)

        query = (
            self.commit_stream(max_commits_per_batch)
            .writeStream.foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def pending(self, target: VersionedTable, consumer: str, max_versions: int = 100) -> Iterable[tuple[int, int]]:
        """Version spans ``(after, upto]`` that ``target`` has not taken in yet, oldest first.

        ``target`` records the last version with each of its commits, under the consumer's name.
        """
        while True:
            done = max(0, target.commit().applied.get(consumer, 0))
            ahead = [v for v in self.versions() if v > done][:max_versions]
            if not ahead:
                return
            yield done, ahead[-1]
