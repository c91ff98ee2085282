"""Drop-folder CSV intake: each file once, columns by name, nothing lost.

A stream over the folder delivers only names and times of new files (the
``binaryFile`` source does not open a file whose content is not asked for). Each
batch reads its files with Spark's CSV reader, once per distinct header, so files
with other columns or another column order may arrive together. Columns never
seen before extend the stored schema. Rows that do not fit their own header keep
the raw line in ``_rescued_data``.
"""

from __future__ import annotations

import csv
import fnmatch
import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schemas as S
from eventlake.sources.versioned import Files, checkpoint_id

RESCUED = "_rescued_data"
_FILE_ROW = S.row(path=S.STRING, modificationTime=S.TIME, length=S.LONG, content=S.BINARY)


@dataclass(frozen=True)
class DropSource:
    """One kind of file in the drop folder and the table it feeds."""

    name: str
    pattern: str
    columns: T.StructType
    hints: str | None = None


DROP_SOURCES = (
    DropSource("client_master", "clients*.csv", S.CLIENT_MASTER),
    DropSource("banks", "banks*.csv", S.BANKS),
    DropSource("insurers", "insurers*.csv", S.INSURERS),
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.option("header", True).csv(path)


# -- schema of a table, kept beside it ------------------------------------------


def _schema_files(files: Files, table: str) -> list[str]:
    return sorted(n for n in files.names(f"{table}/_schema") if n.endswith(".json") and not n.startswith("."))


def stored_schema(spark: SparkSession, table: str) -> T.StructType | None:
    files = Files(spark, table)
    known = _schema_files(files, table)
    return T.StructType.fromJson(json.loads(files.read_text(f"{table}/_schema/{known[-1]}"))) if known else None


def evolve_schema(spark: SparkSession, table: str, found: T.StructType) -> T.StructType:
    """Add new columns to the stored schema; nothing is written when there are none."""
    files = Files(spark, table)
    known = _schema_files(files, table)
    before = stored_schema(spark, table)
    after = S.merge_schemas(before, found)
    if after != before:
        files.put_new(f"{table}/_schema/{len(known):06d}.json", json.dumps(after.jsonValue()))
    return after


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The whole append table with its current columns; older rows have NULL in newer ones."""
    schema = stored_schema(spark, table)
    if schema is None:
        raise FileNotFoundError(table)
    data = f"{table}/data"
    if not Files(spark, data).exists(data):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(data).select(*schema.fieldNames())


# -- reading files ----------------------------------------------------------------


def column_names(header: str) -> tuple[str, ...]:
    """Names of a header line. Names that a table cannot hold side by side are told apart by a number.

    Our own provenance columns keep their names; a file's column of such a name is stored with a number too.
    """
    taken = {name.lower() for name in S.PROVENANCE.fieldNames()}
    names = []
    for place, raw in enumerate(next(csv.reader([header.lstrip("\ufeff")]), [])):
        base = raw.strip() or f"_c{place}"
        name, number = base, 1
        while name.lower() in taken:
            number += 1
            name = f"{base}_{number}"
        taken.add(name.lower())
        names.append(name)
    return tuple(names)


def headers_of(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their columns; of each of these (at most a batch's) files one line is read."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        groups.setdefault(column_names(Files(spark, path).first_line(path)), []).append(path)
    return groups


def read_drop(
    spark: SparkSession, paths: Sequence[str], hints: str | None = None, known: T.StructType | None = None
) -> DataFrame:
    """Rows of CSV files with provenance; text columns unless hinted otherwise.

    Columns are matched without regard to case: the spelling of ``known`` counts, else the first one met.
    """
    spelling = {name.lower(): name for name in (known.fieldNames() if known else ())}
    parts = []
    for found, members in sorted(headers_of(spark, paths).items()):
        names = [spelling.setdefault(name.lower(), name) for name in found]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        if hints:
            hinted = {f.name for f in T.StructType.fromDDL(hints).fields}
            schema = S.apply_hints(schema, hints) if hinted <= set(names) else _hint_known(schema, hints)
        parts.append(
            spark.read.schema(schema.add(RESCUED, "string"))
            .option("header", True)
            .option("enforceSchema", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RESCUED)
            .csv(members)
            .select(
                *names,
                F.current_timestamp().alias("_ingested_at"),
                F.col("_metadata.file_path").alias("_source_file"),
                F.col("_metadata.file_modification_time").alias("_file_modified"),
                RESCUED,
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _hint_known(schema: T.StructType, hints: str) -> T.StructType:
    wanted = {f.name: f for f in T.StructType.fromDDL(hints).fields}
    return T.StructType([wanted.get(f.name, f) for f in schema.fields])


def _append(spark: SparkSession, table: str, source: DropSource, paths: Sequence[str], batch: str) -> DataFrame:
    """Store the rows of some files as one batch of the table and return them as stored."""
    own = T.StructType(source.columns.fields + S.PROVENANCE.fields)
    rows = read_drop(spark, paths, source.hints, S.merge_schemas(own, stored_schema(spark, table) or own))
    provenance = set(S.PROVENANCE.fieldNames())
    data_columns = [f for f in rows.schema.fields if f.name not in provenance]
    schema = evolve_schema(spark, table, S.merge_schemas(own, T.StructType(data_columns)))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in rows.columns]
    out = rows.select("*", *missing).select(*schema.fieldNames())
    # A replayed batch overwrites its own folder, so no row is appended twice.
    folder = f"{table}/data/batch={batch}"
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _take(
    files: Sequence[Row], spark: SparkSession, source: DropSource, table: str, batch: str
) -> DataFrame | None:
    """Append the files of a batch that no other batch of the table has taken; returns their stored rows.

    A new checkpoint is given all files again. What the table holds is told by path and modification
    time, so these are not stored twice, and rows of files that are gone by then stay. The note of the
    files follows their rows: a batch that dies in between is repeated as a whole.
    """
    if not files:
        return None
    ledger = f"{table}/_files"
    fresh = spark.createDataFrame(files, "path string, modified timestamp")
    if Files(spark, table).exists(ledger):
        taken = spark.read.schema("path string, modified timestamp, batch string").parquet(ledger)
        fresh = fresh.join(taken.filter(F.col("batch") != batch), ["path", "modified"], "left_anti")
    paths = [row["path"] for row in fresh.collect()]  # at most the files of one batch
    if not paths:
        return None
    rows = _append(spark, table, source, paths, batch)
    noted = spark.createDataFrame([f for f in files if f["path"] in set(paths)], "path string, modified timestamp")
    noted.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{ledger}/batch={batch}")
    return rows


def _listed(files: DataFrame) -> list[Row]:
    return files.select("path", F.col("modificationTime").alias("modified")).collect()  # at most max_files names


def file_stream(
    spark: SparkSession,
    landing: str,
    pattern: str,
    max_files: int = 1000,
    archive: str | None = None,
) -> DataFrame:
    """Names of new files. ``max_files`` limits a batch, ``archive`` moves finished files there."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_ROW).option("pathGlobFilter", pattern)
    reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(landing).select("path", "modificationTime")


def ingest(
    spark: SparkSession,
    source: DropSource,
    landing: str,
    table: str,
    checkpoint: str,
    max_files: int = 1000,
    archive: str | None = None,
    then: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Drain the new files of one source into its append table.

    ``then(rows, batch_id)`` sees the stored rows of each batch, again after a failure.
    """
    table = table.rstrip("/")
    evolve_schema(spark, table, T.StructType(source.columns.fields + S.PROVENANCE.fields))

    def on_batch(files: DataFrame, batch_id: int) -> None:
        # A new checkpoint counts batches from zero again: its id is part of the name.
        batch = f"{checkpoint_id(files.sparkSession, checkpoint)}-{batch_id}"
        stored = _take(_listed(files), files.sparkSession, source, table, batch)
        if stored is not None and then is not None:
            then(stored, batch_id)

    query = (
        file_stream(spark, landing, source.pattern, max_files, archive)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


# -- overwritten files ---------------------------------------------------------------


def ingest_overwritten(
    spark: SparkSession, source: DropSource, landing: str, table: str, ledger: str, max_files: int = 1000
) -> int:
    """Read files whose ``(path, modification time)`` is not in the ledger yet; returns how many.

    File streams remember paths only, so a file replaced in place needs this ledger.
    Listing and comparison run in Spark, and files are taken in slices of ``max_files``.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", source.pattern)
        .load(landing)
        .select("path", F.col("modificationTime").alias("modified"))
    )
    files, taken = Files(spark, ledger), 0
    while True:
        fresh = listed
        if files.exists(ledger):
            done = spark.read.schema("path string, modified timestamp").parquet(ledger)
            fresh = listed.join(done, ["path", "modified"], "left_anti")
        batch = fresh.orderBy("modified", "path").limit(max_files).collect()
        if not batch:
            return taken
        number = len(files.names(ledger))
        _append(spark, table.rstrip("/"), source, [r["path"] for r in batch], f"ledger-{number}")
        spark.createDataFrame(batch, "path string, modified timestamp").coalesce(1).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "static").parquet(f"{ledger}/slice={number}")
        taken += len(batch)


# -- one stream, many tables -----------------------------------------------------------


def route_by_file(
    spark: SparkSession, landing: str, root: str, checkpoint: str, sources: Iterable[DropSource], max_files: int = 1000
) -> None:
    """One stream over the whole folder; every batch is split over the tables by file name."""
    kinds = tuple(sources)

    def on_batch(files: DataFrame, batch_id: int) -> None:
        batch = f"{checkpoint_id(files.sparkSession, checkpoint)}-{batch_id}"
        listed = _listed(files)
        for source in kinds:
            mine = [f for f in listed if fnmatch.fnmatch(f["path"].rsplit("/", 1)[-1], source.pattern)]
            _take(mine, files.sparkSession, source, f"{root}/{source.name}", batch)

    query = (
        file_stream(spark, landing, "*", max_files)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


