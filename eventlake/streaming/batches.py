"""Batch functions for ``foreachBatch``: retry, dead letters, draining."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sources.document_sink import ATTEMPTS, WAIT_BASE, retrying
from eventlake.sources.versioned import checkpoint_id

Batch = Callable[[DataFrame, int], None]
#: Part of a batch: its rows, the batch's number and the part's name.
PartOfBatch = Callable[[DataFrame, int, str], None]

#: Failing keys of one batch that are set aside before the stream stops instead.
MOST_POISON = 100
#: Names of the part that is the whole batch, and of the rows that are told unfit beforehand.
WHOLE, TOLD = "0-0", "told"
_PLACE, _FAULT = "_place_in_batch", "_fault_of_row"


def drain(rows: DataFrame, batch: Batch, checkpoint: str) -> None:
    """Process everything available now through ``batch``, then stop."""
    query = (
        rows.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_to_files(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append everything available now to files, exactly once, then stop."""
    query = (
        rows.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def with_retry(
    batch: Batch, attempts: int = ATTEMPTS, base: float = WAIT_BASE, sleep: Callable[[float], None] = time.sleep
) -> Batch:
    """Repeat a failing batch, waiting longer each time; the last error is raised."""

    def run(rows: DataFrame, batch_id: int) -> None:
        retrying(lambda: batch(rows, batch_id), attempts, base, sleep)

    return run


def letters_of(spark: SparkSession, path: str, checkpoint: str, batch_id: int) -> str:
    """The folder of a batch's dead letters: a new checkpoint counts batches from zero again, so its id is in the name."""
    return f"{path}/checkpoint={checkpoint_id(spark, checkpoint)}/batch_id={batch_id}"


def _set_aside(rows: DataFrame, error: Exception, folder: str) -> None:
    _write_letters(rows.withColumn("_error", F.lit(f"{type(error).__name__}: {error}")), folder)


def _write_letters(letters: DataFrame, folder: str) -> None:
    letters.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


def with_dead_letter(batch: Batch, path: str, checkpoint: str) -> Batch:
    """Set a failing batch aside as a whole with its error text, and let the stream go on.

    The folder is named by checkpoint and batch, so a replay replaces it and nothing else does.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        try:
            batch(rows, batch_id)
        except Exception as error:  # noqa: BLE001 - the point is to keep the stream alive
            _set_aside(rows, error, letters_of(rows.sparkSession, path, checkpoint, batch_id))

    return run


def isolating(
    apply: PartOfBatch, path: str, checkpoint: str, keys: Sequence[str], most: int = MOST_POISON, fault: Column | None = None
) -> Batch:
    """Set the rows aside that make a batch fail, each with its own error, and apply the rest once.

    ``fault`` is the error text of a row that can be told unfit by itself, else NULL: such rows are set aside in one pass,
    at any number. A batch that fails for other rows is halved by a hash of the keys until what fails shares one key; halves
    that work are applied as they are, and where the first half works the other one is known to fail.
    ``apply(rows, batch_id, part)`` must take in a part whole or not at all and skip one that it has; parts are named alike on
    a replay. With more than ``most`` failing keys beside those told the fault is not in the rows: the last error is raised,
    the stream stops and the batch comes again.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        folder = letters_of(rows.sparkSession, path, checkpoint, batch_id)
        told = F.lit(None).cast("string") if fault is None else fault
        placed = rows.withColumns({_PLACE: F.xxhash64(*keys), _FAULT: told}).persist(StorageLevel.MEMORY_AND_DISK)
        held, found = [placed], 0
        try:
            unfit = placed.filter(F.col(_FAULT).isNotNull())
            if fault is not None and not unfit.isEmpty():
                _write_letters(unfit.withColumnRenamed(_FAULT, "_error").drop(_PLACE), f"{folder}/part={TOLD}")
            fit = placed.filter(F.col(_FAULT).isNull()).drop(_FAULT)

            def rows_of(depth: int, index: int) -> DataFrame:
                """The rows whose hash begins with the ``depth`` bits of ``index``."""
                if not depth:
                    return fit
                if len(held) == 1:  # in order, so that a part is read without the others
                    held.append(fit.sortWithinPartitions(_PLACE).persist(StorageLevel.MEMORY_AND_DISK))
                least = (index << 64 - depth) - (1 << 63)
                return held[1].filter(F.col(_PLACE).between(least, least + (1 << 64 - depth) - 1))

            def settle(depth: int, index: int, fails: bool) -> bool:
                """Apply a part, or what of it can be applied: whether it went through whole."""
                nonlocal found
                part, name = rows_of(depth, index), f"{depth}-r{index}" if depth else WHOLE
                error = None if fails else _error_of(apply, part.drop(_PLACE), batch_id, name)
                if not fails and error is None:
                    return True
                least, greatest = part.agg(F.min(_PLACE), F.max(_PLACE)).first()
                if least is None:
                    raise error or RuntimeError(f"no rows in part {name}")
                if least == greatest:
                    error = error or _error_of(apply, part.drop(_PLACE), batch_id, name)
                    if error is None:
                        return True
                    found += 1
                    if found > most:
                        raise error
                    _set_aside(part.drop(_PLACE), error, f"{folder}/part={name}")
                    return False
                # Halves below the bits that all rows of the part share: neither is empty.
                low, high = least + (1 << 63), greatest + (1 << 63)
                shared = 64 - (low ^ high).bit_length()
                first = low >> 63 - shared
                settle(shared + 1, first + 1, settle(shared + 1, first, False))
                return False

            settle(0, 0, False)
        finally:
            for kept in held:
                kept.unpersist()

    return run


def _error_of(apply: PartOfBatch, part: DataFrame, batch_id: int, name: str) -> Exception | None:
    try:
        apply(part, batch_id, name)
    except Exception as error:  # noqa: BLE001 - whatever the rows make fail
        return error
    return None
