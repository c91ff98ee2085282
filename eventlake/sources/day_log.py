"""What a table's change feed adds and takes away, in a folder per day.

    <path>/data/_upto=N/ref_date=D/   net rows of the versions up to N that no earlier folder holds
    <path>/commits/N                  put there last; folders without it are never read

The rows of a day are the sum of what the folders say about that day. Whoever asks for some days joins with
them, and Spark skips the folders of all others while the query runs.

A folder holds at most one row per key and day and direction, so a day costs as much as there were changes in it.
Days are rebalanced when written: small ones share a task, a hot one is split over several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators import upsert as U
from eventlake.sources.versioned import Files, VersionedTable

DAY, UPTO, NET = "ref_date", "_upto", "_net"


class DayLog:
    def __init__(self, table: VersionedTable, path: str, columns: tuple[str, ...], time: str):
        self.table, self.path, self.columns, self.time = table, path.rstrip("/"), columns, time
        self._files = Files(table.spark, self.path)

    @property
    def schema(self) -> T.StructType:
        held = [self.table.schema[c] for c in self.columns]
        return T.StructType([*held, T.StructField(NET, T.LongType()), T.StructField(DAY, T.DateType())])

    def folders(self, upto: int | None = None) -> list[int]:
        """Versions that end a committed folder, in order."""
        known = sorted(int(n) for n in self._files.names(f"{self.path}/commits") if n.isdigit())
        return [n for n in known if upto is None or n <= upto]

    def follow(self, upto: int) -> None:
        """Take in the change rows up to a version. Running it again changes nothing."""
        known = self.folders()
        after = known[-1] if known else 0
        if after >= upto:
            return
        sign = F.when(F.col(U.CHANGE_TYPE).isin(U.INSERT, U.POSTIMAGE), 1).otherwise(-1)
        changes = self.table.changes(after, upto).withColumn(DAY, F.to_date(self.time))
        net = changes.groupBy(*self.columns, DAY).agg(F.sum(sign).cast("long").alias(NET)).filter(F.col(NET) != 0)
        laid = net.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "static")
        laid.partitionBy(DAY).parquet(f"{self.path}/data/{UPTO}={upto}")
        self._files.make_folder(f"{self.path}/commits")
        self._files.put_new(f"{self.path}/commits/{upto}", "")

    def read(self, upto: int | None = None) -> DataFrame:
        """All net rows as of a version, with their day as partition column."""
        spark: SparkSession = self.table.spark
        paths = [f"{self.path}/data/{UPTO}={n}" for n in self.folders(upto)]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*paths)
