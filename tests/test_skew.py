"""One client holds a third of all events: results stay whole."""

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_sql  # noqa: E402

NAMES = (
    "enrich_left",
    "latest_per_key",
    "daily_metrics",
    "metrics_delta",
    "client_documents",
    "document_push",
    "document_push_twice",
    "item_history_documents",
    "expectations_report",
    "stream_state",
)


@pytest.fixture(scope="module")
def skewed(spark, sf, tmp_path_factory):
    """The given tables as links, but with every third event given to one client."""
    folder = tmp_path_factory.mktemp("skewed")
    events = spark.read.parquet(f"{sf}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")).cast("bigint")
    events.withColumn("user_id", hot).toPandas().to_parquet(folder / "events.parquet", coerce_timestamps="us")
    for path in Path(sf).glob("*.parquet"):
        if path.name != "events.parquet":
            os.symlink(path, folder / path.name)
    return str(folder)


@pytest.fixture(scope="module")
def duck(skewed):
    return check_sql.duck(skewed)


@pytest.mark.parametrize("name", NAMES)
def test_hot_client(spark, duck, skewed, name):
    assert check_sql.compare(spark, duck, name, skewed) is None
