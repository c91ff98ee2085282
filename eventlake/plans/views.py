"""SQL names for the tables of an environment, as an analyst or a service reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.functions.masking import create_sql_functions
from eventlake.operators import governance as G
from eventlake.streaming import jobs as J


def register_views(
    spark: SparkSession,
    lake: J.Lake,
    caller: str | None = None,
    memberships: DataFrame | None = None,
    entitlements: DataFrame | None = None,
) -> list[str]:
    """Temporary views ``consents``, ``daily_metrics``, ``client_documents`` and ``quarantine``.

    With a caller, ``consents`` shows only the rows and values this caller may see, and
    the views of whole documents and rejected texts are left out. Views stand for the
    versions current at the time of the call.
    """
    create_sql_functions(spark)
    state = lake.state(spark).read()
    views = {"daily_metrics": lake.metrics(spark).read()}
    if caller is None:
        views["client_documents"] = lake.documents(spark).read()
        views["quarantine"] = J.read_quarantine(spark, lake)
    else:
        if memberships is None or entitlements is None:
            raise ValueError("a caller needs memberships and entitlements")
        state = G.secured_view(state, memberships, entitlements, caller)
    views["consents"] = state
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    return sorted(views)
