"""The package on the executors: Python tasks of the operators import it there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bytes of texts that a task hands to Python at once. By rows alone, a run of very long texts would fill a worker.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's source files along with the application, once per application, and bound Arrow batches.

    A session started by ``spark-submit --py-files`` or with a PYTHONPATH has them already; twice does no harm.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="eventlake-")) / "eventlake.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
