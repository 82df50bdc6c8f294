"""Give Python workers this package where executors have no copy of it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()
MAX_BATCH = 4 << 20


def ship(spark: SparkSession) -> None:
    """Add the package to the files that Spark sends to each worker, once per application; the archive goes with the driver's own files.

    Arrow batches are bounded by bytes, as rows that hold whole pages are long; a bound that the session sets stays.
    """
    told = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("bB")
    if told.isdigit() and int(told) > MAX_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(MAX_BATCH))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp()) / f"{_ROOT.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(_ROOT.rglob("*.py")):
            out.write(source, source.relative_to(_ROOT.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
