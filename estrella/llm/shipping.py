"""Makes this package importable in Python workers that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import estrella

# Rows in a batch between Spark and Python: texts may be long, and both sides hold a whole batch.
ROWS_PER_BATCH = 2000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the workers with Spark's own file distribution, once per application.

    Larger Arrow batches than ``ROWS_PER_BATCH`` are turned down for the session, as they hold whole texts.
    """
    context = spark.sparkContext
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(size)) <= ROWS_PER_BATCH:
        spark.conf.set(size, ROWS_PER_BATCH)
    root = Path(estrella.__file__).parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="estrella-package-")) / "estrella.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
