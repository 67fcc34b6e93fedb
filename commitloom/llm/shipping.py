"""The package on the executors, for functions that run in Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import commitloom

BATCH_ROWS = 1000
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors through Spark, once per application.

    The archive is made on the driver and fetched from it; nothing else reads
    it there.  Batches for Python are kept to ``BATCH_ROWS`` documents for the
    session: Spark bounds the bytes of a batch that goes in, but not what the
    operators hold for its rows (features, spans, hashes) until it goes out.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(commitloom.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="commitloom-")) / "commitloom.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
