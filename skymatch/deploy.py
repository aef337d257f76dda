"""Send the package to the executors, so that functions that run in their Python workers can be imported there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add this package to the application's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="skymatch-py-")) / "skymatch.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SENT.add(context.applicationId)
    return spark
