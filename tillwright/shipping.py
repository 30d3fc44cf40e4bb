"""Gives executors this package, wherever the driver imported it from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tillwright

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's source to the application's Python workers, once, by Spark's own file distribution."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(tillwright.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="tillwright-")) / "tillwright.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark
