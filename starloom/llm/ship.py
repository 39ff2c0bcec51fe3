"""Send this package to the executors, for sessions whose Python workers
cannot import it (nothing is installed, and the driver runs elsewhere)."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package's sources to the application once (Spark copies them
    from the driver to every executor, also to those that join later)."""
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), "starloom-sources.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        spark.sparkContext.addPyFile(path)
        _SENT.add(app)
    return spark
