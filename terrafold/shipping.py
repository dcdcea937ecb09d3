"""Makes this package importable on executors that do not share the driver's files."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package to the session's Python files, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        at = os.path.join(tempfile.mkdtemp(prefix="terrafold-"), f"{_ROOT.name}.zip")
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted(_ROOT.rglob("*.py")):
                z.write(p, f"{_ROOT.name}/{p.relative_to(_ROOT)}")
        spark.sparkContext.addPyFile(at)
        _shipped.add(app)
    return spark
