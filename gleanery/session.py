"""Sessions, and the package on the executors."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the queries assume; what is set already stays."""
    builder = SparkSession.builder.appName("gleanery")
    if master:
        builder = builder.master(master)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python, once a session, unless their path has it."""
    app = spark.sparkContext.applicationId
    if app in _shipped or str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _shipped.add(app)
    archive = Path(tempfile.mkdtemp(prefix="gleanery-code-")) / "gleanery_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted((ROOT / "gleanery").rglob("*.py")):
            z.write(path, path.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(archive))
    sys.path[:] = [p for p in sys.path if not p.endswith(archive.name)]
