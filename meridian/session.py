"""Session set-up: a builder with the engine's defaults, and shipping of this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def build_session(app: str = "meridian", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; ``conf`` keys use __ for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the workers once per application, so that Python operators run without installing it."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        to = os.path.join(tempfile.mkdtemp(prefix="meridian-"), "meridian.zip")
        with zipfile.ZipFile(to, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, Path(root.name) / path.relative_to(root))
        sc.addPyFile(to)
        _shipped.add(sc.applicationId)
    return spark
