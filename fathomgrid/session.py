"""Session factory with settings that hold from a laptop to a large cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that do not depend on the size of the cluster; sizes stay with spark-submit.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def session(app: str = "fathomgrid", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; `conf` overrides the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=DEFAULTS | conf).getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers of a session this package, once per application.

    Workers elsewhere can't import from the driver's working folder.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        folder = Path(tempfile.mkdtemp(prefix="fathomgrid-zip-"))
        target = folder / "fathomgrid_package.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, os.path.join(root.name, f.relative_to(root)))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)
    return spark
