"""Gives Python workers this package where the cluster does not have it installed."""

from __future__ import annotations

import tempfile
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package's sources to the session's files, once per context; Spark's own file server spreads them."""
    context = spark.sparkContext
    if context not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="postings-code-")) / "postings_code.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context)
    return spark
