"""This package's modules on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Sends the modules to the executors, once a context, so that their Python workers can import them."""
    context = spark.sparkContext
    if getattr(context, "_folioforge_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="folioforge-")) / "folioforge_modules.zip"
    with zipfile.ZipFile(target, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    context.addPyFile(str(target))
    context._folioforge_shipped = True
