"""The package for Python workers that cannot import it by themselves."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from walkvec.stage import stage_root

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to all workers of the session's application, once.

    It is written as a zip file to the shared stage folder and fetched from there,
    so it does not matter from which folder the driver was started.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, Path(root.name) / file.relative_to(root))
    jvm = spark.sparkContext._jvm
    path = f"{stage_root(spark)}/walkvec-{app}/package/walkvec.zip"
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(buffer.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString())
    _shipped.add(app)
