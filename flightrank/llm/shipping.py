"""Make this package importable in the Python workers of every executor."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

import flightrank
from flightrank.session import shared_base
from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package through ``addPyFile``, once per application.

    Functions are then sent by name, so what a worker has built (vocabularies,
    known words) outlives a task. The archive lies in the shared folder and stays
    there, for executors that join later.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(flightrank.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    path = f"{shared_base(spark)}/package-{uuid.uuid4().hex}/flightrank.zip"
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)
