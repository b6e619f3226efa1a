"""Puts this package where the executors' Python finds it, whatever way the session was started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_PACKAGE = Path(__file__).resolve().parents[1]
#: Of each application, the driver's folder from which Spark serves the archive; gone when Python ends.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Hand the package's files to Spark, which brings them to each executor; once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory(prefix=_PACKAGE.name)
    archive = Path(folder.name) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))



class Scratch:
    """Tables between steps, in the shared folder; each is removed once what follows from it is stored."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: dict[str, str] = {}

    def store(self, rows: DataFrame, label: str) -> DataFrame:
        path = self._paths[label] = scratch_path(self._spark, label)
        rows.write.parquet(path)
        return self._spark.read.schema(rows.schema).parquet(path)

    def remove(self, *labels: str) -> None:
        for label in labels:
            path = self._spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(label))
            path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
