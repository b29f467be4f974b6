"""Gets this package to the Python workers of a session."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession

from stockwise.session import work_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once per application, through the shared folder."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    uri = work_path(spark, "package")
    fs, folder = FileSystem.from_uri(uri)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/{package.name}.zip") as out:
        out.write(buffer.getvalue())
    spark.sparkContext.addPyFile(f"{uri}/{package.name}.zip")
    _SHIPPED.add(app)


def map_batches(rows: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand."""
    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)
