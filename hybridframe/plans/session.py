"""What a job needs from its session."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory(prefix="hybridframe-")
    archive = f"{folder.name}/hybridframe.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped[app] = folder  # executors fetch from it as they start; it goes when this process ends


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a session whose executors are threads of
    this process may do without: there a temporary folder is the same for all.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="hybridframe-")
    return f"{base.rstrip('/')}/hybridframe-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, for what is read more than once."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
