"""Gives this package to the executors' Python."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, "_arborix_shipped", None):
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="arborix-"), "arborix_package.zip")
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    Path(path).write_bytes(data.getvalue())
    sc.addPyFile(path)
    sc._arborix_shipped = True


def _shared_dir(spark: SparkSession) -> str:
    """Sees to it that there is a checkpoint folder. A temporary one is set only where none is named and all tasks run on this machine."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            where = "file://" + tempfile.mkdtemp(prefix="arborix-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """df, computed and cut from its lineage by a checkpoint in the folder the cluster names in spark.checkpoint.dir."""
    _shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As settled, but as Parquet, in columns and compressed: for large tables of which later steps read some columns only."""
    path = f"{_shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
