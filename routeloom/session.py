"""Session helpers shared by every part of the package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED = "_routeloom_shipped"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "routeloom") -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once per Spark context.

    Workers import the package by name.  A driver that only changed its own
    ``sys.path`` would leave them without it, so the sources go along as a zip.
    """
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp()) / "routeloom_src.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    setattr(context, _SHIPPED, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines see: ``spark.checkpoint.dir`` of the session.

    Only on a single machine, as in tests, a folder under ``/tmp/checkpoints`` stands
    in where that is unset; on a cluster it has to be set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all machines share")
        named = f"file:///tmp/checkpoints/{spark.sparkContext.applicationId}"
    return named.rstrip("/")


_PATHS: list[str] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, and the rows
    are computed once however often the result is used.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _PATHS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tables_written() -> int:
    """How many tables ``written`` has made and ``dropped`` not yet removed: a mark for ``dropped``."""
    return len(_PATHS)


def dropped(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Remove the tables written after the mark ``since``, but for the last ``keep``.

    Nothing that is still to be computed may read them.  The driver's collector then
    lets Spark remove the shuffle files of finished steps as well.
    """
    end = len(_PATHS) - keep
    folder = spark._jvm.org.apache.hadoop.fs.Path
    for path in _PATHS[since:end]:
        at = folder(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _PATHS[since:end]
    spark._jvm.System.gc()
