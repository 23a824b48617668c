"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffles, splits skewed join partitions and picks broadcasts by the
# measured size; nothing in this package hints a broadcast of data that grows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str = "*", **settings: str) -> SparkSession:
    """Session for tests and the local bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("benchbook")
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="benchbook-warehouse-"),
    }
    for name, value in (SETTINGS | defaults | settings).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster is a cluster
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="benchbook-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write once to the shared folder (or to ``path``) and go on from there.

    Used where a result over the texts feeds several branches: the texts are then read once,
    and a lost executor costs a re-read of the table, not of the texts.
    """
    path = path or fresh_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a path or pattern; what they hold is not listed."""
    files, place = _file_system(spark, pattern)
    return [f.getPath().toString() for f in files.globStatus(place) or () if f.isDirectory()]


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the operating system names it, if it is a folder of files that all tasks mount."""
    files, place = _file_system(spark, path)
    local = files.getUri().getScheme() == "file"
    return files.makeQualified(place).toUri().getPath() if local else None


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data, wherever the cluster keeps it."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.mkdirs(place)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory())


def once_per_session(build: Callable) -> Callable:
    """Keep what ``build`` returns for the running session.

    For large column expressions: making them costs many calls to the JVM, and they name their
    inputs only, so every load and micro-batch can use the same ones.
    """
    made: dict[tuple, object] = {}

    @functools.wraps(build)
    def get(*args: str) -> object:
        session = SparkSession.active().sparkContext.applicationId
        if (session, *args) not in made:
            made[(session, *args)] = build(*args)
        return made[(session, *args)]

    return get
