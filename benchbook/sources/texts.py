"""Tables of whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Session setting: the number of parts that texts are dealt to as they are read. Unset, a table
#: is read as it lies, unless fewer splits than tasks run at once hold rows.
PARTS_SETTING = "spark.benchbook.textParts"


def read_texts(
    spark: SparkSession, path: str, key: str, partitions: int | None = None
) -> DataFrame:
    """A parquet table with one heavy text per row, in its own splits.

    A table of one file and row group is one task. Whoever knows that says so, by ``partitions``
    or ``PARTS_SETTING``; else ``spread`` finds it out. It costs a shuffle of the texts.
    """
    stated = partitions or int(spark.conf.get(PARTS_SETTING, "0"))
    df = spark.read.parquet(path)
    return df.repartition(stated, key) if stated else spread(df)


def _busy_splits(rows: DataFrame) -> int:
    """Splits that hold rows: a row group lies in one split, however finely its file is cut.

    A table's own splits tell it by the row groups' numbers of rows; no column is read.
    """
    return rows.select(F.spark_partition_id().alias("split")).distinct().count()


def spread(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows that are read in fewer than ``parts`` splits, dealt to so many; others as they are.

    ``parts`` defaults to ``PARTS_SETTING`` or, unset, to the number of tasks that run at once.
    Splits without rows do not count. The rows must come straight from files: their splits are
    counted, by a job that reads no column of a table (a micro-batch of a stream is read once).
    """
    spark = rows.sparkSession
    stated = parts or int(spark.conf.get(PARTS_SETTING, "0"))
    wanted = stated or spark.sparkContext.defaultParallelism
    splits = rows._jdf.queryExecution().toRdd().getNumPartitions()
    few = splits < wanted or _busy_splits(rows) < wanted
    return rows.repartition(wanted) if few else rows


def gathered(files: DataFrame, rows: DataFrame, contents: bool = True) -> DataFrame:
    """``rows`` of very many small files in fewer tasks, without a shuffle.

    A split counts every file as megabytes, so it ends after some thirty small ones, and each
    task after it would write a file or send a block of its own for them. Splits are gathered by
    up to 32, but never into fewer tasks than run at once nor, where ``contents`` are read, into
    tasks of more than about 128 MB. ``files`` is what was loaded, ``rows`` what is made of it.
    """
    splits = rows._jdf.queryExecution().toRdd().getNumPartitions()
    size = int(files._jdf.queryExecution().analyzed().stats().sizeInBytes()) if contents else 0
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, splits // 32, size >> 27)
    return rows.coalesce(tasks) if tasks < splits else rows
