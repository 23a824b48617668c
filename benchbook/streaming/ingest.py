"""Continuous loading: new document files are picked up a bounded number at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from benchbook.plans.ingest import ingest
from benchbook.sources.texts import spread


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int = 1000,
    max_bytes: int | None = None,
) -> DataFrame:
    """Stream over parquet files below ``path``, in bounded micro-batches.

    With ``max_bytes`` a micro-batch takes whole files up to so many bytes (one file at least),
    which bounds a load however large or small files are; else ``max_files`` of them.
    """
    reader = spark.readStream.schema(schema)
    if max_bytes:
        return reader.option("maxBytesPerTrigger", max_bytes).parquet(path)
    return reader.option("maxFilesPerTrigger", max_files).parquet(path)


def stream_ingest(
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    parts: int | None = None,
    **options: object,
) -> StreamingQuery:
    """Load everything available, then stop; start again to go on where it ended.

    ``prepare`` turns a micro-batch into ``key, full_text``. Each micro-batch is one load of
    the batch engine, so duplicates are found against the whole store without streaming state,
    and one bad document is a row in the log. Loads are named after the checkpoint and the
    micro-batch: a micro-batch that is replayed replaces itself, a new checkpoint reads all
    files again and the log decides what is skipped.

    A micro-batch of fewer splits than ``parts`` (default: as many as tasks run at once) is dealt
    to so many before its texts are cleaned; one large row group is then work for all cores. One
    of more splits is taken as it lies.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, epoch: int) -> None:
        ingest(prepare(spread(batch, parts)), root, f"{run}-{epoch:08d}", **options)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
