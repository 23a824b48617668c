"""Objects on a file system that all tasks mount, listed and read by the tasks.

Spark's reader of files holds one entry a file on the driver, which millions of small objects do
not fit. These functions hand folders and rows of a listing to the tasks, and hide what Spark's
reader hides: empty files, and names that begin with a dot or an underline.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# the functions of the tasks are nested, so executors need not import this package
_HIDDEN = re.compile(r"\.|_(?!.*=)|.*\._COPYING_\Z", re.DOTALL)
_HIDDEN_FOLDER = re.compile(rf"(?!_metadata|_common_metadata)(?:{_HIDDEN.pattern})", re.DOTALL)

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def files_below(spark: SparkSession, folders: list[tuple[str, str, str]]) -> DataFrame:
    """``key, year, length, millis`` of the files below folders, each given as its path, the
    beginning of its keys and its year; a folder is walked by one task.

    ``millis`` is the time of the last change, as exactly as Hadoop tells it. What goes while it
    is listed is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        def walk(path: str, start: str) -> Iterator[tuple[str, int, int]]:
            left = [(os.fsencode(path), start)]
            while left:
                folder, key = left.pop()
                try:
                    entries = os.scandir(folder)
                except FileNotFoundError:
                    continue
                with entries:
                    for entry in entries:
                        name = entry.name.decode("utf-8", "replace")
                        if entry.is_dir():
                            if not _HIDDEN_FOLDER.match(name):
                                left.append((entry.path, f"{key}{name}/"))
                            continue
                        if _HIDDEN.match(name):
                            continue
                        try:
                            found = entry.stat()
                        except FileNotFoundError:
                            continue
                        if found.st_size:
                            yield f"{key}{name}", found.st_size, found.st_mtime_ns // 1_000_000

        def batch_of(rows: list[tuple[str, int, int]], year: str) -> pa.RecordBatch:
            names, sizes, times = zip(*rows)
            return pa.RecordBatch.from_pydict(
                {"key": names, "year": [year] * len(rows), "length": sizes, "millis": times}
            )

        for batch in batches:
            for number in batch.column(0).to_pylist():
                path, start, year = folders[number]
                rows = []
                for row in walk(path, start):
                    rows.append(row)
                    if len(rows) == BATCH_ROWS:
                        yield batch_of(rows, year)
                        rows = []
                if rows:
                    yield batch_of(rows, year)

    numbers = spark.range(0, len(folders), 1, len(folders))
    return numbers.mapInArrow(run, "key string, year string, length long, millis long")


def with_content(listed: DataFrame, root: str, prefix: str) -> DataFrame:
    """Rows with the ``content`` of the object below ``root`` that their ``key`` names.

    A row whose object is not there, is empty, hidden or cannot be read goes. Keys begin with
    ``prefix``; one that leads out of it by dots names nothing. A task holds some megabytes, or
    one object.
    """
    made = T.StructType([*listed.schema.fields, T.StructField("content", T.BinaryType())])
    at = listed.columns.index("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def content_of(key: str) -> bytes | None:
            *folders, name = key[len(prefix):].split("/")
            if not name or _HIDDEN.match(name):
                return None
            if any(not f or _HIDDEN_FOLDER.match(f) for f in folders):
                return None
            try:
                with open(f"{root}/{key}".encode(), "rb") as file:
                    return file.read()
            except (OSError, ValueError):  # the latter for a name that no file can have
                return None

        for batch in batches:
            rows, contents, size = [], [], 0

            def read() -> pa.RecordBatch:
                columns = [c.take(pa.array(rows, pa.int32())) for c in batch.columns]
                names = [*batch.schema.names, "content"]
                return pa.RecordBatch.from_arrays([*columns, pa.array(contents, pa.binary())], names)

            for row, key in enumerate(batch.column(at).to_pylist()):
                if content := content_of(key):
                    rows.append(row)
                    contents.append(content)
                    size += len(content)
                if size >= BATCH_BYTES or len(rows) == BATCH_ROWS:
                    yield read()
                    rows, contents, size = [], [], 0
            if rows:
                yield read()

    return listed.mapInArrow(run, made)
