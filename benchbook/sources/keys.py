"""Object-key listings: pruned by year and language, filtered, limited, sampled.

A listing is any DataFrame with a ``key`` column. ``list_objects`` walks a folder tree and returns
what it found as a table in the shared folder, so the driver holds no entry a file;
``refresh_inventory`` keeps such listings, year by year, and compares them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.session import (
    exists, folders_in, fresh_folder, local_path, matching_folders, remove, stage,
)
from benchbook.sources.mounted import files_below
from benchbook.sources.texts import gathered

#: Value of a folder whose year is NULL.
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"
INVENTORY = "key string, length long, modified timestamp, year int"


def key_year(key: Column) -> Column:
    """Year folder of a key, NULL without one."""
    return F.regexp_extract(key, r"/year=(\d{4})/", 1).try_cast("int")


def year_folder(year: Column | int, language: str = V.LANGUAGE) -> Column:
    year = year if isinstance(year, Column) else F.lit(year)
    return F.concat(F.lit(f"{V.KEY_ROOT}year="), year.cast("string"), F.lit(f"/{language}/"))


def is_pdf(key: Column) -> Column:
    return F.lower(key).endswith(".pdf")


def key_of(path: Column | str, prefix: str = V.KEY_ROOT) -> Column:
    """Key in the path of a file: the part from ``prefix`` on."""
    path = F.col(path) if isinstance(path, str) else path
    return F.concat(F.lit(prefix), F.element_at(F.split(path, prefix, 2), -1))


def list_objects(
    spark: SparkSession, root: str, years: list[int] | None = None, language: str | None = None
) -> DataFrame:
    """``key, year, length, modified`` of the objects below ``root`` (its part from ``data/``).

    Contents are not read. Of the asked years only their own folders are listed, those that do
    not exist being left out; without ``years`` all are. The listing is made once, as the store is
    now, and kept in the shared folder. On a file system that is mounted a task lists a folder
    of a year; elsewhere Spark's reader does, whose entries of one such folder at a time the
    driver holds.
    """
    columns = "key string, length long, modified timestamp, year int"
    top, below = f"{root}/{V.KEY_ROOT}", f"/{language}" if language else ""
    if years is None:
        asked = [f"{top}year=*{below}"]
    else:
        there = [y for y in sorted(set(years)) if exists(spark, f"{top}year={y}")]
        asked = [f"{top}year={y}{below}" for y in there]
    # folders, never their files: each path handed to the reader is listed as a root of its own
    listed, place = [], fresh_folder(spark, "listing")
    for folder in (found for path in asked for found in matching_folders(spark, path)):
        inside = folder.split("/")[-len(f"year={below}".split("/")):]
        year = inside[0].removeprefix("year=")
        listed.append((folder, "/".join(inside), None if year == NO_YEAR else year))
    if listed and local_path(spark, top):
        folders = [(local_path(spark, f), f"{V.KEY_ROOT}{i}/", year) for f, i, year in listed]
        found = files_below(spark, folders)
        _keep(found.withColumn("modified", F.timestamp_millis("millis")), place)
    else:
        for folder, _, year in listed:
            reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            files = reader.load(folder)
            found = files.select(
                key_of("path").alias("key"), F.lit(year).cast("string").alias("year"), "length",
                F.col("modificationTime").alias("modified"),
            )
            _keep(gathered(files, found, contents=False), place)
    kept = [f"{place}/{name}" for name in folders_in(spark, place) if name.startswith("year=")]
    if not kept:
        return spark.createDataFrame([], columns).select("key", "year", "length", "modified")
    found = spark.read.schema(columns).option("basePath", place).parquet(*kept)
    if years is not None:
        found = found.filter(F.col("year").isin(*years))
    return found.select("key", "year", "length", "modified")


def _keep(found: DataFrame, place: str) -> None:
    """Add to a listing in folders of years."""
    year = F.col("year").cast("int").alias("year")
    rows = found.select("key", "length", "modified", year)
    rows.write.mode("append").partitionBy("year").parquet(place)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """The listing that ``refresh_inventory`` keeps, partitioned by year."""
    path = f"{root}/inventory"
    if not exists(spark, path):
        return spark.createDataFrame([], INVENTORY)
    return spark.read.schema(INVENTORY).parquet(path)


def refresh_inventory(spark: SparkSession, listing: DataFrame, root: str, years: list[int]) -> DataFrame:
    """Bring the inventory of some years up to date; returns ``key, year, change``.

    ``listing`` is fresh for these years (``list_objects``). Changes are ``added``, ``changed``
    (another length or a later time) and ``gone``; what did not change is not returned, so a load
    need only look at the returned keys. Both sides are cut to the years first, where the
    inventory's other folders are pruned, and only those years' folders are written anew, each as
    one step that a broken refresh repeats. The changes are settled before the folders are.
    """
    asked = F.col("year").isin(*sorted(set(years)))
    fresh = listing.filter(asked).select("key", "year", "length", "modified").dropDuplicates(["key"])
    known = inventory(spark, root).filter(asked)
    old = known.select(
        "key", F.col("year").alias("_year"), F.col("length").alias("_length"),
        F.col("modified").alias("_modified"),
    )
    differs = (F.col("length") != F.col("_length")) | (F.col("modified") > F.col("_modified"))
    change = (
        F.when(F.col("_year").isNull(), "added").when(F.col("year").isNull(), "gone")
        .when(differs, "changed")
    )
    compared = stage(
        fresh.join(old, "key", "full_outer").select(
            "key", F.coalesce("year", "_year").alias("year"), "length", "modified",
            change.alias("change"),
        ),
        "inventory",
    )
    there = compared.filter(F.col("modified").isNotNull()).select("key", "length", "modified", "year")
    left = {r["year"] for r in there.select("year").distinct().collect()}
    for year in set(years) - left:  # none of its objects is left, so no row replaces its folder
        remove(spark, f"{root}/inventory/year={year}")
    placed = there.repartitionByRange("year", "key").sortWithinPartitions("year", "key")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "year"
    ).parquet(f"{root}/inventory")
    return compared.filter(F.col("change").isNotNull()).select("key", "year", "change")


def parse_years(years: str | None = None, year: int | None = None) -> list[int]:
    """Years asked for: a single ``year`` wins over ``years`` (range or list), else all."""
    if year:
        return [year]
    if years and "-" in years:
        first, last = (int(part) for part in years.split("-"))
        return list(range(first, last + 1))
    if years:
        return [int(part) for part in years.split(",") if part.strip()]
    return list(range(V.FIRST_YEAR, V.LAST_YEAR + 1))


def year_table(spark: SparkSession, years: list[int]) -> DataFrame:
    """The asked years with their position, repeats kept (``position`` from 0)."""
    return spark.range(1).select(
        F.posexplode(F.array(*[F.lit(y) for y in years])).alias("position", "year")
    )


def keys_in_years(listing: DataFrame, years: list[int], language: str = V.LANGUAGE) -> DataFrame:
    """Keys of the asked year folders; a year asked twice lists its keys twice.

    ``listing`` must have ``key`` and ``year``. The distinct years filter the scan, so a
    year-partitioned inventory is pruned; the tiny year table (one row per asked year) only
    adds order and repeats.
    """
    spark = listing.sparkSession
    scanned = listing.filter(F.col("year").isin(*sorted(set(years)))).filter(
        F.startswith("key", year_folder(F.col("year"), language))
    )
    return scanned.join(F.broadcast(year_table(spark, years)), "year")


def keys_under(listing: DataFrame, prefix: str = V.KEY_ROOT) -> DataFrame:
    return listing.filter(F.startswith("key", F.lit(prefix)))


def pdf_keys(listing: DataFrame) -> DataFrame:
    return listing.filter(is_pdf(F.col("key")))


def limit_keys(listing: DataFrame, max_keys: int | None, *order: str) -> DataFrame:
    """The first ``max_keys`` keys in listing order; 0 or None keeps all.

    ``order`` may name columns of few values (the position of a year) before ``key``. Keys are
    counted by those and by their beginning up to the year, which agrees with the order; groups
    that are wanted whole are taken by a filter, and only the last, cut one is sorted. One row
    per year folder comes to the driver.
    """
    if not max_keys:
        return listing
    before = [c for c in order if c != "key"]
    folder = F.left("key", F.lit(len(f"{V.KEY_ROOT}year=0000/")))
    counted = listing.groupBy(*before, folder.alias("_folder")).agg(F.count("*").alias("n"))
    groups = sorted(counted.collect(), key=lambda r: tuple(r[:-1]))
    mark = F.struct(*before, folder.alias("_folder"))
    whole, left = F.lit(False), max_keys
    for row in groups:
        here = F.struct(*[F.lit(v).alias(n) for v, n in zip(row[:-1], [*before, "_folder"])])
        if row["n"] > left:
            cut = listing.filter(mark == here).orderBy("key").limit(left)
            return listing.filter(whole).union(cut)
        whole, left = mark <= here, left - row["n"]
    return listing


def list_pdf_keys(
    listing: DataFrame,
    prefix: str = V.KEY_ROOT,
    max_keys: int | None = None,
    years: list[int] | None = None,
) -> DataFrame:
    """Whole listing call: year folders or a prefix, suffix filter, one limit over all."""
    if years:
        keys = pdf_keys(keys_in_years(listing, years))
        return limit_keys(keys, max_keys, "position", "key").select("key", "year")
    keys = pdf_keys(keys_under(listing, prefix))
    return limit_keys(keys, max_keys).select("key", "year")


def sample_keys_per_year(
    listing: DataFrame, per_year: int, years: list[int] | None = None
) -> DataFrame:
    """Up to ``per_year`` first keys of each asked year; cut first, suffix filter second.

    The rank limit is applied in every task before the shuffle, so a year with most of the
    keys still sends only ``per_year`` of them per task.
    """
    keys = keys_in_years(listing, list(years or V.SAMPLE_YEARS))
    first = Window.partitionBy("position").orderBy("key")
    cut = keys.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_year)
    return pdf_keys(cut).select("key", "year", "rank")
