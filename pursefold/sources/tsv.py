"""Tab-separated source files with a header row: ``<root>/<entity>/<YYYY-MM-DD>``."""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pursefold.functions.parsing import PARSERS
from pursefold.schemas import CAMPAIGNS, MALFORMED, Entity
from pursefold.sources.paths import exists, listed

DAY_IN_PATH = r"/(\d{4}-\d{2}-\d{2})(?:/|$)"


def read_raw(spark: SparkSession, path: str | list[str], entity: Entity, malformed: bool = False) -> DataFrame:
    """All columns as text. A file whose header differs from the entity's fails the read.

    Short rows are filled with NULL and surplus cells cut off; with ``malformed`` a further
    column holds the lines of such rows.
    """
    schema = entity.raw_schema.add(MALFORMED, "string") if malformed else entity.raw_schema
    # Spark only counts the cells of rows that it parses whole.
    reader = spark.read.schema(schema).option("columnPruning", not malformed)
    return reader.csv(
        path, sep="\t", header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED
    )


def typed(raw: DataFrame, entity: Entity, *more: str) -> DataFrame:
    """Typed columns under our names, and ``more`` as they are; unreadable cells become NULL."""
    columns = [PARSERS[f.kind](F.col(f.header)).alias(f.name) for f in entity.fields]
    return raw.select(*columns, *more)


def day_of_file() -> Column:
    """The day named by a folder on the way to the file that a row comes from."""
    return F.regexp_extract("_metadata.file_path", DAY_IN_PATH, 1).try_cast("date")


def day_path(root: str, entity: Entity, store_date: dt.date | str) -> str:
    return f"{root}/{entity.folder}/{store_date}"


def read_entity(
    spark: SparkSession, root: str, entity: Entity, store_date: dt.date | str
) -> DataFrame:
    return typed(read_raw(spark, day_path(root, entity, store_date), entity), entity)


def read_campaigns(spark: SparkSession, path: str) -> DataFrame:
    """Campaign settings, undated."""
    return typed(read_raw(spark, path, CAMPAIGNS), CAMPAIGNS)


def has_rows(spark: SparkSession, root: str, entity: Entity, store_date: dt.date | str) -> bool:
    """Whether the day's path exists and holds at least one row."""
    path = day_path(root, entity, store_date)
    return exists(spark, path) and not read_raw(spark, path, entity).isEmpty()


def folders(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """(folder, store_date, n_files, bytes, read): every folder below an entity's one, from the listing alone.

    Files directly in a folder named like a day, and plain files so named, are that day's; what
    lies elsewhere, deeper ones as well, is not read and has no day.
    """
    files = listed(spark, f"{root}/{folder}")
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    files = files.withColumn("folder", F.when(parent == "", F.col("path")).otherwise(parent))
    counted = files.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"))
    day = F.when(F.col("folder").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("folder").try_cast("date"))
    return counted.select("folder", day.alias("store_date"), "n_files", "bytes", day.isNotNull().alias("read"))


def days_in(spark: SparkSession, root: str, folder: str) -> tuple[list[str], DataFrame]:
    """The days that an entity's folder holds, and all its ``folders``. Warns of those passed over."""
    found = spark.createDataFrame(folders(spark, root, folder).collect(), "folder string, store_date date, n_files bigint, bytes bigint, read boolean")
    rows = found.collect()
    over = sorted(r.folder for r in rows if not r.read)
    if over:
        warnings.warn(f"{root}/{folder}: {len(over)} folders that name no day are passed over: {', '.join(over[:10])}", stacklevel=3)
    return sorted(r.folder for r in rows if r.read), found


def read_raw_days(
    spark: SparkSession, root: str, entity: Entity, days: list[dt.date | str] | None = None, malformed: bool = False
) -> DataFrame:
    """Text of several days in one scan, with ``store_date`` from the path.

    By default all folders named like a day (see ``folders``).
    """
    if days is None:
        days, _ = days_in(spark, root, entity.folder)
    paths = [day_path(root, entity, day) for day in days] or f"{root}/{entity.folder}"
    return read_raw(spark, paths, entity, malformed).withColumn("store_date", day_of_file())


def read_days(
    spark: SparkSession, root: str, entity: Entity, days: list[dt.date | str] | None = None
) -> DataFrame:
    return typed(read_raw_days(spark, root, entity, days), entity, "store_date")
