"""Parquet lake: ``<root>/<entity>`` partitioned by ``store_date``."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pursefold.functions.parsing import KIND_TYPES, PARSERS
from pursefold.functions.rules import as_date
from pursefold.operators.cleaning import clean_transactions
from pursefold.schemas import MALFORMED, TRANSACTIONS, Entity
from pursefold.sources.paths import exists
from pursefold.sources.tsv import day_of_file, days_in, read_raw_days, typed


def lake_path(root: str, entity: Entity) -> str:
    return f"{root}/{entity.folder}"


def write_days(df: DataFrame, path: str) -> None:
    """Replace the days ``df`` holds and leave the others; writing a day twice is safe."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("store_date")
        .parquet(path)
    )


def _write_day(df: DataFrame, root: str, entity: Entity, store_date: dt.date | str) -> None:
    write_days(df.withColumn("store_date", as_date(store_date)), lake_path(root, entity))


def write_raw_day(raw: DataFrame, root: str, entity: Entity, store_date: dt.date | str) -> None:
    """Store the day's rows as they came, every cell as its text."""
    _write_day(raw.select(*entity.raw_schema.names), root, entity, store_date)


def write_clean_day(df: DataFrame, root: str, store_date: dt.date | str) -> None:
    """Store the day's successful transactions, times cut to the second."""
    _write_day(clean_transactions(df), root, TRANSACTIONS, store_date)


def _stored(spark: SparkSession, entity: Entity) -> T.StructType:
    """Columns of a lake file: typed for transactions, which are cleaned, else text."""
    if entity is not TRANSACTIONS:
        return entity.raw_schema
    return typed(spark.createDataFrame([], entity.raw_schema), entity).schema


def _parsed(rows: DataFrame, entity: Entity, *more: str) -> DataFrame:
    return rows if entity is TRANSACTIONS else typed(rows, entity, *more)


def read_lake(spark: SparkSession, root: str, entity: Entity) -> DataFrame:
    """All days, typed, with their ``store_date``."""
    schema = T.StructType([*_stored(spark, entity), T.StructField("store_date", T.DateType())])
    return _parsed(spark.read.schema(schema).parquet(lake_path(root, entity)), entity, "store_date")


def read_lake_day(
    spark: SparkSession, root: str, entity: Entity, store_date: dt.date | str
) -> DataFrame:
    """One day, typed, without listing another; empty where the lake hasn't got it."""
    schema = _stored(spark, entity)
    path = f"{lake_path(root, entity)}/store_date={store_date}"
    if not exists(spark, path):
        return _parsed(spark.createDataFrame([], schema), entity)
    return _parsed(spark.read.schema(schema).parquet(path), entity)


def _as_kind(column: Column, kind: str, stored: T.DataType) -> Column:
    """A lake column of any type as the field's kind; what cannot be read becomes NULL."""
    if isinstance(stored, T.StringType):
        return PARSERS[kind](column)
    if isinstance(stored, (T.TimestampType, T.TimestampNTZType)):
        column = column.cast("timestamp")
        if kind == "epoch":
            return F.unix_seconds(column)
    elif kind == "time" and isinstance(stored, T.IntegralType):
        return F.timestamp_seconds(column)
    return column.try_cast(KIND_TYPES[kind])


def read_foreign_lake(
    spark: SparkSession, root: str, entity: Entity, folder: str | None = None
) -> DataFrame:
    """A lake laid out ``<root>/<folder>/<YYYY-MM-DD>/*.parquet``: all days, typed, with their ``store_date``.

    ``folder`` is the entity's own if not given. Columns go by the file headers, whatever their
    case; one that a day has not got is NULL. Each day's files say how its columns are stored, as text or
    typed, and days may differ. Folders that name no day are warned of; ``tsv.folders`` lists them.
    """
    folder = folder or entity.folder
    days, _ = days_in(spark, root, folder)
    alike = defaultdict(list)
    for day in days:
        path = f"{root}/{folder}/{day}"
        alike[spark.read.parquet(path).schema.json()].append(path)
    if not alike:
        raise FileNotFoundError(f"{root}/{folder}: no day")
    return reduce(DataFrame.unionByName, [_of_one_schema(spark, paths, entity) for paths in alike.values()])


def _of_one_schema(spark: SparkSession, paths: list[str], entity: Entity) -> DataFrame:
    rows = spark.read.parquet(*paths)
    stored = {f.name.lower(): f for f in rows.schema}
    columns = []
    for f in entity.fields:
        found = stored.get(f.header.lower())
        column = _as_kind(rows[f"`{found.name}`"], f.kind, found.dataType) if found else F.lit(None).cast(KIND_TYPES[f.kind])
        columns.append(column.alias(f.name))
    return rows.select(*columns, day_of_file().alias("store_date"))


def malformed_path(root: str, entity: Entity) -> str:
    return f"{root}/malformed/{entity.folder}"


def write_malformed(raw: DataFrame, root: str, entity: Entity) -> None:
    """Keep the lines of ``raw``'s rows with surplus or missing cells, beside what was read of them,
    by their ``store_date``."""
    lines = raw.filter(F.col(MALFORMED).isNotNull()).withColumnRenamed(MALFORMED, "line")
    write_days(lines, malformed_path(root, entity))


def read_malformed(spark: SparkSession, root: str, entity: Entity) -> DataFrame:
    """(line, store_date) of all rows that came with surplus or missing cells."""
    path, schema = malformed_path(root, entity), "line string, store_date date"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def backfill(
    spark: SparkSession,
    source_root: str,
    lake_root: str,
    entity: Entity,
    days: list[dt.date | str] | None = None,
) -> DataFrame:
    """Load many source days into the lake: one scan, one partitioned write, no shuffle.

    Returns the entity's ``tsv.folders``, with those passed over. Lines with surplus or missing
    cells are kept beside the lake (``read_malformed``).
    """
    named, found = days_in(spark, source_root, entity.folder)
    bad = Observation()
    raw = read_raw_days(spark, source_root, entity, named if days is None else days, malformed=True)
    rows = raw.observe(bad, F.count(MALFORMED).alias("n"))
    if entity is TRANSACTIONS:
        rows = clean_transactions(typed(rows, entity, "store_date"))
    write_days(rows.drop(MALFORMED), lake_path(lake_root, entity))
    if bad.get["n"]:
        write_malformed(raw, lake_root, entity)
    return found
