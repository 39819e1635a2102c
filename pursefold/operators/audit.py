"""Row counts, key checks and arrival reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pursefold.functions.parsing import PARSERS
from pursefold.functions.rules import as_date
from pursefold.operators.keyed import any_null
from pursefold.schemas import MALFORMED, Entity


def stage_counts(**stages: DataFrame) -> DataFrame:
    """(stage, n), one row per named frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def stage_counts_of(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """(stage, n): rows of ``df`` meeting each stage's condition, in one pass."""
    counts = df.agg(*[F.count_if(met).alias(name) for name, met in stages.items()])
    pairs = [F.struct(F.lit(name).alias("stage"), F.col(name).alias("n")) for name in stages]
    return counts.select(F.inline(F.array(*pairs)))


def key_faults(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys occurring more than once, and rows with a NULL in the key."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(~any_null(keys) & (F.col("n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def slot_faults(df: DataFrame, keys: Sequence[str], slot: str) -> DataFrame:
    """Per value of ``slot``, a function of the key, what ``key_faults`` gives for the whole.

    A frame that is dealt out by its key is not shuffled, only the counts of the slots are.
    """
    sizes = df.groupBy(*keys, slot).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(slot).agg(
        F.sum("n").alias("n_rows"),
        F.count_if(~any_null(keys) & (F.col("n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def refuse_repeated(faults: Row, keys: Sequence[str], name: str) -> None:
    """Raise if a key occurs more than once; rows without a key are the caller's."""
    if faults.repeated_keys:
        raise ValueError(f"{name}: {faults.repeated_keys} repeated keys on ({', '.join(keys)})")


def refuse_faults(faults: Sequence[Row], keys: Sequence[str], name: str) -> None:
    """Raise if any of the fault counts is not zero."""
    repeated, missing = sum(f.repeated_keys for f in faults), sum(f.null_key_rows for f in faults)
    if repeated or missing:
        raise ValueError(
            f"{name}: {repeated} repeated keys and {missing} rows without a key on ({', '.join(keys)})"
        )


def require_key(df: DataFrame, keys: Sequence[str], name: str) -> int:
    """Row count of ``df``; raises unless ``keys`` is a primary key of it."""
    faults = key_faults(df, keys).first()
    refuse_faults([faults], keys, name)
    return faults.n_rows


def loss_metrics(entity: Entity) -> list[Column]:
    """Per field, an aggregate counting cells whose text cannot be read as their type."""
    return [
        F.count_if(F.col(f.header).isNotNull() & PARSERS[f.kind](F.col(f.header)).isNull()).alias(
            f.name
        )
        for f in entity.fields
        if f.kind != "text"
    ]


def cell_metrics(entity: Entity) -> list[Column]:
    """Aggregates counting rows with surplus and with missing cells, by their whole lines."""
    line = F.col(MALFORMED)
    cells = F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), "\t"))
    surplus = line.isNotNull() & (cells > len(entity.fields))
    return [
        F.count_if(surplus).alias("surplus_cells"),
        F.count_if(line.isNotNull() & ~surplus).alias("missing_cells"),
    ]


def parse_losses(raw: DataFrame, entity: Entity) -> DataFrame:
    """(field, lost): cells with unreadable text, per field; if ``raw`` has whole lines of
    malformed rows, also the rows with ``surplus_cells`` and with ``missing_cells``.
    """
    lost = raw.agg(*loss_metrics(entity), *(cell_metrics(entity) if MALFORMED in raw.columns else []))
    pairs = [F.struct(F.lit(name).alias("field"), F.col(name).alias("lost")) for name in lost.columns]
    return lost.select(F.inline(F.array(*pairs)))


def arrivals_listed(
    spark: SparkSession, folders: dict[str, DataFrame], start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """(entity, store_date, present, n_files, bytes) from listings (``tsv.folders``): no file is opened.

    A day is present when it has a file with a byte in it.
    """
    sized = {name: found.filter("bytes > 0") for name, found in folders.items()}
    days = arrivals(spark, sized, start, end)
    sizes = [
        df.select(F.lit(name).alias("entity"), "store_date", "n_files", "bytes") for name, df in sized.items()
    ]
    sizes = reduce(DataFrame.unionByName, sizes)
    return days.join(sizes, ["entity", "store_date"], "left").fillna(0, ["n_files", "bytes"])


def arrivals(
    spark: SparkSession,
    observed: dict[str, DataFrame],
    start: dt.date | str,
    end: dt.date | str,
) -> DataFrame:
    """(entity, store_date, present) for every entity and day from start to end.

    ``observed`` gives, per entity, a frame with a ``store_date`` column; a day
    is present when it has at least one row.
    """
    first, last = as_date(start), as_date(end)
    days = F.explode(F.sequence(first, last)).alias("store_date")
    names = spark.createDataFrame([(name,) for name in observed], "entity string")
    expected = names.select("entity", days)
    seen = [
        df.filter(F.col("store_date").between(first, last))
        .select(F.lit(name).alias("entity"), "store_date")
        .distinct()
        for name, df in observed.items()
    ]
    seen = reduce(DataFrame.unionByName, seen).withColumn("seen", F.lit(1))
    return expected.join(seen, ["entity", "store_date"], "left").select(
        "entity", "store_date", F.coalesce("seen", F.lit(0)).alias("present")
    )
