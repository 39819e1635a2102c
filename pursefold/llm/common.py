"""What several operators share: where intermediate tables go, row keys, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as most operators take them: runs without ASCII white space. `bytes.split()` finds the same ones.
WORD_GAP = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which driver and executors share; in local mode one is made if it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    found = tempfile.mkdtemp(prefix="pursefold-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, its lineage cut, safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_hash(text: str = "text") -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.col(text))


def as_binary(column: pa.Array) -> pa.Array:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary())


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The texts one after another as bytes; null is empty."""
    for value in as_binary(column):
        yield value.as_py() or b""


def first_by_hash(rows: DataFrame, id: str, many: int) -> DataFrame:
    """At most so many rows, chosen by a hash of their id: a sample that no order or partitioning changes.

    Rows are first cut at the hash below which about that many lie (a tenth more), so that tasks do not each hand in `many`.
    """
    total = rows.count()
    place = F.pmod(F.xxhash64(id), F.lit(1 << 40))
    cut = rows.filter(place < int((1 << 40) * min(1.0, many * 1.1 / max(total, 1))))
    return cut.orderBy(place, id).limit(many)


def shielded(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The operator's result where columns of docs may have the names that it uses itself, which start with two underscores."""
    names = {c: f"own{k}{c.lstrip('_')}" for k, c in enumerate(docs.columns) if c.startswith("__")}
    return operator(docs.withColumnsRenamed(names)).withColumnsRenamed({new: old for old, new in names.items()})
