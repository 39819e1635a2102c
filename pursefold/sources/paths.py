"""Questions to the file system a path lives on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds anything there; no file is opened."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes) of all files below a folder, from the file system's listing; none is opened.

    ``path`` is relative to the folder. A folder that does not exist has no files.
    """
    if not exists(spark, root):
        return spark.createDataFrame([], "path string, bytes bigint")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = hadoop_path(spark, root)
    base = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toUri().getPath().rstrip("/")
    # Only what follows the folder's own path counts, whatever the store puts before it.
    relative = F.expr(f"substring(path, locate({_quoted(base + '/')}, path) + {len(base) + 1})")
    return files.select(relative.alias("path"), F.col("length").alias("bytes"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in a folder."""
    folder = hadoop_path(spark, path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()] if system.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that it holds."""
    folder = hadoop_path(spark, path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Nothing removes it. Where that is unset, only a local session gets a temporary one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="pursefold-")
    return f"{shared}/pursefold-{uuid.uuid4().hex}"
