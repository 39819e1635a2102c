"""Row filters applied when data enters the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pursefold.functions.parsing import to_second
from pursefold.schemas import SUCCESS_STATUS


def clean_transactions(txn: DataFrame) -> DataFrame:
    """Successful transactions with times cut to the second."""
    successful = txn.filter(F.col("trans_status") == SUCCESS_STATUS)
    return successful.withColumn("txn_time", to_second(F.col("txn_time")))
