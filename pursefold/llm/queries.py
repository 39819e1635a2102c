"""The registered queries of this subpackage: (spark, folder of tables) to a DataFrame, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pursefold.llm import decontaminate, lines, merkle, packing, pii, quality_rank, quality_rules, secret_scan, simhash, substring, token_file, toxicity, whitening
from pursefold.llm.common import shared_dir
from pursefold.llm.oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

#: Of the registered query; a real one is a secret.
KEY = "a key for tests"


def table(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.classes(table(spark, folder))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.layout(table(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules.verdicts(table(spark, folder)).select(*columns)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder), table(spark, folder, "labels"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.judged(table(spark, folder), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


def op6_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/llm/ids-{uuid.uuid4().hex}"
    token_file.write(table(spark, folder), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2, size=49_408)
    return token_file.read(spark, path, size=49_408).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.pseudonymised(table(spark, folder), KEY)
    return found.select("doc_id", F.col("__n_replaced").cast("long").alias("n_replaced"), F.col("__text").alias("text"))


def op8_substring(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.without_repeats(table(spark, folder))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rank.scored(table(spark, folder), table(spark, folder, "labels"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The source is the host of a document."""
    found = lines.cleaned(table(spark, folder), "source")
    return found.select("doc_id", F.col("__n_lines").cast("long").alias("n_lines"), F.col("__n_removed").cast("long").alias("n_removed"), F.sha2(F.coalesce("__text", F.lit("")), 256).alias("text_sha256"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whitened(table(spark, folder, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    rows = found.select("vec_id", "n", "deviation", "identity_error", each)
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "part.whitened", "part.explained", "identity_error")


def op12_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scanned(table(spark, folder))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Tampering adds 1 to n_chars where 7 divides the id's checksum."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = merkle.leaves(table(spark, folder), {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, tampered)
    text = lambda c: F.lower(F.hex(c))
    return merkle.manifest(leaves).select(
        F.col("id").alias("doc_id"), *(text(c).alias(c) for c in ("leaf", "subroot", "root")), merkle.proof(F.col("path")).alias("proof_sha256"),
        text("version").alias("folded_root"), (F.col("version") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_simhash, op2_packing, op3_quality_rules, op4_toxicity, op5_decontamination, op6_token_file, op7_pii, op8_substring, op9_quality, op10_line_dedup,
    op11_whitening, op12_secrets, op13_merkle,
)}
