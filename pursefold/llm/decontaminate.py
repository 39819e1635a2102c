"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

An item's windows are `window` consecutive words (an item of fewer is one window); each is a set of word shingles. Shingles are
ordered by the number of their places in the documents, rarest first. A window is contained in a document only if all its
shingles are, so a prefix of one shingle, the rarest, is enough to find every candidate. Joined at a place, it fixes where the
window would start: the position must not lie before the text, and the window must end within it. The words there are then
compared one by one with the window's.

Windows are distinct and numbered; which items have them is joined by number after the hits of a document are distinct, so a window
that many items share is looked for once. The windows are sent to all tasks only if their words take at most `SENT_BYTES`; more are
joined by shuffle, documents carrying only shingle hashes, and the candidates are checked against the texts afterwards.

Null and empty texts have no words: such items have no windows, such documents no hits. Equal windows of several items count for
each. An item without an id hits like any other, but is neither counted nor listed, as there is no id to list. Repeated rows (same id and text) get the same result. An empty benchmark hits nothing; an empty table gives no rows.
Only id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pursefold.llm.common import shielded, text_hash, written

WINDOW, SHINGLE = 13, 3
SENT_BYTES = 64 << 20
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_list(text: str) -> Column:
    """Words with only A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), GAP), "")


def windows(items: DataFrame, id: str = "item_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(number, window, length): distinct windows as word lists; and (number, item): the items that have them."""
    lists = items.select(F.col(id).cast("string").alias("item"), word_list(text).alias("words")).filter(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))).alias("at")
    cut = lists.select("item", "words", starts).select("item", F.slice("words", F.col("at") + 1, window).alias("window"))
    distinct = written(cut.select("window").distinct().select(F.monotonically_increasing_id().alias("number"), "window", F.size("window").alias("length")), "windows")
    owners = cut.filter("item is not null").join(distinct, "window").select("number", "item").distinct()
    return distinct, written(owners, "window-items")


def places(docs: DataFrame, size: int, keep: list[str]) -> DataFrame:
    """Every place of a document where a shingle of so many words starts: `at`, its hash `h` and the columns to keep."""
    lists = docs.select("doc_id", "text", word_list("text").alias("words"))
    spread = lists.select("doc_id", "text", "words", F.posexplode("words").alias("at", "word"))
    ends = F.get("words", F.col("at") + size - 1) if size > 1 else F.col("word")
    rest = [F.get("words", F.col("at") + k) for k in range(1, size - 1)] + [ends] * (size > 1)
    return spread.filter(ends.isNotNull()).select(*keep, "at", F.xxhash64("word", *rest).alias("h"))


def prefixes(parts: DataFrame, docs: DataFrame, size: int, sent: bool) -> DataFrame:
    """(w, back, number, window, length): each window's rarest shingle and its distance from the window's start."""
    rows = parts.select("number", "window", "length", F.posexplode("window").alias("back", "word")).filter(F.col("back") <= F.col("length") - size)
    rows = rows.select("*", F.xxhash64(*(F.get("window", F.col("back") + k) for k in range(size))).alias("h"))
    wanted = rows.select(F.col("h").alias("w")).distinct()
    # If joined by shuffle, then by a struct, by which the distinct shingles are not dealt out yet, so that a common one's places can be split.
    same = F.expr("h = w") if sent else F.struct("h") == F.struct("w")
    seen = places(docs, size, []).join(F.broadcast(wanted) if sent else wanted, same, "left_semi")
    found = seen.groupBy("h").agg(F.count("*").alias("n"))
    counted = rows.join(found.withColumnRenamed("h", "f"), F.expr("h = f"), "left")
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "back", "h"))
    return counted.groupBy("number", "window", "length").agg(best.alias("best")).filter("best.n > 0").select(
        F.col("best.h").alias("w"), F.col("best.back").alias("back"), "number", "window", "length"
    )


def hits(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """(doc_id, hash, at, length, number): every occurrence of a window in a document."""
    size_of = parts.agg(F.sum(F.octet_length(F.array_join("window", " "))).alias("bytes"), F.min("length").alias("least")).first()
    sent = (size_of.bytes or 0) <= SENT_BYTES
    found = None
    # Windows of fewer words than a shingle are sets of shingles of their own length.
    for size in range(min(size_of.least or SHINGLE, SHINGLE), SHINGLE + 1):
        own = parts.filter(F.col("length") == size if size < SHINGLE else F.col("length") >= size)
        first = written(prefixes(own, docs, size, sent), "prefixes")
        start = F.col("at") - F.col("back")
        if sent:
            rows = places(docs, size, ["doc_id", "text", "words"]).join(F.broadcast(first), F.expr("h = w"))
        else:
            near = places(docs, size, ["doc_id", text_hash().alias("x")]).join(first, F.expr("h = w")).withColumnRenamed("doc_id", "d")
            near = near.select("d", "x", "at", "back", "window", "length", "number")
            rows = docs.select("doc_id", "text", text_hash().alias("y"), word_list("text").alias("words")).join(near, F.expr("doc_id <=> d and x = y"))
        inside = (start >= 0) & (start + F.col("length") <= F.size("words"))
        rows = rows.filter(inside).filter(F.slice("words", F.when(inside, start + 1).otherwise(F.lit(1)), F.col("length")) == F.col("window"))
        rows = rows.select("doc_id", text_hash().alias("hash"), start.alias("at"), "length", "number")
        found = rows if found is None else found.union(rows)
    return found


def judged(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted strings), contaminated and `__hash` of the text, one row for each row of docs."""
    read = docs.select("doc_id", "text")
    parts, owners = windows(items, window=window)
    found = written(hits(read, parts), "hits")
    spans = found.groupBy("doc_id", "hash").agg(F.array_sort(F.collect_set(F.struct("at", "length"))).alias("spans"))
    listed = found.select("doc_id", "hash", "number").distinct().join(owners, "number").groupBy("doc_id", "hash").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    listed = listed.select(F.col("doc_id").alias("i"), F.col("hash").alias("x"), "item_ids")
    per = spans.join(listed, F.expr("doc_id <=> i and hash = x"), "left")
    # Words under the union of spans: each adds what lies beyond the furthest end so far.
    cover = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, x: F.struct(F.greatest(s["end"], x["at"] + x["length"]).alias("end"), (s["n"] + F.greatest(x["at"] + x["length"] - F.greatest(s["end"], x["at"]), F.lit(0))).alias("n")),
        lambda s: s["n"].cast("long"),
    )
    per = per.select(F.col("doc_id").alias("d"), "hash", cover.alias("n_hit"), "item_ids")
    # Upper case letters are word characters here, so that the text need not be lower-cased only to count.
    n_words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), ""))
    counted = read.select("doc_id", n_words.cast("long").alias("n_words"), text_hash().alias("__hash"))
    joined = counted.join(per, F.expr("doc_id <=> d and __hash = hash"), "left")
    joined = joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "__hash")
    return joined.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    return shielded(docs, lambda d: _clean(d, items))


def _clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    bad = judged(docs, items).filter("contaminated").select(F.col("doc_id").alias("__bad"), "__hash").distinct()
    keyed = docs.withColumn("__own", text_hash())
    return keyed.join(bad, F.expr("doc_id <=> __bad and __own = __hash"), "left_anti").select(*docs.columns)
