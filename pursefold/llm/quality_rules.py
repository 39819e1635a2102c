"""Quality rules whose cutoffs follow each language and source.

Counts of every document go into quantile sketches, histograms over integer values kept to three significant digits. They
merge by adding, so Spark builds them with map-side partial sums, and those of one source merge into those of its language
and of everything. A metric's fence is a tail quantile of the group's own sketch and a small tolerance, so that values next to
it pass. Of symbols the tail may hold a seventh of a group, as junk comes in such shares; of the others one document in 200.
A group of fewer than `least` documents, whose tail would hold none, takes the fences of its language, then the overall ones.

Null text has no words; documents under the base rules are rejected before and stay out of the sketches. Null languages and
sources are groups of their own. Repeated rows count as often as they occur and get the same verdict; an empty table gives
none. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pursefold.llm import textstats
from pursefold.llm.common import byte_texts, shielded, written

STATS = "__stats"
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
#: Metric: numerator, denominator, scale, per mille of the group inside the fence, tolerance, whether too low counts as well.
METRICS = {
    "symbols": ("n_symbols", "n_words", 1000, 850, 10, False),
    "upper": ("n_upper", "word_chars", 1000, 995, 5, False),
    "repeats": ("n_repeat_words", "n_words", 1000, 995, 20, False),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 995, 20, False),
    "word_length": ("word_chars", "n_words", 100, 995, 10, True),
}
LEAST = 200
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def with_stats(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """docs and a struct `__stats` of counts over the whole text; without the text column if that is not kept."""
    fields = T.StructType([T.StructField(f, T.LongType()) for f in FIELDS])
    names = [c for c in docs.columns if keep_text or c != text]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(STATS, fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [textstats.counts(t) for t in byte_texts(batch.column(text))]
            columns = [pa.array(values, pa.int64()) for values in zip(*rows)] or [pa.array([], pa.int64())] * len(FIELDS)
            stats = pa.StructArray.from_arrays(columns, list(FIELDS))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), stats], [*names, STATS])

    return docs.mapInArrow(run, schema)


def base_failed(stats: str = STATS) -> Column:
    n = F.col(f"{stats}.n_words")
    return (n < MIN_WORDS) | (F.col(f"{stats}.n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT)


def metric(name: str, stats: str = STATS) -> Column:
    """Scaled to whole numbers, kept to three significant digits."""
    top, bottom, scale, *_ = METRICS[name]
    value = F.expr(f"case when {stats}.{bottom} > 0 then ({stats}.{top} * {scale}) div {stats}.{bottom} else 0L end")
    unit = F.pow(F.lit(10), F.greatest(F.length(value.cast("string")) - 3, F.lit(0))).cast("long")
    return value - value % unit


def fences(rows: DataFrame, lang: str = "lang", source: str = "source", least: int = LEAST) -> DataFrame:
    """One row for each language and source: `lo_<metric>` and `hi_<metric>`."""
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), metric(m).alias("v")) for m in METRICS)))
    sketch = (
        rows.select(F.col(lang).alias("lang"), F.col(source).alias("source"), base_failed().alias("out"), STATS)
        .filter(~F.col("out")).select("lang", "source", values.alias("m"))
        .groupBy("lang", "source", F.col("m.metric").alias("metric"), F.col("m.v").alias("v")).agg(F.count("*").alias("n"))
    )
    level = F.explode(F.array(
        F.struct(F.lit(2).alias("level"), F.col("lang").alias("l"), F.col("source").alias("s")),
        F.struct(F.lit(1).alias("level"), F.col("lang").alias("l"), F.lit(None).cast("string").alias("s")),
        F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("l"), F.lit(None).cast("string").alias("s")),
    )).alias("at")
    keys = ("level", "l", "s")
    over = Window.partitionBy(*keys, "metric")
    merged = (
        sketch.select(level, "metric", "v", "n").groupBy(*(F.col(f"at.{k}").alias(k) for k in keys), "metric", "v").agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(over.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("all", F.sum("n").over(over))
    )

    def quantile(name: str, mille: int) -> Column:
        return F.min(F.when((F.col("metric") == name) & (F.col("upto") * 1000 >= F.col("all") * mille), F.col("v")))

    columns = []
    for m, (_, _, _, inside, tolerance, two) in METRICS.items():
        columns += [(quantile(m, inside) + tolerance).alias(f"hi_{m}")]
        columns += [(quantile(m, 1000 - inside) - tolerance).alias(f"lo_{m}")] * two
    cut = merged.groupBy(*keys).agg(F.max("all").alias("all"), *columns).filter((F.col("all") >= least) | (F.col("level") == 0))
    cut = cut.select(F.struct(*cut.columns).alias("cut"))
    groups = rows.select(F.col(lang).alias("lang"), F.col(source).alias("source")).distinct().select("lang", "source", level)
    found = groups.join(cut, F.expr("at.level = cut.level and at.l <=> cut.l and at.s <=> cut.s"))
    best = found.groupBy("lang", "source").agg(F.max_by("cut", "at.level").alias("cut"))
    wanted = [f"hi_{m}" for m in METRICS] + [f"lo_{m}" for m, x in METRICS.items() if x[-1]]
    return best.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *(F.col(f"cut.{c}") for c in wanted))


def judged(rows: DataFrame, lang: str = "lang", source: str = "source", least: int = LEAST) -> DataFrame:
    """rows (with `__stats`) and booleans `__base_failed` and `__kept`."""
    # Written, so that Spark knows its size before it deals out the texts, and need not do so where it is small.
    cut = written(fences(rows, lang, source, least), "fences")
    inside = F.lit(True)
    for m, (*_, two) in METRICS.items():
        inside &= metric(m) <= F.col(f"hi_{m}")
        if two:
            inside &= metric(m) >= F.col(f"lo_{m}")
    joined = rows.join(cut, rows[lang].eqNullSafe(cut["__lang"]) & rows[source].eqNullSafe(cut["__source"]), "left")
    kept = ~base_failed() & F.coalesce(inside, F.lit(True))
    return joined.select(*(rows[c] for c in rows.columns), base_failed().alias("__base_failed"), kept.alias("__kept"))


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept, one row for each row of docs."""
    rows = written(with_stats(docs.select("doc_id", "text", "lang", "source"), keep_text=False), "rules")
    return judged(rows).select("doc_id", *(F.col(f"{STATS}.{f}").alias(f) for f in FIELDS), F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    return shielded(docs, lambda d: judged(written(with_stats(d), "rules")).filter("__kept").select(*d.columns))
