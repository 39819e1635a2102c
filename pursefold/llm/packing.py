"""Packing documents into training sequences by cutting-stock column generation.

Each document's ids are cut at multiples of the sequence length; full pieces are sequences of their own, what remains is to be
packed. Lengths go into a histogram of `STEP`-wide classes, at most `SEQUENCE / STEP` numbers however many documents there are.
On it the driver solves the linear program of cutting stock: the fewest sequences whose patterns (how many pieces of each class)
cover all pieces. Columns are generated: a knapsack dynamic program over the class widths finds the pattern worth most under
the program's prices, until none is worth more than a sequence. Patterns are used a whole number of times, rounded down; what
is then left of the histogram, less than one pattern for each class, goes first-fit by falling width.

Assigning is Spark's: pieces are sorted by class, numbered within it by adding up counts of range partitions, and the n-th piece of
a class takes the n-th place for it in the patterns. No key gathers rows, so equal lengths are no hot spot.

Null and empty texts are one end id. Repeated rows are packed as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pursefold.llm.common import written
from pursefold.llm.tokens import encoder

SEQUENCE, STEP, END_ID = 2048, 8, 1
BATCH = 128
NEAR = 0.001


def pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, sequence: int = SEQUENCE, id: str = "doc_id", text: str = "text", spaces: bool = True) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (little-endian unsigned 32-bit numbers), at most `sequence` ids in each."""
    kind = docs.schema[id].dataType
    end = int(end_id).to_bytes(4, "little")
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens")), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, spaces)
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.slice(at, BATCH)
                rows = []
                for k, ids in enumerate(own.ids([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    n = len(ids) // 4
                    rows += [(k, s, min(sequence, n - s), n, ids[4 * s : 4 * (s + sequence)]) for s in range(0, n, sequence)]
                k, *columns = zip(*rows)
                arrays = [part.column(0).take(pa.array(k)), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.select(id, text).mapInArrow(run, schema)


def best_pattern(prices: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The knapsack of most worth: how many of each width, any number of each."""
    worth = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = int(np.searchsorted(widths, room, side="right"))
        worth[room] = worth[room - 1]
        if fits:
            values = worth[room - widths[:fits]] + prices[:fits]
            k = int(values.argmax())
            if values[k] > worth[room] + 1e-12:
                worth[room], last[room] = values[k], k
    pattern, room = np.zeros(len(widths), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[last[room]] += 1
            room -= int(widths[last[room]])
    return float(worth[capacity]), pattern


def patterns(demand: dict[int, int], capacity: int, rounds: int = 8_000) -> list[tuple[dict[int, int], int]]:
    """Patterns (width: how many) and how often to use each, together room for every piece; widths are whole numbers up to capacity."""
    widths = np.array(sorted(demand), np.int64)
    if not len(widths):
        return []
    # A little more of each, never the same, so that no two exchanges tie and the program cannot go round in circles.
    need = np.array([demand[w] for w in widths.tolist()], float) + 1e-3 * np.sqrt(1 + np.arange(len(widths)))
    columns = np.diag(capacity // widths)
    inverse = np.diag(1.0 / (capacity // widths))
    bound = 0.0
    for k in range(rounds):
        worth, pattern = best_pattern(inverse.sum(axis=0), widths, capacity)
        # Sums instead of matrix products: a BLAS library's threads would fight Spark's for the cores.
        change, amounts = (inverse * pattern).sum(axis=1), np.maximum((inverse * need).sum(axis=1), 0)
        bound = max(bound, amounts.sum() / worth)  # no plan is shorter
        if amounts.sum() <= bound * (1 + NEAR):
            break
        ratio = np.where(change > 1e-9, amounts / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = pattern
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
        if k % 250 == 249:  # rounding errors add up: one step of Newton's method takes them back
            wrong = 2 * np.eye(len(widths)) - np.einsum("ij,jk->ik", columns.astype(float), inverse)
            inverse = np.einsum("ij,jk->ik", inverse, wrong)
    used = np.floor(np.maximum((inverse * need).sum(axis=1), 0)).astype(np.int64)
    plan = [({int(w): int(n) for w, n in zip(widths, columns[:, k]) if n}, int(used[k])) for k in range(len(widths)) if used[k]]
    left = Counter(demand)
    for pattern, times in plan:
        left.subtract({w: n * times for w, n in pattern.items()})
    open_room: list[list] = []
    for width in sorted(left, reverse=True):
        for _ in range(left[width]):
            fitting = next((b for b in open_room if b[0] >= width), None)
            if fitting is None:
                open_room.append(fitting := [capacity, Counter()])
            fitting[0] -= width
            fitting[1][width] += 1
    return plan + [(dict(b[1]), 1) for b in open_room]


def places(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(class, from rank, to rank, pieces a sequence, first sequence, place in the sequence) of each pattern's share of a class."""
    rows, taken, sequence = [], Counter(), 0
    for pattern, times in plan:
        for order, (width, n) in enumerate(sorted(pattern.items(), reverse=True)):
            rows.append((width, taken[width], taken[width] + n * times, n, sequence, order))
            taken[width] += n * times
        sequence += times
    return rows


def _numbered(names: list[str]):
    """Adds the partition and the row's number within its class there; rows of a class follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not len(batch):
                continue
            kinds = batch.column("__class").to_numpy()
            starts = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
            number = np.arange(len(kinds)) - np.repeat(starts, np.diff(np.r_[starts, len(kinds)]))
            if kinds[0] == last:
                number[: starts[1] if len(starts) > 1 else len(kinds)] += done
            last, done = kinds[-1], int(number[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(kinds), part, np.int32)), pa.array(number)], [*names, "__part", "__number"])

    return run


def packed(rows: DataFrame, sequence: int = SEQUENCE, step: int = STEP) -> DataFrame:
    """rows (doc_id, start, length and any others: ids, digests) with sequence_id and offset."""
    spark = rows.sparkSession
    classed = rows.withColumn("__class", F.ceil(F.col("length") / step).cast("int"))
    order = ("__class", *(c for c in ("doc_id", "start") if c in rows.columns))
    schema = T.StructType([*classed.schema, T.StructField("__part", T.IntegerType()), T.StructField("__number", T.LongType())])
    sorted_rows = classed.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = written(sorted_rows.mapInArrow(_numbered(classed.columns), schema), "packing")
    counts = numbered.groupBy("__class", "__part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(F.col("__class").alias("c"), F.col("__part").alias("p"), "base")
    demand = {r[0]: r[1] for r in counts.groupBy("__class").agg(F.sum("n")).collect()}  # at most sequence / step rows
    table = spark.createDataFrame(places(patterns(demand, -(-sequence // step))), "k int, low long, high long, n long, first long, slot int")
    # Both are small whatever the rows: one row for each class and partition, a few hundred rows for each class.
    ranked = numbered.join(bases, F.expr("__class = c and __part = p")).withColumn("__rank", F.expr("base + __number"))
    placed = ranked.join(F.broadcast(table), F.expr("__class = k and __rank >= low and __rank < high"))
    placed = placed.withColumn("sequence_id", F.expr("first + (__rank - low) div n"))
    before = Window.partitionBy("sequence_id").orderBy("slot", "__rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(*rows.columns, "sequence_id", "offset")


def layout(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Where each piece goes, with a digest of its ids in place of them."""
    cut = pieces(docs, tokenizer, **options).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(written(cut, "pieces")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def sequences(rows: DataFrame) -> DataFrame:
    """sequence_id and its ids, of rows that `packed` returned with ids; a sequence is short, so its pieces fit one group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return rows.groupBy("sequence_id").agg(joined.alias("ids"))
