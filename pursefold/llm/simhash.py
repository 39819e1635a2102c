"""SimHash near-duplicates: fingerprints linked at a few differing bits, found in BK-trees over shards.

Fingerprints at most r bits apart agree on one of r + 1 bit ranges whole, on two of r + 2 and so on; each distinct fingerprint
goes to one shard for each choice of ranges, and every link lies inside a shard. As many ranges are taken as keep the usual shard
no larger than a tree (four up to 67 million fingerprints, five up to 34 billion), so the copies of a fingerprint do not grow with
their number. A shard's fingerprints form a BK-tree: children hang at their Hamming distance
to the parent, and a search for radius r follows only edges between distance - r and distance + r. A shard larger than
`tree_size` is cut by hash into trees of about that size; each of its fingerprints is sent to each of its trees (one tree: once),
so a task holds a bounded tree and loses no link. A block of one tree hands out at most one link for each fingerprint, a
spanning forest of what it found; components of those links are the classes.

Null and empty texts have fingerprint zero. Repeated rows each get a row. A null doc_id never names a class that has another
one. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pursefold.llm.common import byte_texts, shielded, text_hash, written
from pursefold.llm.components import components

SHINGLE, RADIUS, TREE_SIZE = 3, 3, 1024
SEED, CHUNK = 42, 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, bit i set if it is in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths)[:n].tolist(), ends[len(words) - n :].tolist()
    hash_of = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, hashed: bool = False) -> DataFrame:
    """(doc_id, fp): fp as a signed long; with `hashed` also `hash`, the text's hash."""
    kind = docs.schema[id].dataType.simpleString()
    names = ["doc_id", "fp"] + ["hash"] * hashed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in byte_texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], names)

    columns = [F.col(id), F.col(text)] + [text_hash(text)] * hashed
    return docs.select(*columns).mapInArrow(run, f"doc_id {kind}, fp long" + ", hash long" * hashed)


class Tree:
    """A BK-tree over 64-bit numbers."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at, new = 0, len(self.values)
        self.values.append(value)
        self.children.append({})
        while new:
            distance = (value ^ self.values[at]).bit_count()
            following = self.children[at].setdefault(distance, new)
            if following == new:
                break
            at = following

    def near(self, value: int, radius: int) -> Iterator[int]:
        """The places of values within the radius."""
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (value ^ self.values[at]).bit_count()
            if distance <= radius:
                yield at
            for edge, child in self.children[at].items():
                if -radius <= edge - distance <= radius:
                    todo.append(child)


class Block:
    """One tree and what is looked up in it; keeps a spanning forest of the links."""

    def __init__(self) -> None:
        self.tree, self.parent = Tree(), {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def look_up(self, value: int, radius: int, links: list[tuple[int, int]]) -> None:
        for at in self.tree.near(value, radius):
            other = self.tree.values[at]
            a, b = self.root(value), self.root(other)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                links.append((value, other))


def _link(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, at, block = (1 << 64) - 1, None, Block()
        for batch in batches:
            links: list[tuple[int, int]] = []
            *keys, sides, fps = (c.to_pylist() for c in batch.columns)
            for key, side, fp in zip(zip(*keys), sides, fps):
                if key != at:
                    at, block = key, Block()
                value = fp & mask
                block.look_up(value, radius, links)
                if side == 0:
                    block.tree.add(value)
            found = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return run


def shards(radius: int, ranges: int) -> list[int]:
    """Masks of the bits that a shard's fingerprints share: every choice of ranges that may be equal."""
    ends = [64 * k // ranges for k in range(ranges + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:])]
    return [sum(chosen) for chosen in combinations(masks, ranges - radius)]


def ranges_for(many: int, radius: int, tree_size: int) -> int:
    """The least number of ranges with which shards of so many fingerprints are no larger than a tree, as far as choices stay few."""
    ranges = radius + 1
    while ranges < radius + 3 and many > tree_size << 64 * (ranges - radius) // ranges:
        ranges += 1
    return ranges


def links(values: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE, ranges: int | None = None) -> DataFrame:
    """(a, b): links between distinct numbers `fp` whose components are those of all pairs within the radius."""
    ranges = ranges or ranges_for(values.count(), radius, tree_size)
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    cut = [F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("bits")) for k, mask in enumerate(shards(radius, ranges))]
    placed = values.select("fp", F.inline(F.array(*cut)))
    large = placed.groupBy("part", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > tree_size)
    large = large.select(F.col("part").alias("p"), F.col("bits").alias("s"), F.ceil(F.col("n") / tree_size).cast("int").alias("trees"))
    placed = placed.join(large, F.struct("part", "bits") == F.struct("p", "s"), "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other")
    blocks = placed.select("part", "bits", "own", other, "fp").select(
        "part", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "fp"
    )
    order = ("part", "bits", "i", "j", "side", "fp")
    return blocks.repartition("part", "bits", "i", "j").sortWithinPartitions(*order).mapInArrow(_link(radius), "a long, b long")


def _first(prints: DataFrame, least: Column, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of each distinct fingerprint, and (r, first): the least value of each root's rows."""
    smallest = written(prints.groupBy("fp").agg(F.min(least).alias("least")), "simhash-values")
    roots = components(links(smallest.select("fp"), radius))
    rooted = smallest.join(roots, F.expr("fp = node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    return rooted, rooted.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("first"))


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row for each row of docs."""
    prints = written(fingerprints(docs, id, text, shingle), "simhash")
    rooted, first = _first(prints, F.col("doc_id"), radius)
    # By a struct, as in `components`: the rows of a large class are split.
    named = rooted.join(first, F.struct("root") == F.struct("r")).select(F.col("fp").alias("f"), F.col("first").alias("component_id"))
    return prints.join(named, F.expr("fp = f"), "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Of each class the row with the smallest doc_id; of rows that share it the one whose text has the smallest hash.

    A class is its component, whatever its rows are named: classes that share a doc_id, or have null ids only, keep a row each.
    """
    return shielded(docs, lambda d: _representatives(d, shingle, radius))


def _representatives(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    prints = written(fingerprints(docs, shingle=shingle, hashed=True), "simhash")
    texts = prints.groupBy("fp", "doc_id", "hash").agg((F.count("*") > 1).alias("many"))
    _, first = _first(texts, F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "hash", "many"), radius)
    kept = written(first.select(F.col("first.doc_id").alias("__id"), F.col("first.hash").alias("__least"), F.col("first.many").alias("__many")), "simhash-kept")
    rows = docs.withColumn("__hash", text_hash()).join(kept, F.expr("doc_id <=> __id and __hash = __least"))
    # Only rows of one id and text are left to tell apart; they are thinned out in each task before they are shuffled.
    once, again = rows.filter("not __many"), rows.filter("__many").dropDuplicates(["doc_id", "__hash"])
    return once.union(again).select(*docs.columns)
