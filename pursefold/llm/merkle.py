"""Merkle manifest of a table: proofs for every row, and a persistent version of the tree for every changed row.

A row is a leaf. Each group's leaves stand in the order of their id; while a group has several nodes, every two neighbours
become their hash (a last lone one its own). What remains is the group's subroot; the subroots, in the order of their groups,
make the root in the same way. Nodes are hashed as hexadecimal text and kept as bytes.

Leaves are cut into aligned blocks of 2^HEIGHT, which tasks build independently; the tops of blocks are the nodes of the next
blocks, until every group has one. A tree is never changed: a changed leaf makes a version that copies the leaf's ancestors
inside the block and shares all other nodes with the first version. Above its block a version goes on where its row is: the
nodes beside its way up are those of the first version, so only the few digests of that way are sent to the block's rows.
A block is at most 2^HEIGHT rows, however large a group or however many of its rows are changed.

Null groups come first and are a group of their own; null ids come first in a group. Rows of one id are ordered by their
leaves, and equal leaves have equal results up to their places. An empty table has no leaves and gives no rows. Only the
columns named are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pursefold.llm.common import written

HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: A node: its digest, and the one or two nodes below it.
Node = tuple[bytes, "Node | None", "Node | None"]


def digest(*parts: bytes) -> bytes:
    return sha256("".join(p.hex() for p in parts).encode()).digest()


def above(left: Node, right: Node | None = None) -> Node:
    return digest(left[0], *([right[0]] if right else [])), left, right


def built(leaves: Sequence[bytes], rises: int) -> Node:
    """The top of a tree of so many levels above its leaves."""
    level: list[Node] = [(leaf, None, None) for leaf in leaves]
    for _ in range(rises):
        level = [above(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0]


def replaced(top: Node, rises: int, at: int, leaf: bytes) -> Node:
    """A version with another leaf: the leaf's ancestors are copied, every other node is shared."""
    if not rises:
        return leaf, None, None
    _, left, right = top
    if at >> (rises - 1) & 1:
        return above(left, replaced(right, rises - 1, at, leaf))
    return above(replaced(left, rises - 1, at, leaf), right)


def beside(top: Node, rises: int, at: int) -> list[tuple[bool, bytes | None]]:
    """From the leaf upwards: whether the node's sibling is the left one, and its digest (None: it has none)."""
    found = []
    for level in reversed(range(rises)):
        _, left, right = top
        if at >> level & 1:
            found.append((True, left[0]))
            top = right
        else:
            found.append((False, right and right[0]))
            top = left
    return found[::-1]


def leaf(fields: dict[str, Column]) -> Column:
    """The digest of a row: each field as `-` if null, else its bytes' number, a colon and its text."""
    texts = [c.cast("string") for c in fields.values()]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(docs: DataFrame, changes: dict[str, Column] | None = None, where: Column | None = None, id: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS) -> DataFrame:
    """(id, group, node, changed): changed is the leaf after `changes` to its fields, null where `where` does not hold."""
    own = {f: F.col(f) for f in fields}
    other = F.when(where, leaf({f: (changes or {}).get(f, c) for f, c in own.items()})) if where is not None else F.lit(None).cast("binary")
    return docs.select(F.col(id).alias("id"), F.col(group).alias("group"), leaf(own).alias("node"), other.alias("changed"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """rows with `pos`, their place in their group from 0, and the group's `total`.

    Rows are sorted over all tasks; what is summed over tasks is one count for each group and task.
    """
    # Equal rows must not all go to one task; the tie-breaker is written first, so that a repeated task deals rows alike.
    ties = written(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-rows")
    keys = [F.col(c).asc_nulls_first() for c in ("group", *order, "tie")]
    spread = ties.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    ranked = written(spread.withColumn("at", F.monotonically_increasing_id()), "merkle-order").withColumn("task", F.shiftright("at", 33))
    whole = Window.partitionBy("g")
    counts = ranked.groupBy(F.col("group").alias("g"), F.col("task").alias("t")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(whole.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("n").over(whole))
    joined = ranked.join(counts, F.expr("group <=> g and task = t"))
    return joined.withColumn("pos", F.expr("at - first + before")).drop("g", "t", "task", "at", "first", "before", "n")


_PATH = T.ArrayType(T.StructType([T.StructField("left", T.BooleanType()), T.StructField("hash", T.BinaryType())]))
_ARROW_PATH = pa.list_(pa.struct([("left", pa.bool_()), ("hash", pa.binary())]))


def _in_blocks(rows: DataFrame, height: int) -> DataFrame:
    """rows (group, pos, total, node, changed, ...) with `path` up to the block's top, `top`, and `version`, the top after the change."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        nodes, changed, total = table["node"].to_pylist(), table["changed"].to_pylist(), table["total"][0].as_py()
        rises = min(height, (total - 1).bit_length())
        top = built(nodes, rises)
        paths = [[{"left": side, "hash": node} for side, node in beside(top, rises, k)] for k in range(len(nodes))]
        versions = [replaced(top, rises, k, new)[0] if new is not None else top[0] for k, new in enumerate(changed)]
        done = table.drop_columns(["changed"]).append_column("path", pa.array(paths, _ARROW_PATH))
        return done.append_column("top", pa.array([top[0]] * len(nodes), pa.binary())).append_column("version", pa.array(versions, pa.binary()))

    blocks = rows.withColumn("block", F.shiftright("pos", height))
    kept = [f for f in blocks.schema.fields if f.name != "changed"]
    schema = T.StructType([*kept, T.StructField("path", _PATH), T.StructField("top", T.BinaryType()), T.StructField("version", T.BinaryType())])
    return blocks.groupBy("group", "block").applyInArrow(build, schema)


def climbed(start: Column, path: Column) -> Column:
    """The node that a node becomes on its way up."""
    text = lambda c: F.lower(F.hex(c))

    def step(node: Column, side: Column) -> Column:
        other = F.coalesce(text(side["hash"]), F.lit(""))
        return F.unhex(F.sha2(F.when(side["left"], F.concat(other, text(node))).otherwise(F.concat(text(node), other)), 256))

    return F.aggregate(path, start, step)


def proved(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """rows of `placed` with `path` up to their group's top, `top`, and `version`, the top after the row's change."""
    levels = [written(_in_blocks(rows, height), "merkle-blocks")]
    while levels[-1].filter(F.col("total") > 1 << height).limit(1).count():
        tops = levels[-1].filter((F.col("total") > 1 << height) & (F.col("pos") == F.shiftleft("block", height)))
        nodes = tops.select("group", F.col("block").alias("pos"), F.ceil(F.col("total") / (1 << height)).alias("total"), F.col("top").alias("node"), F.lit(None).cast("binary").alias("changed"))
        levels.append(written(_in_blocks(nodes, height), "merkle-blocks"))
    upper = None
    for level in reversed(levels):
        ended = level.filter((F.col("total") <= 1 << height) & (F.col("pos") == 0)).select(F.col("group").alias("g"), F.lit(0).cast("long").alias("b"), F.array().cast(_PATH).alias("more"), F.col("top").alias("end"))
        if upper is not None:
            more = higher.join(upper, F.expr("group <=> g and block = b")).select("g", F.col("pos").alias("b"), F.concat("path", "more").alias("more"), "end")  # noqa: F821
            ended = ended.union(more)
        upper, higher = written(ended, "merkle-upper"), level
    joined = levels[0].join(upper, F.expr("group <=> g and block = b"))
    new = {"path": F.concat("path", "more"), "top": F.col("end"), "version": climbed(F.col("version"), F.col("more"))}
    return joined.withColumns(new).drop("g", "b", "more", "end", "block")


def manifest(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Of each row of `leaves`: id, group, pos, leaf, path (to the root), subroot, root, and version, the root after its change.

    Without a change the version is what leaf and path lead to in the first version.
    """
    docs = proved(placed(rows, "id", "node"), height)
    docs = docs.select("id", "group", "pos", F.col("node").alias("leaf"), "path", F.col("top").alias("subroot"), F.col("version").alias("own"))
    # One row of each group; its subroot is a leaf of the tree above.
    groups = docs.filter("pos = 0").select(F.lit(0).alias("group"), F.col("group").alias("name"), F.col("subroot").alias("node"), F.lit(None).cast("binary").alias("changed"))
    groups = proved(placed(groups, "name"), height).select("name", F.col("path").alias("more"), F.col("top").alias("root"))
    joined = docs.join(written(groups, "merkle-groups"), F.expr("group <=> name"))
    return joined.select("id", "group", "pos", "leaf", F.concat("path", "more").alias("path"), "subroot", "root", climbed(F.col("own"), F.col("more")).alias("version"))


def proof(path: Column) -> Column:
    """The digest of the siblings on the way to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda side: F.lower(F.hex(side["hash"]))), ""), 256)
