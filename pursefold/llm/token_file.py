"""Token ids in files of blocks, each coded by an adaptive context-mixing range coder of its own.

A block holds whole documents, about `BLOCK` ids, and depends on no other: its models start anew and it carries a CRC of what
it decodes to. Inside, the ids lie in up to `LANES` lanes that are coded side by side, a column of ids at a time, with one range
coder each; so numpy does the arithmetic for all lanes at once.

The next id is predicted by three orders. Order 2 and order 1 each name the id that last followed the last two or the last one,
and how often such a pair of guesses, trusted so far, has held in the block gives each its share of the range. The rest goes by order 0,
the ids' frequencies so far in the block. Shares and frequencies are brought up to date after every `REFRESH` columns. Encoder
and decoder take the same steps with whole numbers only (a quotient of numbers below 2^53 is taken in doubles, where it is exact). A file is a table of blocks, written by Spark with its commit
protocol; `payload` has the format below, and files are read block by block.

Payload, little-endian: magic `PFR2`, end id, lanes, columns, ids, CRC-32 of the ids as unsigned 32-bit numbers (5 x u32), then 16-bit words
of all lanes: the first three of each, and after these the others in the order in which the decoder takes them.

Null and empty texts are one end id. Repeated rows are written as often as they occur, ordered by id and then a hash of the text.
A null id comes first. An empty table gives an empty file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pursefold.llm.common import text_hash
from pursefold.llm.tokens import chunks, encoder

MAGIC = b"PFR2"
BLOCK, LANES, REFRESH = 1 << 20, 2048, 16
#: Columns of a block at least; what one column teaches serves the next.
LONG = 512
BITS = 26
WHOLE = 1 << BITS
LEAST = 16  # of WHOLE, for an id not seen yet; it stays one at least as order 0 keeps a sixteenth of the range
GUESSED = WHOLE - WHOLE // 16
TABLE2 = 1 << 18
TOP, BOTTOM = 1 << 48, 1 << 32  # a lane's range lies between; all below 2^53, so floor(a / b) of doubles is exact
HIT2, HIT1, MISS = range(3)
#: What a wrong guess and a right one do to a trust of 0 to 15.
CHANGE = np.array([-(t + 1 >> 1) for t in range(16)] + [1] * 15 + [0], np.int32)


class Model:
    """What both sides know of a block: guesses of order 1 and 2 and how far to trust them, frequencies of order 0.

    Guesses of both orders lie in one table, an id and its trust (1 to 15; 0: nothing known) in one number. How often either was right
    is counted for each pair of trusts, apart where both name one id.
    """

    def __init__(self, ids: int) -> None:
        self.ids = ids
        self.table = np.full(ids + 1 + TABLE2, ids << 4, np.int32)
        trust2, trust1, same = np.arange(512) >> 5, np.arange(512) >> 1 & 15, np.arange(512) & 1
        self.least = np.stack([trust2 > 0, (trust1 > 0) & (same == 0), np.ones(512, bool)], 1).astype(np.int64)
        self.counts = self.least * [1, 1, 2]
        self.seen = np.zeros(ids, np.int64)
        self.refresh()

    def refresh(self) -> None:
        room, total = WHOLE - LEAST * self.ids, int(self.seen.sum())
        upto = np.r_[0, np.cumsum(self.seen)]
        self.upto = upto * room // total + LEAST * np.arange(self.ids + 1) if total else np.arange(self.ids + 1) * WHOLE // self.ids
        self.upto[-1] = WHOLE
        every = self.counts.sum(axis=1)
        old = every > 1 << 16
        self.counts[old] = np.maximum(self.counts[old] >> 1, self.least[old])
        every[old] = self.counts[old].sum(axis=1)
        self.share2 = GUESSED * self.counts[:, HIT2] // every
        self.shares = self.share2 + GUESSED * self.counts[:, HIT1] // every

    def learn(self, ids: np.ndarray, pairs: np.ndarray, hit: np.ndarray) -> None:
        """Counts ids, and by pair of trusts whether the guess of order 2, of order 1 or none was right."""
        self.seen += np.bincount(ids, minlength=self.ids)
        kinds = np.where(hit[0], HIT2, np.where(hit[1], HIT1, MISS))
        self.counts += np.bincount(pairs * 3 + kinds, minlength=512 * 3).reshape(512, 3)
        self.refresh()


class Lanes:
    """The lanes' ids one column after another, with the two before each."""

    def __init__(self, ids: int, lanes: int) -> None:
        self.model = Model(ids)
        self.one, self.two = np.full(lanes, ids, np.int64), np.full(lanes, ids, np.int64)
        self.step, self.fresh = 0, []

    def guesses(self, n: int):
        """Guessed ids of order 2 and 1, and where their shares of WHOLE end: the first begins at 0, the second where the first ends."""
        model, one, two = self.model, self.one[:n], self.two[:n]
        self.at = np.empty((2, n), np.int64)
        self.at[0] = ((one * 0x9E3779B1 + two * 0x85EBCA6B >> 7) & (TABLE2 - 1)) + (model.ids + 1)
        self.at[1] = one
        self.entries = model.table.take(self.at)
        self.guessed, self.trust = self.entries >> 4, self.entries & 15
        guess2, guess1 = self.guessed
        self.pairs = ((self.trust[0] << 5) + (self.trust[1] << 1) + (guess2 == guess1)).astype(np.int64)
        return guess2, guess1, model.share2.take(self.pairs), model.shares.take(self.pairs)

    def remember(self, ids: np.ndarray) -> None:
        """The column's ids, after its `guesses`."""
        n, trust = len(ids), self.trust
        hit = self.guessed == ids
        kept = self.entries + CHANGE.take((hit << 4) + trust)
        self.model.table[self.at] = np.where(hit | (trust > 2), kept, (ids << 4) + 1)
        self.two[:n], self.one[:n] = self.one[:n], ids
        self.fresh.append((ids, self.pairs, hit))
        self.step += 1
        if self.step % REFRESH == 0 or self.step in (1, 2, 4, 8):
            self.model.learn(*(np.concatenate(x, axis=-1) for x in zip(*self.fresh)))
            self.fresh = []


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // LONG))
    return lanes, -(-n // lanes)


def _widths(n: int, lanes: int, columns: int) -> list[int]:
    """How many lanes have an id in each column: lanes are consecutive runs, the first ones a column longer."""
    return [lanes if column < n // lanes else n % lanes for column in range(columns)]


def _dealt(ids: np.ndarray, lanes: int, columns: int) -> np.ndarray:
    """The ids of each lane in a row, the last place of the shorter ones empty; a copy."""
    n, grid = len(ids), np.zeros((lanes, columns), np.int32)
    long = n % lanes or lanes
    grid[:long] = ids[: long * columns].reshape(long, columns)
    grid[long:, : columns - 1] = ids[long * columns :].reshape(lanes - long, columns - 1)
    return grid


def _gathered(grid: np.ndarray, n: int) -> np.ndarray:
    """The ids that `_dealt` has dealt."""
    long = n % len(grid) or len(grid)
    return np.concatenate([grid[:long].ravel(), grid[long:, :-1].ravel()]).astype("<u4")


def encode(ids: np.ndarray, size: int, end_id: int = 0) -> bytes:
    """A block of ids below size."""
    n = len(ids)
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    lanes, columns = _shape(n)
    dealt, state = np.ascontiguousarray(_dealt(ids, lanes, columns).T), Lanes(size, lanes)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, TOP, np.int64)
    out = np.zeros((lanes, columns * 2 + 3), np.int32)
    flat, begins = out.reshape(-1), np.arange(lanes) * out.shape[1]
    place, order = begins.copy(), []

    for column, width in enumerate(_widths(n, lanes, columns)):
        x = dealt[column, :width]
        guess2, guess1, share2, both = state.guesses(width)
        hit2 = guess2 == x
        begin, end = np.where(hit2, 0, share2), np.where(hit2, share2, both)
        rare = np.flatnonzero(~hit2 & (guess1 != x))
        upto, base, y = state.model.upto, both[rare], x[rare]
        begin[rare] = base + (upto[y] * (WHOLE - base) >> BITS)
        end[rare] = base + (upto[y + 1] * (WHOLE - base) >> BITS)
        unit = span[:width] >> BITS
        low[:width] += begin * unit
        span[:width] = (end - begin) * unit
        at = np.flatnonzero(span < BOTTOM)
        while len(at):
            now, to = low[at], place[at]
            flat[to] = now >> 32
            order.append(to)
            place[at] = to + 1
            low[at] = (now & (BOTTOM - 1)) << 16
            span[at] <<= 16
            at = at[span[at] < BOTTOM]
        state.remember(x)
    for k, word in enumerate((low >> 32, low >> 16 & 0xFFFF, low & 0xFFFF)):
        flat[place + k] = word
    used = out[:, : int((place - begins).max()) + 3]
    while (over := used >> 16).any():  # carries
        used &= 0xFFFF
        used[:, :-1] += over[:, 1:]
    # The decoder starts with three words of each lane and, where the encoder moved out a word, needs the third after it.
    words = np.concatenate([out[:, :3].ravel(), *(flat[to + 3] for to in order)]).astype("<u2")
    return struct.pack("<4s5I", MAGIC, end_id, lanes, columns, n, crc) + words.tobytes()


def _last_at_most(upto: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the last entry lies that is not greater, for each; sorted first, so that neighbours look in the same places."""
    bits = len(wanted).bit_length()
    ranked = np.sort((wanted << bits) + np.arange(len(wanted)))
    found = np.empty(len(wanted), np.int64)
    found[ranked & ((1 << bits) - 1)] = np.searchsorted(upto, ranked >> bits, side="right") - 1
    return found


def decode(payload: bytes, size: int) -> np.ndarray:
    """The ids of a block; raises ValueError if it is damaged."""
    magic, _, lanes, columns, n, crc = struct.unpack_from("<4s5I", payload)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    stream = np.frombuffer(payload[24:], "<u2").astype(np.int64)
    first = stream[: 3 * lanes].reshape(lanes, 3)
    code, span, read = (first[:, 0] << 32) + (first[:, 1] << 16) + first[:, 2], np.full(lanes, TOP, np.int64), 3 * lanes
    dealt, state = np.zeros((columns, lanes), np.int32), Lanes(size, lanes)

    for column, width in enumerate(_widths(n, lanes, columns)):
        guess2, guess1, share2, both = state.guesses(width)
        unit = span[:width] >> BITS
        value = np.minimum((code[:width] / unit).astype(np.int64), WHOLE - 1)
        hit2 = value < share2
        x = np.where(hit2, guess2, guess1)
        begin, end = np.where(hit2, 0, share2), np.where(hit2, share2, both)
        rare = np.flatnonzero(value >= both)
        upto, base = state.model.upto, both[rare]
        rest = WHOLE - base
        wanted = (((value[rare] - base + 1 << BITS) - 1) / rest).astype(np.int64)
        y = np.minimum(_last_at_most(upto, wanted), size - 1)
        x[rare], begin[rare], end[rare] = y, base + (upto[y] * rest >> BITS), base + (upto[y + 1] * rest >> BITS)
        code[:width] -= begin * unit
        span[:width] = (end - begin) * unit
        at = np.flatnonzero(span < BOTTOM)
        while len(at):
            code[at] = (code[at] << 16) + stream[read : read + len(at)]
            read += len(at)
            span[at] <<= 16
            at = at[span[at] < BOTTOM]
        state.remember(x)
        dealt[column, :width] = x
    ids = _gathered(np.ascontiguousarray(dealt.T), n)
    if zlib.crc32(ids) != crc:
        raise ValueError("a block of token ids is damaged")
    return ids


def _block_rows(tokenizer: str, spaces: bool, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, number = encoder(tokenizer, spaces), TaskContext.get().partitionId(), 0
        end = int(end_id).to_bytes(4, "little")
        docs, parts, total = [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            values = ([part], [number], [docs], [[len(p) // 4 for p in parts]], [len(ids)], [encode(ids, size, end_id)])
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], BLOCK_COLUMNS)

        for batch in batches:
            for piece in chunks(batch, 1):
                for id, ids in zip(piece.column(0).to_pylist(), own.ids(piece.column(1))):
                    docs.append(id)
                    parts.append(ids + end)
                    total += len(parts[-1]) // 4
                    if total >= BLOCK:
                        yield block()
                        docs, parts, total, number = [], [], 0, number + 1
        if docs:
            yield block()

    return run


BLOCK_COLUMNS = ["part", "block", "doc_ids", "lengths", "n_ids", "payload"]
BLOCK_SCHEMA = "part int, block int, doc_ids array<long>, lengths array<long>, n_ids long, payload binary"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, size: int, spaces: bool = False, id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of all texts, each followed by end_id, in ascending order of the id (a whole number); size: ids lie below it."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("hash", text_hash())
    order = ("doc_id", "hash")
    blocks = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(_block_rows(tokenizer, spaces, end_id, size), BLOCK_SCHEMA)
    blocks.write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str, size: int) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit numbers)."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # One row for each block here: few beside the ids, and of no payload.
    by_part = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)).alias("ahead"))
    starts = starts.join(by_part, "part").select(F.col("part").alias("p"), F.col("block").alias("k"), F.expr("base + ahead").alias("first"))
    placed = blocks.join(starts, F.expr("part = p and block = k")).select("first", "doc_ids", "lengths", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                first, docs, lengths, payload = (c[k].as_py() for c in batch.columns)
                data = decode(payload, size).tobytes()
                n = np.array(lengths, np.int64)
                begin = np.cumsum(n) - n
                ids = [data[4 * a : 4 * (a + m)] for a, m in zip(begin.tolist(), lengths)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(begin + first), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
