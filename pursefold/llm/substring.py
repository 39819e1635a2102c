"""Exact repeated passages, found by difference-cover anchors.

Words at positions that fall on a cover of the residues modulo `PERIOD` start anchors, hashed runs of words; the rest start
none. The cover holds every difference, so wherever a passage of `window` words stands in two texts, some shift below
the period lands on the cover in both, and they share an anchor that lies inside the passage. So only anchors that occur twice
are followed: the windows around them are hashed whole (96 bits), and of equal windows all but the first are repeats. A whole text that
stands under a smaller id as well has no first window at all, so such copies are told by the hash of the text and followed no further.

Both steps send one row for each hash and batch of texts, not one for each place: what repeats within a batch is known
there, so a passage in a third of all documents makes no hot key. Equal hashes then meet by a shuffle and are told by
comparing neighbours in sorted order.

Null and empty texts have no words. Rows of one id and text are repeated rows of one document and get the same result;
different texts under one id are ordered by their hash. A null id comes first. An empty table gives no rows. Only the id and
text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pursefold.llm.common import byte_texts, written

WINDOW = 20
#: A perfect difference cover: every residue is a difference of two of these.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Stands for every window of a text.
ALL = -1
#: Text bytes that are compared with each other before anything is sent; bytes that are hashed at once.
BLOCK, SLICE = 1 << 25, 1 << 22

_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BYTE = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_P), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _runs(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each run values[start:stop], equal for equal runs, by differences of one running sum."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_P, len(values)), out=total[1:])
    return _mixed((total[stops] - total[starts]) * _powers(_BACK, len(values) + 1)[starts])


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word; a long text is taken slice by slice, cut between words."""
    found, at = [], 0
    while at < len(text):
        end = min(len(text), at + SLICE)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        data = np.frombuffer(text, np.uint8, end - at, at)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_SPACE[data]
        edge = np.diff(inside)
        found.append(_runs(_BYTE[data], np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def anchors(text: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places on the cover and the hash of the run of words that starts there."""
    hashes, size = word_hashes(text), window - PERIOD + 1
    if len(hashes) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places = np.arange(len(hashes) - size + 1)
    places = places[np.isin(places % PERIOD, COVER)]
    return places, _runs(hashes, places, places + size)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (first columns, text) in lists of about BLOCK bytes of text."""
    rows, size = [], 0
    for batch in batches:
        others = [c.to_pylist() for c in batch.columns[:-1]]
        for *row, text in zip(*others, byte_texts(batch.columns[-1])):
            rows.append((*row, text))
            size += len(text)
            if size >= BLOCK:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _anchor_rows(window: int):
    """hash, group, mark: four times the place, plus 0 if its hash is the only one here, 1 if the first of several, 2 if another of these.

    In the order of the texts, so that the group compresses well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            found = [anchors(text, window) for _, text in rows]
            groups = np.repeat(np.array([r[0] for r in rows], np.int64), [len(p) for p, _ in found])
            places, hashes = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            same = ranked[1:] == ranked[:-1]
            told = np.zeros(len(hashes), np.int64)
            told[order[:-1][same]] = 1
            told[order[1:][same]] = 2
            sent = np.where(told == 2, _mixed(groups.view(np.uint64)), hashes)  # those need no telling: a text's stay together
            yield pa.RecordBatch.from_arrays([pa.array(sent.view(np.int64)), pa.array(groups), pa.array((places * 4 + told).astype(np.int32))], ["hash", "group", "mark"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """group and place of anchors that occur twice, from rows sorted by hash."""
    held = None
    for batch in batches:
        hashes, groups, marks = (c.to_numpy() for c in batch.columns)
        if held is not None:
            hashes, groups, marks = (np.r_[x, c] for x, c in zip(held, (hashes, groups, marks)))
        if not len(hashes):
            continue
        same = hashes[1:] == hashes[:-1]
        twice = marks & 3 > 0
        twice[1:] |= same
        twice[:-1] |= same
        # The last row waits for the next batch; it knows already whether it equals the one before.
        held = hashes[-1:], groups[-1:], (marks[-1:] | 3) if twice[-1] else marks[-1:]
        out = np.flatnonzero(twice[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(groups[out]), pa.array(marks[out] >> 2)], ["group", "place"])
    if held is not None and held[2][0] & 3:
        yield pa.RecordBatch.from_arrays([pa.array(held[1]), pa.array(held[2] >> 2)], ["group", "place"])


WINDOW_COLUMNS = ["a", "b", "id", "key", "start", "many"]


def _window_rows(window: int):
    """Windows around repeated anchors: their digest a, b, text and start, with many 0; and runs of `many` that are known not to be first.

    In the order of the texts, so that id and key compress well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            digests, ids, keys, counts, starts = [], [], [], [], []
            for id, key, places, text in rows:
                words = text.split()
                change = np.zeros(len(words) + 2, np.int64)
                places = np.array(places, np.int64)
                places = places[places < len(words)]
                np.add.at(change, np.maximum(places - PERIOD + 1, 0), 1)
                np.add.at(change, places + 1, -1)
                at = np.flatnonzero(np.cumsum(change[: max(0, len(words) - window + 1)]) > 0)
                stops = np.cumsum([len(w) + 1 for w in words]) - 1
                begins = np.r_[0, stops[:-1] + 1]
                joined = b" ".join(words)
                digests += [xxhash.xxh3_128_digest(joined[x:y]) for x, y in zip(begins[at].tolist(), stops[at + window - 1].tolist())]
                ids.append(np.iinfo(np.int64).min if id is None else id)
                keys.append(key)
                counts.append(len(at))
                starts.append(at)
            a, b = (np.ascontiguousarray(c) for c in np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T)
            b = b.astype(np.int32)
            id, key, start = np.repeat(np.array(ids, np.int64), counts), np.repeat(np.array(keys, np.int64), counts), np.concatenate(starts)
            order = np.lexsort((start, key, id, b, a))
            new = np.r_[True, np.diff(a[order]) != 0] if len(a) else np.zeros(0, bool)
            new[1:] |= np.diff(b[order]) != 0
            first = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(a) else order
            told = np.zeros(len(a), bool)
            told[order] = (id[order] != id[first]) | (key[order] != key[first]) | (start[order] != start[first])
            # What is known not to be first needs no digest, and a run of it is one row.
            joins = np.r_[False, told[1:] & told[:-1] & (key[1:] == key[:-1]) & (start[1:] == start[:-1] + 1)][: len(a)]
            heads = np.flatnonzero(~joins)
            many = np.where(told[heads], np.diff(np.r_[heads, len(a)]), 0)
            sent = np.where(told[heads], _mixed(key[heads].view(np.uint64)).view(np.int64), a[heads])
            columns = (sent, np.where(told[heads], 0, b[heads]).astype(np.int32), id[heads], key[heads], start[heads].astype(np.int32), many.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], WINDOW_COLUMNS)

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows that are not the first of their kind, from rows sorted by digest, text and start."""
    before = None
    for batch in batches:
        if not len(batch):
            continue
        a, b, id, key, start, many = (c.to_numpy() for c in batch.columns)
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        lead = [c[first] for c in (id, key, start)]
        if before is not None and (a[0], b[0]) == before[:2]:
            for c, x in zip(lead, before[2:]):
                c[first == 0] = x
        later = (many > 0) | (id != lead[0]) | (key != lead[1]) | (start != lead[2])
        before = (a[-1], b[-1], lead[0][-1], lead[1][-1], lead[2][-1])
        out = np.flatnonzero(later)
        yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in (id, key, start, np.maximum(many, 1))], ["id", "key", "start", "many"])


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, texts = [], [], []
            for key, runs, text in zip(batch.column("key").to_pylist(), batch.column("runs").to_pylist(), byte_texts(batch.column("text"))):
                words = text.split()
                change = np.zeros(len(words) + 1, np.int64)
                starts = np.array([(x["start"], x["many"]) for x in runs or [] if x["key"] == key], np.int64).reshape(-1, 2)
                if (starts[:, 1] == ALL).any():
                    starts = np.array([(0, len(words) - window + 1)] * (len(words) >= window), np.int64).reshape(-1, 2)
                np.add.at(change, starts[:, 0], 1)
                np.add.at(change, starts.sum(axis=1) - 1 + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                texts.append(b" ".join([w for w, out in zip(words, gone.tolist()) if not out]).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    return run


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the text's remaining words, one row for each row of docs. The id is a whole number."""
    if window < PERIOD:
        raise ValueError(f"a window must have at least {PERIOD} words")
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(id, text).alias("key"), F.col(text).alias("text"))
    # Places are gathered by id, which compresses better than the key; a null id has its key's.
    rows = rows.withColumn("group", F.coalesce("doc_id", "key"))
    first_id = F.coalesce("doc_id", F.lit(-(2**63)))
    named = rows.select("group", "key", first_id.alias("id"), F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).alias("t"))
    least = named.groupBy("t").agg(F.min("id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    # Joined as a struct, by which the counts are not dealt out yet: only so does Spark split the rows of a text with many copies.
    least = least.select(F.struct("t").alias("of"), "least")
    copies = written(named.join(least, (F.struct("t") == F.col("of")) & F.expr("id > least")).groupBy(F.col("group").alias("c")).agg(F.collect_set("key").alias("copies")), "copies")
    new = rows.join(copies, F.expr("group <=> c"), "left").filter(F.expr("copies is null or not array_contains(copies, key)")).select(rows.columns)
    sent = new.select("group", "text").mapInArrow(_anchor_rows(window), "hash long, group long, mark int")
    repeated = sent.repartition("hash").sortWithinPartitions("hash").mapInArrow(_repeated, "group long, place int")
    places = repeated.groupBy(F.col("group").alias("g")).agg(F.collect_set("place").alias("places"))
    # The texts are dealt out once, by group, for this join and the last.
    followed = rows.join(places, F.expr("group <=> g")).select("doc_id", "key", "places", "text")
    windows = followed.mapInArrow(_window_rows(window), "a long, b int, id long, key long, start int, many int")
    later = windows.repartition("a").sortWithinPartitions(*WINDOW_COLUMNS[:5]).mapInArrow(_later, "id long, key long, start int, many int")
    group = F.when(F.col("id") == F.lit(-(2**63)), F.col("key")).otherwise(F.col("id")).alias("g")
    told = copies.select(F.col("c").alias("g"), F.explode("copies").alias("key"), F.lit(0).alias("start"), F.lit(ALL).alias("many"))
    later = later.select(group, "key", "start", "many").union(told)
    runs = later.groupBy("g").agg(F.collect_set(F.struct("key", "start", "many")).alias("runs"))
    done = rows.join(runs, F.expr("group <=> g"), "left").select("doc_id", "key", "runs", "text")
    return done.mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, text string")
