"""A quality score learned from preferences: a Bradley-Terry model over features of the text.

Of each pair of one good and one bad labelled document the good one is preferred. The model is linear: the logistic loss is on
the difference of the pair's features, so only what tells documents apart counts and there is no intercept. Features are
shares and rates over the whole text (never its id, language or source), each as a number and as the bin, by quantiles of
the training rows, that it falls into. The cut between good and bad is the quantile of the training scores that leaves below
it the share of bad training rows, and is placed at 0.7 of the score.

Every usable labelled row is fitted on, and every pair of a good and a bad one, in passes of Spark over the training rows. Pairs are
not formed: the loss and its slope need, at each row's score, a sum over the scores of the other kind, and that sum is smooth. Each
row is dealt to the `NODES` Chebyshev nodes of the unit interval that its score lies in, so that a sum over all rows becomes one
over nodes, right to about 1e-8. Means, quantiles and the cut are those of all rows; quantiles are found digit by digit. Rows are
added up in blocks by a hash of their id, whose sums are whole numbers or added exactly, so no order or partitioning changes the model.

Null and empty texts have features of zero and are scored like others. Labels that are null, or whose document is missing, do
not count; with labels of one kind only every score is 0.5. Repeated rows get the same score; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pursefold.llm import textstats
from pursefold.llm.common import byte_texts, written

BINS, STEPS, RIDGE = 10, 300, 1e-3
#: Training rows in a block, nodes in a unit of the score, units of sums that are rounded to whole numbers.
BLOCK, NODES, UNIT = 1024, 8, 1 << 30
#: The fit ends where no slope is steeper, or after so many steps; so many earlier ones shape a step.
FLAT, MOST, EARLIER = 1e-6, 300, 30
CUT = 0.7
N_FEATURES = 17


def features(text: bytes) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    n_words, chars, symbols, dup_lines, repeats, n_lines, upper = textstats.counts(text)
    ids = textstats.word_ids(words)
    often = np.bincount(ids)
    lengths = np.fromiter(map(len, words), np.int64, n)
    letters = upper + len(text) - len(text.translate(None, bytes(range(97, 123))))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    return [
        math.log1p(n), min(symbols / n, 3), upper / max(letters, 1), digits / len(text), min(text.count(b"!") / n, 2), (text.count(b".") + text.count(b",")) / n,
        min(chars / n, 40), len(often) / n, len(often) / n**0.8, repeats / n, dup_lines / n_lines, int(often.max()) / n, float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
        text.count(b"|") / n, n_lines / n, float(np.minimum(lengths, 100).std()), sum(1 for b in (b"http", b"www", b"@") if b in text),
    ]


def with_features(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([features(t) for t in byte_texts(batch.column(1))], np.float32).reshape(-1, N_FEATURES)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * N_FEATURES, pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "x"])

    return docs.select(id, text).mapInArrow(run, f"doc_id {kind}, x array<float>")


def held_out(id: str = "doc_id") -> Column:
    return F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2


@dataclass
class Model:
    """score(x): 0 to 1, for rows of features."""

    middle: np.ndarray
    scale: np.ndarray
    edges: np.ndarray
    weights: np.ndarray
    cut: float

    def basis(self, x: np.ndarray) -> np.ndarray:
        # The bin is told by which inner edges the value has passed.
        steps = (x[:, :, None] > self.edges[None]).reshape(len(x), -1)
        return np.hstack([np.clip((x - self.middle) / self.scale, -4, 4), steps])

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.einsum("ij,j->i", self.basis(x.astype(np.float64)), self.weights)
        return 1 / (1 + np.exp(-np.clip(raw - self.cut + math.log(CUT / (1 - CUT)), -30, 30)))


def fit(x: np.ndarray, good: np.ndarray, pairs: int, seed: int = 7) -> Model | None:
    """The same model for a few rows in memory, by that many random pairs; `scored` fits on all rows and pairs, by `fit_all`.

    None if there are not both kinds. Sums, not matrix products: a BLAS library's threads would fight Spark's."""
    if good.all() or not good.any():
        return None
    x = x.astype(np.float64)
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    model = Model(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6), edges, np.zeros(0), 0.0)
    basis = model.basis(x)
    random = np.random.default_rng(seed)
    better, worse = (random.choice(np.flatnonzero(k), pairs) for k in (good, ~good))
    difference = basis[better] - basis[worse]
    w, speed, size = np.zeros(basis.shape[1]), np.zeros(basis.shape[1]), np.zeros(basis.shape[1])
    for step in range(1, STEPS + 1):  # Adam on all of these pairs
        wrong = 1 / (1 + np.exp(np.clip(np.einsum("ij,j->i", difference, w), -30, 30)))
        slope = RIDGE * w - np.einsum("ij,i->j", difference, wrong) / pairs
        speed = 0.9 * speed + 0.1 * slope
        size = 0.99 * size + 0.01 * slope**2
        w -= 0.05 * (speed / (1 - 0.9**step)) / (np.sqrt(size / (1 - 0.99**step)) + 1e-8)
    model.weights = w
    raw = np.einsum("ij,j->i", basis, w)
    model.cut = float(np.quantile(raw, (~good).mean()))
    return model


def training(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """block, good and x: all usable labelled rows, in blocks of about `BLOCK` by a hash of the id, in the order of the id."""
    usable = labels.filter("quality is not null and doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # Of several texts under an id the one with the least features, so that the model never depends on row order.
    train = usable.join(rows, "doc_id").groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, usable.count() // BLOCK)))
    items = F.array_sort(F.collect_list(F.struct("doc_id", (F.col("quality") == 1).alias("good"), "x"))).alias("items")
    blocks = train.groupBy(block.alias("block")).agg(items)
    return written(blocks.select("block", F.transform("items", lambda i: i["good"]).alias("good"), F.flatten(F.transform("items", lambda i: i["x"])).alias("x")), "training")


Own = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _each(batch: pa.RecordBatch, own: Own) -> Iterator[np.ndarray]:
    """own(good, x) of each block in a batch."""
    for good, x in zip(batch.column(0), batch.column(1)):
        yield own(good.values.to_numpy(zero_copy_only=False), x.values.to_numpy().reshape(-1, N_FEATURES).astype(np.float64))


def _exact(blocks: DataFrame, own: Own) -> np.ndarray:
    """The sum over all blocks of a few numbers for each, as if added without rounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes() for found in _each(batch, own)], pa.binary())], ["found"])

    parts = np.array([np.frombuffer(r[0]) for r in blocks.select("good", "x").mapInArrow(run, "found binary").collect()])
    return np.array([math.fsum(c) for c in parts.T])


def _whole(blocks: DataFrame, own: Own) -> np.ndarray:
    """The sum over all blocks of whole numbers, of which a task hands in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for found in _each(batch, own):
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["found"])

    found = blocks.select("good", "x").mapInArrow(run, "found binary").collect()
    return np.sum([np.frombuffer(r[0], np.int64) for r in found], axis=0)


def _rising(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the values."""
    bits = (values + 0.0).view(f"u{values.itemsize}")  # + 0.0: no negative zero
    top = bits.dtype.type(1 << (8 * values.itemsize - 1))
    return np.where(bits & top, ~bits, bits | top)


def _values_of(keys: np.ndarray, kind: type) -> np.ndarray:
    """The values of `_rising`."""
    top = keys.dtype.type(1 << (8 * keys.itemsize - 1))
    return np.where(keys & top, keys ^ top, ~keys).view(kind)


def quantiles(blocks: DataFrame, own: Callable[[np.ndarray], np.ndarray], columns: int, kind: type, n: int, shares: np.ndarray, digit: int) -> np.ndarray:
    """Exact quantiles (linear between neighbours) of each of the columns that own gives of a block, digit bits at a time.

    At each step all rows are counted by the next digit where their digits so far are those of a rank that is sought.
    """
    at = shares * (n - 1)
    ranks = np.unique(np.r_[np.floor(at), np.ceil(at)].astype(np.int64))
    bits, unsigned = 8 * np.dtype(kind).itemsize, np.dtype(f"u{np.dtype(kind).itemsize}").type
    many = 1 << digit
    prefix, ahead = np.zeros((columns, len(ranks)), unsigned), np.zeros((columns, len(ranks)), np.int64)
    for shift in range(bits - digit, -1, -digit):
        sought = [np.unique(p) for p in prefix]
        starts = np.cumsum([0, *map(len, sought)])

        def count(good: np.ndarray, x: np.ndarray, shift=shift, sought=sought, starts=starts) -> np.ndarray:
            found = np.zeros((starts[-1], many), np.int64)
            for k, keys in enumerate(_rising(np.ascontiguousarray(own(x).T.astype(kind)))):
                so_far = keys >> unsigned(shift + digit) if shift + digit < bits else np.zeros_like(keys)
                place = np.minimum(np.searchsorted(sought[k], so_far), len(sought[k]) - 1)
                here = sought[k][place] == so_far
                digits = (keys[here] >> unsigned(shift)) & unsigned(many - 1)
                found[starts[k] : starts[k + 1]] += np.bincount(place[here] * many + digits.astype(np.int64), minlength=len(sought[k]) * many).reshape(-1, many)
            return found.ravel()

        counts = _whole(blocks, count).reshape(-1, many)
        for k in range(columns):
            for j, rank in enumerate(ranks):
                upto = np.cumsum(counts[starts[k] + np.searchsorted(sought[k], prefix[k, j])])
                next_digit = int(np.searchsorted(upto, rank - ahead[k, j], side="right"))
                ahead[k, j] += upto[next_digit - 1] if next_digit else 0
                prefix[k, j] = (int(prefix[k, j]) << digit) | next_digit
    found = _values_of(prefix, kind).astype(np.float64)
    low, high = (found[:, np.searchsorted(ranks, f(at).astype(np.int64))] for f in (np.floor, np.ceil))
    return low + (at - np.floor(at)) * (high - low)


_POINTS = np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))
#: Turns powers of a place between -1 and 1 into its weights on the nodes.
_WEIGHTS = np.linalg.inv(np.vander(_POINTS, increasing=True))


def _dealt(score: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of each score, numbered from `low` upwards, and its weights on them."""
    cell = np.floor(score).astype(np.int64)
    place = np.vander(2 * (score - cell) - 1, NODES, increasing=True)
    return (cell - low)[:, None] * NODES + np.arange(NODES), np.einsum("ip,pq->iq", place, _WEIGHTS)


def _range(w: np.ndarray) -> tuple[int, int]:
    """Whole numbers between which all scores lie."""
    steps = np.cumsum(w[N_FEATURES:].reshape(N_FEATURES, -1), axis=1)
    own = 4 * np.abs(w[:N_FEATURES]).sum()
    low, high = own + np.maximum(-steps.min(axis=1), 0).sum(), own + np.maximum(steps.max(axis=1), 0).sum()
    return -math.ceil(low + 1), math.ceil(high + 1)


def fit_all(blocks: DataFrame) -> Model | None:
    """The model by all rows of `training` and all their pairs; None if there are not both kinds."""
    both = _whole(blocks, lambda good, x: np.array([good.sum(), (~good).sum()], np.int64)) if not blocks.isEmpty() else np.zeros(2, np.int64)
    if not both.all():
        return None
    n_good, n_bad = (int(k) for k in both)
    n = n_good + n_bad
    middle = _exact(blocks, lambda good, x: x.sum(axis=0)) / n
    scale = np.maximum(np.sqrt(_exact(blocks, lambda good, x: ((x - middle) ** 2).sum(axis=0)) / n), 1e-6)
    edges = quantiles(blocks, lambda x: x, N_FEATURES, np.float32, n, np.linspace(0, 1, BINS + 1)[1:-1], 4)
    model = Model(middle, scale, edges, np.zeros(N_FEATURES * BINS), 0.0)

    def loss(w: np.ndarray):
        """The loss at w, and at each node how wrong a good and a bad row there would be: the mean over rows of the other kind."""
        low, high = _range(w)

        def deal(good: np.ndarray, x: np.ndarray) -> np.ndarray:
            nodes, weights = _dealt(np.einsum("ij,j->i", model.basis(x), w), low)
            found = [np.bincount(nodes[k].ravel(), weights[k].ravel(), (high - low) * NODES) for k in (good, ~good)]
            return np.rint(np.concatenate(found) * UNIT).astype(np.int64)

        good, bad = _whole(blocks, deal).reshape(2, -1) / UNIT
        places = (np.arange(low, high)[:, None] + (_POINTS + 1) / 2).ravel()
        used = (good != 0) | (bad != 0)
        apart = places[used][:, None] - places[used]
        # Of a good row there (by row) and a bad one (by column); ln(1 + exp(-apart)) without overflow.
        each = np.maximum(-apart, 0) + np.log1p(np.exp(-np.abs(apart)))
        wrong = 1 / (1 + np.exp(np.clip(apart, -700, 700)))
        wrongs = np.zeros((2, len(places)))
        wrongs[0, used], wrongs[1, used] = (wrong * bad[used]).sum(axis=1) / n_bad, (wrong * good[used][:, None]).sum(axis=0) / n_good
        value = float((each * good[used][:, None] * bad[used]).sum()) / n_good / n_bad + RIDGE / 2 * float(w @ w)
        return value, wrongs, low

    def slope(w: np.ndarray, wrongs: np.ndarray, low: int) -> np.ndarray:
        def add(good: np.ndarray, x: np.ndarray) -> np.ndarray:
            basis = model.basis(x)
            nodes, weights = _dealt(np.einsum("ij,j->i", basis, w), low)
            own = (wrongs[np.where(good, 0, 1)[:, None], nodes] * weights).sum(axis=1)
            return np.rint(np.concatenate([np.einsum("ij,i->j", basis[k], own[k]) for k in (good, ~good)]) * UNIT).astype(np.int64)

        good, bad = _whole(blocks, add).reshape(2, -1) / UNIT
        return RIDGE * w - good / n_good + bad / n_bad

    w = model.weights
    value, *at = loss(w)
    g = slope(w, *at)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(MOST):  # L-BFGS
        if np.abs(g).max() <= FLAT:
            break
        way, shares = -g, []
        for s, y in reversed(past):
            shares.append((s * way).sum() / (s * y).sum())
            way = way - shares[-1] * y
        if past:
            way = way * (past[-1][0] * past[-1][1]).sum() / (past[-1][1] ** 2).sum()
        for (s, y), share in zip(past, reversed(shares)):
            way = way + (share - (y * way).sum() / (s * y).sum()) * s
        length, down = 1.0, float((way * g).sum())
        while True:
            new = w + length * way
            lower, *at = loss(new)
            if lower <= value + 1e-4 * length * down or length < 1e-6:
                break
            length /= 2
        if lower >= value:  # nothing is left but rounding
            break
        old, g = g, slope(new, *at)
        if ((new - w) * (g - old)).sum() > 0:
            past = [*past, (new - w, g - old)][-EARLIER:]
        w, value = new, lower
    model.weights = w
    raw = lambda x: np.einsum("ij,j->i", model.basis(x), w)[:, None]
    model.cut = float(quantiles(blocks, raw, 1, np.float64, n, np.array([n_bad / n]), 8)[0, 0])
    return model


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, one row for each row of docs; labels has doc_id and quality."""
    rows = written(with_features(docs), "features")
    model = fit_all(training(rows, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, N_FEATURES)
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
