"""Toxicity by a classifier chain: one linear model for each category, fed the probabilities of the categories before it.

Categories are 0/1 columns of the labelled rows, in order. A model's features are words and their first letters, lower-cased, that
tell the last category apart (chi-square over the training rows, at most `FEATURES`), and the earlier categories' probabilities.
For training these come from models that have not seen the row (folds by a hash of the id), so a later model learns how far to
trust what it will be given.

Where the labels hold one flag only, the categories before it are `KINDS` kinds found in the training rows, in each language by
itself: its markers are the features that go with the flag there (`markers`), dealt to the kinds so that forms of one word stay
together and kinds hold about equally many rows (`dealt`). A row is of a kind if it is flagged and has one of its markers.

The chain is fitted on at most `TRAIN_ROWS` labelled rows, the first by a hash of their id; features are counted by Spark, the
models are fitted on the driver from a few numbers for each row. Null and empty texts have no features and get what the model
says of none. Null labels and labels without a document do not count; without any, or with one value of a category only, its
probability is its share. Rows without a language are a language of their own, as are all rows of docs without that column; scores
do not see the language. Repeated rows get the same result; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pursefold.llm.common import first_by_hash, written

TRAIN_ROWS, FEATURES, FOLDS, STEPS = 12_000, 4096, 5, 200
LEAST_DOCS = 4
CUT = 0.5
KINDS = 3
#: A marker's least chi-square (one chance in a thousand), and how many a language has at most.
LEAST_CHI, MARKERS = 10.83, 64
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    """Distinct words of the whole text, and the first 4 to 6 letters of longer ones, marked by a dash."""
    found = set(_WORD.findall(text.lower()))
    return found | {f"{w[:k]}-" for w in found for k in (4, 5, 6) if len(w) > k}


def markers(has: np.ndarray, flag: np.ndarray) -> np.ndarray:
    """The columns of has (rows by features) that go with the flag, strongest first; ties by number."""
    n, k, total, flagged = has.sum(axis=0), has[flag].sum(axis=0), len(flag), int(flag.sum())
    over = k * total - n * flagged
    chi = over.astype(float) ** 2 * total / np.maximum(1.0, n * (total - n) * float(flagged) * (total - flagged))
    good = np.flatnonzero((over > 0) & (chi >= LEAST_CHI) & (n >= LEAST_DOCS))
    return good[np.lexsort((good, -chi[good]))][:MARKERS]


def dealt(has: np.ndarray, kinds: int = KINDS) -> np.ndarray:
    """A kind for each column: that of the most similar earlier one if they share half of their rows, else the one with the fewest rows."""
    both = has.T.astype(int) @ has.astype(int)
    rows = np.zeros((len(has), kinds), bool)
    found = np.zeros(has.shape[1], int)
    for m in range(has.shape[1]):
        alike = both[m, :m] / np.maximum(1, both[m, m] + both.diagonal()[:m] - both[m, :m])
        found[m] = found[alike.argmax()] if m and alike.max() >= 0.5 else rows.sum(axis=0).argmin()
        rows[:, found[m]] |= has[:, m]
    return found


def kinds_of(counts: np.ndarray, index: np.ndarray, flag: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """0/1, a row for each row and a column for each kind."""
    of_kind = np.zeros((len(counts), KINDS), int)
    ends = np.cumsum(counts)
    order = np.argsort(langs, kind="stable")
    _, first = np.unique(langs[order], return_index=True)
    for own in np.split(order, first[1:]):
        flagged = flag[own] == 1
        if flagged.sum() < LEAST_DOCS:
            continue
        features, column = np.unique(np.concatenate([index[ends[r] - counts[r] : ends[r]] for r in own]), return_inverse=True)
        has = np.zeros((len(own), len(features)), bool)
        has[np.repeat(np.arange(len(own)), counts[own]), column] = True
        chosen = has[:, markers(has, flagged)]
        kind = dealt(chosen[flagged])
        for k in range(KINDS):
            of_kind[own, k] = flagged & chosen[:, kind == k].any(axis=1)
    return of_kind


@dataclass
class Linear:
    weights: np.ndarray
    start: float

    def probability(self, counts: np.ndarray, index: np.ndarray, before: np.ndarray) -> np.ndarray:
        """counts: how many of index belong to each row."""
        n = self.weights.size - before.shape[1]
        at = np.repeat(np.arange(len(counts)), counts)
        raw = self.start + np.bincount(at, self.weights[:n][index], len(counts)) + (before * self.weights[n:]).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(counts: np.ndarray, index: np.ndarray, before: np.ndarray, y: np.ndarray, size: int) -> Linear:
    """Logistic regression with a small penalty, by Adam over all rows."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Linear(np.zeros(size + before.shape[1]), float(np.log(share / (1 - share))))
    if y.all() or not y.any():
        return model
    at = np.repeat(np.arange(len(counts)), counts)
    speed, spread = np.zeros(model.weights.size + 1), np.zeros(model.weights.size + 1)
    for step in range(1, STEPS + 1):
        wrong = model.probability(counts, index, before) - y
        slope = np.r_[np.bincount(index, wrong[at], size) / len(y), (before * wrong[:, None]).mean(axis=0), wrong.mean()]
        slope[:-1] += 1e-5 * model.weights
        speed, spread = 0.9 * speed + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        move = 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        model.weights -= move[:-1]
        model.start -= float(move[-1])
    return model


def fit_chain(counts: np.ndarray, index: np.ndarray, labels: np.ndarray, fold: np.ndarray, size: int) -> list[Linear]:
    """labels: a column for each category, in order."""
    before, chain = np.zeros((len(counts), 0)), []
    at = np.repeat(np.arange(len(counts)), counts)
    for y in labels.T.astype(float):
        chain.append(fit(counts, index, before, y, size))
        unseen = np.zeros(len(counts))
        for k in range(FOLDS):
            own = fold == k
            model = fit(counts[~own], index[~own[at]], before[~own], y[~own], size)
            unseen[own] = model.probability(counts[own], index[own[at]], before[own])
        before = np.column_stack([before, unseen])
    return chain


def _indexed(known: dict[str, int], text: str, keep: list[str]):
    """The features of each text that are known, as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(known[w] for w in words(t or "") if w in known) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(rows, pa.list_(pa.int32()))], [*keep, "index"])

    return run


def train(
    docs: DataFrame, labelled: DataFrame, categories: tuple[str, ...] | None = None, train_rows: int = TRAIN_ROWS, lang: str = "lang"
) -> tuple[dict[str, int], list[Linear]]:
    """The known features and the chain. labelled: doc_id and the categories; without categories, doc_id and `toxic`."""
    first = first_by_hash(labelled, "doc_id", train_rows)
    labels = list(categories or ["toxic"])
    of_lang = (F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")).alias("__lang")
    own = docs.select("doc_id", "text", of_lang).filter("doc_id is not null")
    sample = own.join(F.broadcast(first), "doc_id")  # at most train_rows ids
    sample = written(sample.select("doc_id", "text", "__lang", *(F.col(c).cast("int").alias(c) for c in labels)), "toxicity")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([list(words(t or "")) for t in batch.column(0).to_pylist()], pa.list_(pa.string())), batch.column(1)], ["words", "y"])

    last = labels[-1]
    total = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum(last), F.lit(0)).alias("y")).first()
    seen = sample.select("text", last).mapInArrow(spread, "words array<string>, y int").select(F.explode("words").alias("w"), "y")
    both = seen.groupBy("w").agg(F.count("*").alias("n"), F.sum("y").alias("k")).filter(F.col("n") >= LEAST_DOCS)
    # Chi-square of having the word and being toxic, up to a factor.
    worth = F.pow(F.col("k") * total.n - F.col("n") * total.y, 2) / (F.col("n") * (F.lit(total.n + 1) - F.col("n")))
    best = both.orderBy(worth.desc(), "w").limit(FEATURES).select("w").collect()
    known = {r.w: k for k, r in enumerate(best)}
    keep = ["doc_id", "__lang", *labels]
    schema = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, __lang string, {', '.join(f'{c} int' for c in labels)}, index array<int>"
    kept = sample.select(*keep, "text").mapInArrow(_indexed(known, "text", keep), schema)
    rows = kept.withColumn("fold", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(FOLDS))).orderBy("doc_id", F.hash("index")).toPandas()
    counts = rows["index"].map(len).to_numpy(np.int64)
    index = np.concatenate([*rows["index"], np.zeros(0)]).astype(np.int64)
    wanted, size = rows[labels].to_numpy(int).reshape(-1, len(labels)), max(1, len(known))
    if categories is None:
        # "=" keeps a language named "" apart from none.
        langs = np.array(["" if x is None else f"={x}" for x in rows["__lang"]], str)
        wanted = np.column_stack([kinds_of(counts, index, wanted[:, 0], langs), wanted])
    return known, fit_chain(counts, index, wanted, rows["fold"].to_numpy(), size)


def scored(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] | None = None, train_rows: int = TRAIN_ROWS, lang: str = "lang") -> DataFrame:
    """doc_id, p_<category> for each, and toxic (0 or 1), one row for each row of docs; labels has doc_id and the categories, or `toxic`.

    Without categories they are kind1 to kind3 and toxic. Labels that repeat an id count as their greatest.
    """
    own = categories or ("toxic",)
    usable = " and ".join(f"`{c}` is not null" for c in ("doc_id", *own))
    labelled = labels.filter(usable).groupBy("doc_id").agg(*(F.max(c).alias(c) for c in own))
    known, chain = train(docs, labelled, categories, train_rows, lang)
    categories = categories or (*(f"kind{k + 1}" for k in range(KINDS)), "toxic")
    names = ["doc_id", *(f"p_{c}" for c in categories), "toxic"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    look_up = _indexed(known, "text", ["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in look_up(batches):
            lists = batch.column("index").to_pylist()
            counts = np.array([len(x) for x in lists], np.int64)
            index = np.array([i for x in lists for i in x], np.int64)
            before = np.zeros((len(counts), 0))
            for model in chain:
                before = np.column_stack([before, model.probability(counts, index, before)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in before.T), pa.array((before[:, -1] >= CUT).astype(np.int32))], names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {', '.join(f'p_{c} double' for c in categories)}, toxic int")
