"""Quality by Bradley-Terry ranking of documents.

A pair of one document labelled good and one labelled bad is a preference. The strength of a document
is linear in its features, and the probability of the preference is the logistic function of the
strengths' difference, so the weights come from a logistic loss on differences of features (Newton's
method, small ridge). The threshold is the quantile of the labelled documents' strengths at the share
of bad labels; scores are strengths shifted so that the threshold becomes `LIMIT`.

Features are shares and logarithms over the whole text: sizes, kinds of words, punctuation, repeated
words, word pairs and lines, and how well the text compresses.

Every labelled row takes part in means, weights and threshold. Rows are dealt by a hash into blocks of
about `BLOCK_ROWS`, and all pairs of a good and a bad row of a block are preferences, since all pairs of
all rows grow with their square. Rows of a class with less than `PARTNERS` rows a block stand in several
blocks, so that every row has partners. Newton's rounds and the threshold are sums over the rows, made by
Spark's tasks; the driver gets one short row per task. The threshold is exact to `NARROW`.

Defined cases: null and empty texts score by the features of no words; without labels of both kinds
every document scores `LIMIT`; an empty table gives none.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgap.llm.common import bounded_batches, written

LIMIT = 0.3
BLOCK_ROWS = 1024
PARTNERS = 64
BINS = 4096
NARROW = 1e-9
RIDGE = 1e-3
ROUNDS = 40
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
DIGITS = b"0123456789"
COMPRESSED_AT_ONCE = 1 << 16


def features(text: str | None) -> list[float]:
    text = text or ""
    raw, words, lines = text.encode(), text.split(), text.split("\n")
    n, size, chars = len(words), max(1, len(words)), max(1, len(text))
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    packer = zlib.compressobj(1)
    packed = sum(len(packer.compress(raw[i : i + COMPRESSED_AT_ONCE])) for i in range(0, len(raw), COMPRESSED_AT_ONCE))
    packed += len(packer.flush())
    return [
        math.log1p(n),
        math.log1p(n) ** 2 / 20,
        float(n == 0),
        len(raw) / size / 10,
        min(3.0, max(map(len, words), default=0) / 100),
        sum(map(str.isalpha, words)) / size,
        sum(map(str.isupper, words)) / size,
        (len(raw) - len(raw.translate(None, PUNCTUATION))) / chars,
        (len(raw) - len(raw.translate(None, DIGITS))) / chars,
        (text.count(".") + text.count("!") + text.count("?")) / size,
        distinct / size,
        (distinct / size) ** 2,
        distinct / math.sqrt(size),
        pairs / max(1, n - 1),
        len(set(lines)) / len(lines),
        len(lines) / size,
        sum(len(x) < 40 for x in lines) / len(lines),
        text.count("|") / size,
        text.count("http") / size,
        (text.count("{") + text.count(";")) / size,
        min(3.0, packed / max(1, len(raw))),
    ]


@dataclass
class Model:
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    threshold: float = 0.0

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; LIMIT at the threshold."""
        if self.weights is None:
            return np.full(len(x), LIMIT)
        shifted = self.strength(x) - self.threshold + math.log(LIMIT / (1 - LIMIT))
        return 1 / (1 + np.exp(-np.clip(shifted, -40, 40)))


def pair_sums(x: np.ndarray, y: np.ndarray, n: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, slope and curvature of the preferences of rows with y = 1 over rows with y = 0.

    `n` says how often a row stands there. Sums over pairs come from sums over rows and columns.
    """
    good, bad = x[y == 1], x[y == 0]
    pairs = np.outer(n[y == 1], n[y == 0])
    wrong = 1 / (1 + np.exp(np.clip((good @ w)[:, None] - bad @ w, -40, 40)))
    pull, bent = wrong * pairs, wrong * (1 - wrong) * pairs
    slope = good.T @ pull.sum(1) - bad.T @ pull.sum(0)
    cross = good.T @ bent @ bad
    bend = (good.T * bent.sum(1)) @ good + (bad.T * bent.sum(0)) @ bad - cross - cross.T
    return np.concatenate([[pairs.sum()], slope, bend.ravel()])


def newton(sums: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Weights at the top of the likelihood; `sums` gives what `pair_sums` gives, over all blocks."""
    w = np.zeros(size)
    for _ in range(ROUNDS):
        found = sums(w)
        pairs = max(1.0, found[0])
        slope = found[1 : size + 1] / pairs - RIDGE * w
        bend = found[size + 1 :].reshape(size, size) / pairs + RIDGE * np.eye(size)
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def rank(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bradley-Terry weights of all preferences of rows with y = 1 over rows with y = 0."""
    return newton(lambda w: pair_sums(x, y, np.ones(len(y)), w), x.shape[1])


def featured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, x), one row per row: the features of every text, written once for fitting and scoring."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            x = pa.array([features(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), x], ["id", "x"])

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return written(bounded_batches(narrow).mapInArrow(batches, "id long, x array<double>"), "quality")


def totals(rows: DataFrame, value: Callable[..., np.ndarray], join: Callable = np.add) -> np.ndarray | None:
    """`value(x, y, n)` of the rows of each batch, joined over all batches; None without rows."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in found:
            if not batch.num_rows:
                continue
            y, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(float)
            part = value(batch.column(2).flatten().to_numpy().reshape(len(y), -1), y, n)
            out = part if out is None else join(out, part)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["v"])

    out = None
    for row in rows.select("y", "n", "x").mapInArrow(batches, "v array<double>").toLocalIterator():
        out = np.array(row["v"]) if out is None else join(out, np.array(row["v"]))
    return out


def blocks(known: DataFrame, number: dict[int, int]) -> DataFrame:
    """(rows): lists of (id, y, n, x) of about `BLOCK_ROWS` rows, each with rows of either class."""
    count = max(1, math.ceil(sum(number.values()) / BLOCK_ROWS))
    copies = {y: min(count, math.ceil(PARTNERS * count / n)) for y, n in number.items()}
    places = F.when(F.col("y") == 1, copies[1]).otherwise(copies[0])
    at = F.explode(F.sequence(F.lit(0), places - 1)).alias("_at")
    dealt = known.select("*", at).withColumn("_block", F.pmod(F.xxhash64("id", "x") + F.col("_at"), F.lit(count)))
    return dealt.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("id", "y", "n", "x"))).alias("rows"))


def summed_pairs(paired: DataFrame, model: Model, w: np.ndarray) -> np.ndarray:
    """`pair_sums` over all blocks."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = 0.0
        for batch in found:
            for rows in batch.column(0):
                cells = rows.values
                y, n = cells.field("y").to_numpy(), cells.field("n").to_numpy().astype(float)
                x = cells.field("x").flatten().to_numpy().reshape(len(y), -1)
                out = out + pair_sums((x - model.mean) / model.scale, y, n, w)
        if not isinstance(out, float):
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["v"])

    parts = paired.select("rows").mapInArrow(batches, "v array<double>").toLocalIterator()
    return sum(np.array(row["v"]) for row in parts)


def strength_at(known: DataFrame, model: Model, share: float, weight: dict[int, float]) -> float:
    """The middle between the first strength at which the rows' mass reaches `share` and the one before."""

    def ends(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        strength = model.strength(x)
        return np.array([-strength.min(), strength.max()])

    lowest, highest = totals(known, ends, np.maximum) * [-1, 1]
    low, high, below = lowest, np.nextafter(highest, np.inf), 0.0
    while high - low > NARROW:
        edges = np.linspace(low, high, BINS + 1)

        def mass(x: np.ndarray, y: np.ndarray, n: np.ndarray, edges: np.ndarray = edges) -> np.ndarray:
            at = np.searchsorted(edges, model.strength(x), side="right") - 1
            inside = (at >= 0) & (at < BINS)
            return np.bincount(at[inside], (n * np.where(y == 1, weight[1], weight[0]))[inside], BINS)

        reached = below + np.cumsum(totals(known, mass))
        at = min(int(np.searchsorted(reached, share + 1e-12)), BINS - 1)
        below = reached[at - 1] if at else below
        low, high = edges[at], edges[at + 1]

    def before(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        strength = model.strength(x)
        return np.array([strength[strength < low].max(initial=-np.inf)])

    last = totals(known, before, np.maximum)[0]
    return float(low if np.isinf(last) else (last + low) / 2)


def fit(
    rows: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", id_column: str = "doc_id"
) -> Model:
    """Learn from the label rows that `usable` selects; `rows` are the features by id.

    Ids with several labels take the largest.
    """
    told = labels.where(usable & F.col(id_column).isNotNull() & F.col(label).isNotNull())
    shares = labels.where(usable & F.col(label).isNotNull()).agg(F.avg((F.col(label) == 0).cast("double"))).first()[0]
    classes = told.groupBy(F.col(id_column).cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    known = written(rows.join(classes, "id").groupBy("id", "y", "x").agg(F.count("*").alias("n")), "quality-labels")
    number = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    if not {0, 1} <= number.keys():
        return Model()
    known = known.where("y in (0, 1)")
    number = {y: number[y] for y in (0, 1)}
    every = sum(number.values())
    mean = totals(known, lambda x, y, n: n @ x) / every
    scale = np.sqrt(totals(known, lambda x, y, n: n @ (x - mean) ** 2) / every) + 1e-9
    model = Model(mean, scale)
    paired = written(blocks(known, number), "quality-blocks")
    model.weights = newton(lambda w: summed_pairs(paired, model, w), len(mean))
    # Documents may hold the classes in other shares than the labels do.
    model.threshold = strength_at(known, model, shares, {0: shares / number[0], 1: (1 - shares) / number[1]})
    return model


def scores(rows: DataFrame, model: Model) -> DataFrame:
    """(id, score), one row per row of `featured`."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            score = np.zeros(0)
            if batch.num_rows:
                score = model.score(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["id", "score"])

    return rows.select("id", "x").mapInArrow(batches, "id long, score double")
