"""Toxicity by compression distance: two zstandard dictionaries, compared window by window.

Words of labelled texts and their beginnings are counted per class. The toxic dictionary is made of
those that toxic texts hold significantly more often (signed G-test), so that unseen words of a toxic
kind compress well too; the ordinary one of the most frequent others. Every word is compressed with
either dictionary; the pair of lengths (with the word's own size) is a cell. How often cells occur in
toxic and in ordinary text gives each cell a log-likelihood weight. A
window is a run of `SPAN` words, half overlapping; its evidence is the sum over its words, and the
`STRONGEST` windows decide for the text, so that ordinary text around a passage takes nothing from it.
The sample is cut into `FOLDS` parts; each has a pair of dictionaries of the other
parts, whose cells it weighs, and a word weighs what it does with the pairs on average. The threshold is
the one with the best F1 on labelled rows, each judged by its own part's pair. The lengths of a word are the same
everywhere, so they are remembered; windows compressed as a whole did worse on held-out rows, since
a window's length says little about the one word that matters.

Copies would make any of their words telling: of the sample's texts of a class with the same smallest
hash of `SHINGLE` words one is read, and that hash decides on the part.

zstandard stores very short input and its last bytes as they are, so windows stand between a fixed
head, which both dictionaries hold, and a fixed tail.

Bounds: at most `SAMPLE_ROWS` labelled rows per class are read for fitting, `DICTIONARY_WORDS` words
and `DICTIONARY_BYTES` bytes per dictionary. Scoring covers all words of all texts.

Defined cases: null and empty texts have no evidence; without labels of both kinds nothing is toxic;
labels of unknown documents are ignored; an empty table gives none.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgap.llm.common import bounded_batches, written
from fieldgap.llm.sampling import labelled_sample

LIMIT = 0.7
SAMPLE_ROWS = 4000
DICTIONARY_WORDS = 20_000
DICTIONARY_BYTES = 110_000
SIGNIFICANT = 18.0
TIMES = 5.0
#: Lengths of the beginnings of words that may stand in a dictionary.
BEGINNINGS = range(4, 10)
SHINGLE = 5
SPAN, STRONGEST = 32, 3
FOLDS = 4
LEVEL = 3
HEAD, TAIL = b"<<window of text follows here>> ", b"~~~~~~~~~~~~"
REMEMBERED = 1 << 19
WORD = re.compile(r"[^\W_]+")

Cell = tuple[int, int, int]


@dataclass
class Pair:
    """A toxic and an ordinary dictionary, and what their cells weigh."""

    toxic: bytes
    ordinary: bytes
    weight: dict[Cell, float] = field(default_factory=dict)


@dataclass
class Model:
    pairs: list[Pair] = field(default_factory=list)
    threshold: float = 1.0

    def score(self, evidence: float) -> float:
        """Between 0 and 1; LIMIT at the threshold."""
        x = evidence - self.threshold + math.log(LIMIT / (1 - LIMIT))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def segments(own: list[str]) -> set[str]:
    """The different words and their beginnings."""
    found = set(own)
    return found | {w[:k] for w in found for k in BEGINNINGS if k < len(w)}


def smallest_shingle(own: list[str]) -> int:
    """The smallest hash of consecutive words, signed."""
    runs = (" ".join(own[k : k + SHINGLE]) for k in range(max(1, len(own) - SHINGLE + 1)))
    return min(xxhash.xxh64_intdigest(r) for r in runs) - (1 << 63)


def strongest(weights: list[float]) -> float:
    """The sum of the largest windows' weights."""
    step = SPAN // 2
    block: dict[int, float] = defaultdict(float)
    for k, w in enumerate(weights):
        if w:
            block[k // step] += w
    last = max(0, (len(weights) - 1) // step - 1)
    starts = {b for k in block for b in (k - 1, k) if 0 <= b <= last}
    return sum(heapq.nlargest(STRONGEST, (block.get(b, 0.0) + block.get(b + 1, 0.0) for b in starts)))


def cells(model: Pair) -> Callable[[str], Cell]:
    """The cell of a word: its size and its length under either dictionary."""
    compressors = []
    for content in (model.toxic, model.ordinary):
        dictionary = zstandard.ZstdCompressionDict(content + HEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        compressors.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
            ).compress
        )
    bare = [len(c(HEAD + TAIL)) for c in compressors]

    def cell(word: str) -> Cell:
        own = word.encode()
        framed = HEAD + b" " + own + b" " + TAIL
        toxic, ordinary = (max(-2, min(20, len(c(framed)) - b)) for c, b in zip(compressors, bare, strict=True))
        return min(24, len(own)), toxic, ordinary

    return cell


def evidence_of(pairs: list[Pair]) -> Callable[[str | None], float]:
    """The evidence of a text; a word weighs what it does with the pairs on average."""
    looked = [(cells(p), p.weight) for p in pairs if p.weight]
    known: dict[str, float] = {}

    def evidence(text: str | None) -> float:
        own = words(text)
        if not looked:
            return 0.0
        if len(known) >= REMEMBERED:
            known.clear()
        for w in own:
            if w not in known:
                known[w] = sum(weight.get(cell(w), 0.0) for cell, weight in looked) / len(pairs)
        return strongest([known[w] for w in own])

    return evidence


def surprise(a: Column, p: Column, b: Column, n: Column) -> Column:
    """The G statistic of a word in a of p toxic and b of n ordinary texts."""
    share = (a + b) / (p + n)

    def part(k: Column, m: Column, q: Column) -> Column:
        yes = F.when(k > 0, k * F.log(q)).otherwise(0.0)
        return yes + F.when(m > k, (m - k) * F.log(1 - q)).otherwise(0.0)

    return 2 * (part(a, p, a / p) + part(b, n, b / n) - part(a, p, share) - part(b, n, share))


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", id_column: str = "doc_id",
    text_column: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from the label rows that `usable` selects."""
    sizes = {r["y"]: r["n"] for r in labels.where(usable).groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    sample = labelled_sample(docs, labels, label, usable, sample_rows, id_column, text_column)

    def keyed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys = [smallest_shingle(words(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *batch.columns], ["key", *batch.schema.names])

    fold = F.pmod(F.xxhash64("key", F.lit("fold")), F.lit(FOLDS))
    sample = sample.select("id", "y", "text").mapInArrow(keyed, "key long, id long, y int, text string")
    sample = written(sample.withColumns({"fold": fold, "copy": F.xxhash64("text")}), "toxic-sample")
    first = sample.groupBy("key", "y").agg(F.min(F.struct("id", "copy")).alias("f")).select("key", "y", "f.*")
    sample = sample.join(F.broadcast(first), ["key", "y", "id", "copy"]).dropDuplicates(["key", "y"])
    sample = written(sample.select("y", "fold", "text"), "toxic-texts")
    texts = {(r["fold"], r["y"]): r["n"] for r in sample.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}
    model = Model()
    if len({f for f, y in texts if y}) < 2 or len({f for f, y in texts if not y}) < 2:
        return model

    def split(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [sorted(segments(words(t))) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.string()))], ["fold", "y", "words"])

    held = sample.select("fold", "y", "text").mapInArrow(split, "fold long, y int, words array<string>")
    counts = held.select("fold", "y", F.explode("words").alias("w")).groupBy("fold", "w").agg(
        F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b")
    )
    counts = written(counts, "toxic-words")

    def dictionaries(fold: int) -> Pair:
        """Of all folds but this."""
        p, n = (float(sum(k for (f, label_), k in texts.items() if f != fold and label_ == y)) for y in (1, 0))
        a, b = F.col("a"), F.col("b")
        out = F.when((a / p > TIMES * b / n) & (a > 1), surprise(a, F.lit(p), b, F.lit(n))).otherwise(0.0) >= SIGNIFICANT
        rated = counts.where(F.col("fold") != fold).groupBy("w").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn("out", out)

        def content(rows: DataFrame, by: str) -> bytes:
            top = rows.orderBy(F.desc(by), "w").limit(DICTIONARY_WORDS).select("w").collect()
            # The most frequent stand last, where offsets are short.
            return b" ".join([b"", *(r["w"].encode() for r in reversed(top)), b""])[-DICTIONARY_BYTES:]

        return Pair(content(rated.where("out"), "a"), content(rated.where("not out and b > 0"), "b"))

    pairs = [dictionaries(f) for f in range(FOLDS)]
    if not any(len(pair.toxic) > 2 for pair in pairs):
        return model

    def tally(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, seen = {f: lru_cache(REMEMBERED // FOLDS)(cells(p)) for f, p in enumerate(pairs)}, Counter()
        for batch in rows:
            for f, y, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen.update((f, y, *cell[f](w)) for w in words(text))
        columns = list(zip(*((*k, v) for k, v in seen.items()), strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["fold", "y", "s", "t", "o", "n"])

    rows = sample.select("fold", "y", "text")
    tallied = rows.mapInArrow(tally, "fold long, y long, s long, t long, o long, n long")
    cellwise = tallied.groupBy("fold", "y", "s", "t", "o").agg(F.sum("n").alias("n")).collect()
    for f, pair in enumerate(pairs):
        seen = Counter({(r["y"], (r["s"], r["t"], r["o"])): r["n"] for r in cellwise if r["fold"] == f})
        total = {y: sum(v for (k, _), v in seen.items() if k == y) + 1 for y in (0, 1)}
        for cell in {k for y, k in seen if y == 1}:
            hot, cold = (seen[1, cell] + 1) / total[1], (seen[0, cell] + 1) / total[0]
            if seen[1, cell] > 1 and hot > TIMES * cold:
                pair.weight[cell] = math.log(hot / cold)
    model.pairs = pairs

    def judge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = [evidence_of([pair]) for pair in pairs]
        for batch in rows:
            found = [evidence[f](t) for f, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.float64())], ["y", "e"])

    judged = [(r["e"], r["y"]) for r in rows.mapInArrow(judge, "y int, e double").collect()]
    model.threshold = best_threshold(judged, {y: sizes.get(y, 1) / max(1, sum(v == y for _, v in judged)) for y in (0, 1)})
    return model


def best_threshold(judged: list[tuple[float, int]], times: dict[int, float]) -> float:
    """The evidence with the best F1 when either class counts as often as among all labels; at least 0.5."""
    rows = sorted(judged, reverse=True)
    positives = times[1] * sum(y for _, y in rows)
    best, chosen, hit, false = -1.0, 1.0, 0.0, 0.0
    for k, (e, y) in enumerate(rows):
        hit, false = hit + times[1] * y, false + times[0] * (1 - y)
        below = rows[k + 1][0] if k + 1 < len(rows) else e - 1
        f1 = 2 * hit / (positives + hit + false) if positives else 0.0
        if below < e and f1 > best:
            best, chosen = f1, (e + below) / 2
    return max(0.5, chosen)


def scores(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score), one row per row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = evidence_of(model.pairs)
        for batch in rows:
            found = [model.score(evidence(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["id", "score"])

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return bounded_batches(narrow).mapInArrow(batches, "id long, score double")


def without_toxic(docs: DataFrame, model: Model, text_column: str = "text", limit: float = LIMIT) -> DataFrame:
    """The rows, with all columns, that score below the limit."""
    column = docs.columns.index(text_column)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = evidence_of(model.pairs)
        for batch in rows:
            low = [model.score(evidence(t)) < limit for t in batch.column(column).to_pylist()]
            yield batch.filter(pa.array(low, pa.bool_()))

    return bounded_batches(docs).mapInArrow(batches, docs.schema)
