"""Exact top-k by inner product over buckets of vectors of similar length.

Vectors are whole numbers, floor(scale * x). They are sorted into buckets by length (borders are
quantiles), longest first. A first pass against the longest vectors gives every query the k-th best
score so far, theta. A vector of length l can only reach theta if its cosine with the query is at
least theta / (|q| l); with a bucket's largest length this is the local threshold. A query skips
buckets whose threshold is above 1. In the others it is verified by exact products with the vectors
that pass a pruning: by length (|q| l >= theta), or, where the threshold is high, by coordinates: on
the query's `FOCUS` largest coordinates the product is exact, and the rest is bounded by the lengths
of what remains.

Queries and buckets meet in blocks, at most `QUERY_BLOCK` queries with one bucket of about `BUCKET`
vectors, each in a task of its own; a query is only sent to buckets that may hold a result, and comes
back with k rows of each. All of a bucket's vectors are compared, so results are exact.

Defined cases: vectors that are null or hold null or non-finite components take no part, as query or
candidate; scaled components and scores are longs, and where one is not between -2 ** 63 and 2 ** 63 the
query fails; products are taken in doubles below 2 ** 53 and in whole numbers above; in vectors of different sizes missing components count as zero; ties go to the smaller id;
fewer candidates than k give all of them; rows of one id are each other's own and never meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgap.llm.common import written

K = 20
SCALE = 64
BUCKET = 4096
QUERY_BLOCK = 2048
#: Vectors of the first pass, whose results are the first thetas.
SEED = 1024
#: Coordinates that coordinate pruning looks at first, and the threshold from which it is used.
FOCUS = 8
STEEP = 0.4
ROWS_AT_ONCE = 256


def whole_numbers(column: str, scale: int) -> Column:
    """floor(scale * x) of every component, null where the vector can't take part."""
    x = F.transform(column, lambda v: v.cast("double"))
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    too_long = F.exists(x, lambda v: F.abs(v * scale) >= F.lit(2.0**63))
    return F.when(
        F.col(column).isNotNull() & fit,
        F.when(too_long, F.raise_error("a scaled component is beyond the range of long")).otherwise(
            F.transform(x, lambda v: F.floor(v * scale).cast("long"))
        ),
    )


def matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of whole numbers."""
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def exact_products(queries: np.ndarray, vectors: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of whole numbers, none of which is above the bound."""
    if bound < 2.0**63:
        return queries @ vectors.T
    # Some may be too long.
    return queries.astype(object) @ vectors.astype(object).T


def best_of(
    queries: np.ndarray, ids: np.ndarray, theta: np.ndarray, length: np.ndarray, vectors: np.ndarray,
    vector_ids: np.ndarray, vector_length: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of the k best of each query that reach its theta."""
    rows, found, scores = [], [], []
    longest = vector_length[0] if len(vector_length) else 0.0
    doubles = vectors.astype(np.float64)
    theta = np.nextafter(theta, -math.inf)  # of a score that a double may have rounded up
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(length * longest > 0, theta / (length * longest), np.where(theta > 0, np.inf, 0.0))
    for start in range(0, len(queries), ROWS_AT_ONCE):
        some = np.arange(start, min(len(queries), start + ROWS_AT_ONCE))
        some = some[local[some] <= 1 + 1e-9]
        for steep in (False, True):
            chosen = some[(local[some] >= STEEP) == steep]
            if not len(chosen):
                continue
            # No sum of products is above the product of the lengths.
            most = length[chosen].max() * longest * (1 + 1e-9)
            q = queries[chosen].astype(np.float64)
            if steep:  # by coordinates, for the block's own largest ones
                focus = np.argsort(-np.abs(q).sum(0), kind="stable")[:FOCUS]
                rest = np.setdiff1d(np.arange(q.shape[1]), focus)
                bound = q[:, focus] @ doubles[:, focus].T
                bound += np.linalg.norm(q[:, rest], axis=1)[:, None] * np.linalg.norm(doubles[:, rest], axis=1)
                passes = (bound >= theta[chosen][:, None] - 1e-6 - 1e-9 * max(most, 1.0)).any(0)
            else:  # by length: vectors are sorted by it
                least = (theta[chosen] / np.maximum(length[chosen], 1e-300)).min()
                passes = vector_length >= least * (1 - 1e-9) - 1e-9
            where = np.flatnonzero(passes)
            if not len(where):
                continue
            if most < 2.0**53:
                product = (q @ doubles[where].T).astype(np.int64)
            else:
                product = exact_products(queries[chosen], vectors[where], most)
            other = ids[chosen][:, None] != vector_ids[where][None, :]
            for r, row, may in zip(chosen, product, other, strict=True):
                keep = np.flatnonzero((row >= theta[r]) & may)
                if len(keep) > k:
                    if row.dtype == object:
                        keep = np.array(sorted(keep, key=lambda i: (-row[i], vector_ids[where[i]]))[:k])  # noqa: B023
                    else:
                        limit = -np.partition(-row[keep], k - 1)[k - 1]
                        keep = keep[row[keep] >= limit]
                        order = np.lexsort((vector_ids[where[keep]], -row[keep]))[:k]
                        keep = keep[order]
                rows.append(np.full(len(keep), r))
                found.append(where[keep])
                # Fails where a score is no long.
                scores.append(row[keep].astype(np.int64))
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def block_search(k: int):
    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        vectors = vectors.sort_values(["length", "id"], ascending=[False, True])
        width = max(vectors["v"].map(len).max(), queries["q"].map(len).max())
        v, q = matrix(vectors["v"], width), matrix(queries["q"], width)
        ids, query_ids = vectors["id"].to_numpy(), queries["query_id"].to_numpy()
        theta = queries["theta"].fillna(-math.inf).to_numpy()
        row, at, score = best_of(
            q, query_ids, theta, queries["q_length"].to_numpy(), v, ids, vectors["length"].to_numpy(), k
        )
        return pd.DataFrame({"query_id": query_ids[row], "vec_id": ids[at], "score": score.astype("int64")})

    return search


def top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def exact_top_k(
    embeddings: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding",
    k: int = K, scale: int = SCALE, bucket: int = BUCKET, query_block: int = QUERY_BLOCK, seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query row."""
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("id"), is_query.alias("is_query"), whole_numbers(vector_column, scale).alias("v")
    ).where("id is not null and v is not null")
    length = F.sqrt(F.aggregate("v", F.lit(0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = written(rows.withColumn("length", length), "vectors")
    number, asked = rows.agg(F.count("*"), F.count_if("is_query")).first()
    buckets, blocks = max(1, -(-number // bucket)), max(1, -(-asked // query_block))
    # Borders between buckets: lengths, descending. Vectors of one length are dealt by a hash.
    steps = [1 - i / buckets for i in range(1, buckets)]
    borders = sorted(set(rows.approxQuantile("length", steps, min(0.01, 0.1 / buckets)) if steps and number else []), reverse=True)
    levels = F.array(*[F.lit(b) for b in borders]) if borders else F.array().cast("array<double>")
    level = F.size(F.filter(levels, lambda b: b > F.col("length")))
    sizes = {r["b"]: r for r in rows.groupBy(level.alias("b")).agg(F.count("*").alias("n"), F.max("length").alias("most")).collect()}
    parts = F.array(*[F.lit(max(1, -(-sizes[b]["n"] // bucket)) if b in sizes else 1) for b in range(len(borders) + 1)])
    candidates = rows.select(
        "id", "length", "v", level.alias("b"), F.pmod(F.xxhash64("id", "v"), F.element_at(parts, level + 1)).cast("int").alias("part")
    )
    queries = rows.where("is_query").select(
        F.col("id").alias("query_id"),
        F.col("length").alias("q_length"),
        F.col("v").alias("q"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
    )

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        keys = ["b", "part", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            block_search(k), "query_id long, vec_id long, score long"
        )

    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    # The longest vectors answer every query first.
    longest = rows.orderBy(F.desc("length"), "id").limit(max(seed, k + 1)).select("id", "length", "v")
    first = meet(
        longest.select("id", "length", "v", F.lit(0).alias("b"), F.lit(0).alias("part"), all_blocks.alias("block")),
        queries.select("*", F.lit(0).alias("b"), F.lit(0).alias("part"), F.lit(None).cast("double").alias("theta")),
    )
    theta = top(first, k).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("theta"))
    asked_rows = queries.join(written(theta, "thetas"), "query_id", "left")
    most = F.array(*[F.lit(float(sizes[b]["most"]) if b in sizes else -1.0) for b in range(len(borders) + 1)])
    reach = F.filter(
        F.sequence(F.lit(0), F.lit(len(borders))),
        lambda b: F.coalesce(F.col("theta") <= F.col("q_length") * F.element_at(most, b + 1) * (1 + 1e-9) + 1e-9, F.lit(True)),
    )
    sent = asked_rows.withColumn("b", F.explode(reach))
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("b") + 1) - 1)))
    found = meet(candidates.withColumn("block", all_blocks), sent.select("query_id", "q_length", "q", "theta", "b", "part", "block"))
    return top(found, k).select("query_id", "rank", "vec_id", "score")
