"""Exact top-k search by inner product, pruned by segment means and deviations.

Vectors are cut into equal segments. By Cauchy and Schwarz, the product of two
segments of width w is at most w * (mean * mean + deviation * deviation), so
sums over the segments bound the score from above (and the distance, which is
the norms less twice the score, from below). Bounds are taken from coarse
segments to fine ones; candidates that cannot reach the k-th best score found
so far drop out, and the survivors are scored exactly in whole numbers.

Queries and candidates are dealt into blocks of bounded size, and each pair of
blocks is one group that gives at most k rows per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ringlens.session import stored

K = 10
SCALE = 1024
EVERY = 100
LEVELS = (1, 4, 16)
QUERY_BLOCK = 1_024
CANDIDATE_BLOCK = 16_384
#: Rounding of the bounds in double precision, relative to the norms.
SLACK = 1e-9
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``id`` and ``q``: floor(scale * x) of each component as doubles; unusable vectors are left out."""

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for key, vector in zip(batch.column("id").to_pylist(), batch.column("vec").to_pylist(), strict=True):
                if key is None or vector is None or any(x is None for x in vector):
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    values = np.floor(np.asarray(vector, float) * scale)
                if np.isfinite(values).all():
                    ids.append(key)
                    rows.append(values.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], ["id", "q"])

    plain = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vec")
    )
    return plain.mapInArrow(scaled, "id bigint, q binary")


def matrix(rows: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows; a shorter one ends in zeros."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        vector = np.frombuffer(row, float)
        out[i, : len(vector)] = vector
    return out


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each times the root of the segment's width, side by side."""
    width = math.ceil(vectors.shape[1] / segments)
    padded = np.pad(vectors, ((0, 0), (0, width * segments - vectors.shape[1]))).reshape(len(vectors), segments, width)
    return np.concatenate([padded.mean(axis=2), padded.std(axis=2)], axis=1) * math.sqrt(width)


def exact_scores(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; doubles while they are exact, else integers, at most 64 bits wide."""
    reach = float(np.abs(query).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, len(query))
    if reach < 1 << 53:
        return (candidates @ query).astype(np.int64)
    wide = [int(x) for x in query]
    sums = [sum(int(a) * b for a, b in zip(row, wide, strict=True)) for row in candidates]
    return np.array([min(max(s, LONG_MIN), LONG_MAX) for s in sums], np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def search_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of this block for each query of this block."""
    # Rows of one id count once, by the smallest bytes.
    queries = queries.sort_values(["id", "q"]).drop_duplicates("id")
    candidates = candidates.sort_values(["id", "q"]).drop_duplicates("id")
    if queries.empty or candidates.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    width = max(1, *(len(q) // 8 for q in queries["q"]), *(len(q) // 8 for q in candidates["q"]))
    asked, held = matrix([*queries["q"]], width), matrix([*candidates["q"]], width)
    query_ids, ids = queries["id"].to_numpy(), candidates["id"].to_numpy()
    levels = sorted({min(level, width) for level in LEVELS})
    held_statistics = [segment_statistics(held, level) for level in levels]
    asked_statistics = [segment_statistics(asked, level) for level in levels]
    slack = SLACK * np.linalg.norm(held, axis=1)
    out = []
    for start in range(0, len(asked), 64):
        coarse = asked_statistics[0][start : start + 64] @ held_statistics[0].T
        for row, bounds in enumerate(coarse):
            at = start + row
            allowed = slack * np.linalg.norm(asked[at]) + 1
            alive = np.flatnonzero(ids != query_ids[at])
            # The most promising candidates set the first threshold.
            first = alive[np.argsort(-bounds[alive], kind="stable")[: 4 * k]]
            known = np.sort(exact_scores(asked[at], held[first]))
            least = known[-k] if len(known) >= k else LONG_MIN
            for level in range(len(levels)):
                if level:
                    bounds = np.empty(len(held))
                    bounds[alive] = held_statistics[level][alive] @ asked_statistics[level][at]
                # Scores are cut off at 64 bits, and so are the bounds.
                alive = alive[np.maximum(bounds[alive] + allowed[alive], LONG_MIN) >= least]
            scores = exact_scores(asked[at], held[alive])
            chosen = best(ids[alive], scores, k)
            out.append(
                pd.DataFrame({"query_id": query_ids[at], "vec_id": ids[alive][chosen], "score": scores[chosen]})
            )
    return pd.concat(out, ignore_index=True)


def top_k(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = K,
    every: int = EVERY,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the k best candidates of each query.

    * Queries are the rows whose id is divisible by ``every``; candidates are
      all rows but those of the query's own id. Ties go to smaller ids; a
      query with fewer candidates gets all of them.
    * Vectors that are null or hold components that are null, not finite or
      not finite once scaled, and rows without an id, take no part. Of rows with one id the one with the
      smallest bytes counts. A shorter vector counts as if it ended in zeros;
      an empty one scores 0. Scores beyond 64 bits are the nearest long.
    * Other columns are not read; an empty table gives an empty result.
    """
    usable = stored(whole_vectors(vectors, id_column, vector_column, scale), "whole-vectors")
    asked = usable.where(F.col("id") % every == 0)
    counts = usable.agg(F.count("*").alias("all"), F.count_if(F.col("id") % every == 0).alias("asked")).first()
    query_blocks = max(1, math.ceil(counts["asked"] / query_block))
    candidate_blocks = max(1, math.ceil(counts["all"] / candidate_block))

    def block(blocks: int, salt: int):
        return F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(blocks)).cast("int")

    def every_block(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = asked.select(block(query_blocks, 1).alias("qb"), every_block(candidate_blocks).alias("cb"), "id", "q")
    right = usable.select(every_block(query_blocks).alias("qb"), block(candidate_blocks, 2).alias("cb"), "id", "q")
    found = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInPandas(lambda a, b: search_block(a, b, k), "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
