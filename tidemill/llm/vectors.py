"""Vectors in blocks: a stated query set against all rows.

Queries and candidates are hashed into blocks of a bounded number of rows; a cell joins one block of queries with
one part of the candidates, so each query meets every candidate once and no cell outgrows a worker.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a cell; with 64 doubles each, 8 MB and 24 MB. Larger blocks of queries copy candidates less often.
QUERY_ROWS, PART_ROWS = 16_384, 50_000


def finite(vector: Column) -> Column:
    """True for vectors whose components are all finite numbers."""
    return vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def cells(vectors: DataFrame, every: int, search: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, score_type: str, largest_first: bool) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best that ``search`` finds in each cell, best first, ties to the smaller vec_id.

    ``vectors``: (vec_id, v), only rows that take part. Queries are the rows whose vec_id is divisible by ``every``.
    ``search(query ids, query vectors, ids, vectors)`` returns the queries' places, ids found and scores. Vectors are
    compared with those of equal dimension only.
    """
    spark = vectors.sparkSession
    n = vectors.count()
    n_queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0).count()
    parts = max(math.ceil(n / PART_ROWS), min(2 * spark.sparkContext.defaultParallelism, math.ceil(n / 1000)), 1)
    blocks = max(math.ceil(n_queries / QUERY_ROWS), 1)
    part, block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int"), F.pmod(F.xxhash64("v", "vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    dim = F.size("v").alias("dim")
    candidates = vectors.select("vec_id", "v", dim, part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "v", dim, block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    schema = f"query_id long, vec_id long, score {score_type}"

    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        at, ids, scores = search(q["vec_id"].to_numpy(), np.stack(q["v"].to_numpy()), c["vec_id"].to_numpy(), np.stack(c["v"].to_numpy()))
        return pd.DataFrame({"query_id": q["vec_id"].to_numpy()[at], "vec_id": ids, "score": scores})

    keys = ["dim", "block", "part"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(run, schema)
    best = W.partitionBy("query_id").orderBy(F.col("score").desc() if largest_first else F.col("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def merge(ids: np.ndarray, scores: np.ndarray, new_ids: np.ndarray, new_scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest of both by score and id."""
    ids, scores = np.concatenate([ids, new_ids]), np.concatenate([scores, new_scores])
    # whole numbers of any length have no lexsort
    best = sorted(range(len(ids)), key=lambda i: (scores[i], ids[i]))[:k] if scores.dtype == object else np.lexsort((ids, scores))[:k]
    return ids[best], scores[best]
