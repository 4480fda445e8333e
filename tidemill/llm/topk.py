"""Exact top-k inner products by Fagin's threshold algorithm.

Every block of candidates has a list of its rows per dimension, sorted by component. For a query, lists are read
from their better end (by the sign of the query's component); each row seen is scored by random access. A row not
seen yet can't score above the threshold, the sum of query component times the component where each list stands.
Reading stops once the k-th best score found so far, in this block or those before it, is above the threshold.
(At equality it goes on: an unseen row might tie and have the smaller id.)

Components are floor(256 * x) with x as double; scores are exact integers: in double precision where every sum stays
below 2^53, and in whole numbers of any length for the rows and queries whose components are larger.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows with a null
id or empty vectors. Vectors are compared with those of equal dimension. A query's own row is left out by its id, so
other rows that repeat this id are left out too. A score that a long can't hold is the long nearest to it.
Other columns are ignored; fewer candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

#: Rows of a block with its own sorted lists.
BLOCK = 4096
LONG = (1 << 63) - 1


def whole_numbers(a: np.ndarray) -> np.ndarray:
    out = np.empty(a.shape, object)
    out[:] = [[int(x) for x in row] for row in a.tolist()]
    return out


class Best:
    """The k best of each query: scores without their sign, so the smallest come first."""

    def __init__(self, n: int, k: int, kind: type):
        self.k, self.ids, self.scores = k, [np.empty(0, np.int64)] * n, [np.empty(0, kind)] * n

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        self.ids[i], self.scores[i] = vectors.merge(self.ids[i], self.scores[i], ids, -scores, self.k)

    def least(self, i: int):
        """What a score has to reach; None while anything comes in."""
        return -self.scores[i][-1] if len(self.scores[i]) == self.k else None


def search_block(best: Best, places: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, x: np.ndarray, first_depth: int) -> int:
    """The threshold algorithm over one block, for the queries at ``places``. Returns how many rows were scored."""
    n, scored = len(x), 0
    order = np.argsort(x, axis=0, kind="stable")  # one sorted list per dimension
    ranked = np.take_along_axis(x, order, axis=0)
    for i in places.tolist():
        q = queries[i]
        used = np.flatnonzero(q)
        up = np.array(q[used] > 0, bool)
        seen = np.zeros(n, bool)
        low, depth = 0, min(first_depth, n)
        while True:
            window = np.arange(low, depth)
            new = np.zeros(n, bool)
            new[order[n - 1 - window][:, used[up]].ravel()] = True
            new[order[window][:, used[~up]].ravel()] = True
            if not len(used):
                new[:] = True
            new &= ~seen
            seen |= new
            at = np.flatnonzero(new & (ids != query_ids[i]))
            if len(at):
                scores = x[at] @ q
                scored += len(at)
                if (least := best.least(i)) is not None:  # most rows can't come in
                    keep = np.array(scores >= least, bool)
                    at, scores = at[keep], scores[keep]
                best.add(i, ids[at], scores)
            if depth >= n or not len(used):
                break
            bound = ranked[n - depth][used[up]] @ q[used[up]] + ranked[depth - 1][used[~up]] @ q[used[~up]]
            if (least := best.least(i)) is not None and least > bound:
                break
            low, depth = depth, min(2 * depth, n)
    return scored


def threshold_search(k: int, first_depth: int = 16):
    def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # products of components of this size at most, summed, stay exact in double precision
        most = np.sqrt(2.0**53 / rows.shape[1])
        small_q, small = np.abs(queries).max(axis=1) < most, np.abs(rows).max(axis=1) < most
        plain, mixed = small_q.all() and small.all(), Best(len(queries), k, object)
        best = Best(len(queries), k, np.float64)
        for a in range(0, len(rows), BLOCK):
            at = np.flatnonzero(small[a : a + BLOCK]) + a
            if len(at):
                search_block(best, np.flatnonzero(small_q), query_ids, queries, ids[at], rows[at], first_depth)
        if not plain:
            exact_queries = whole_numbers(queries)
            for i in np.flatnonzero(small_q).tolist():
                mixed.add(i, best.ids[i], -whole_numbers(best.scores[i][None])[0])
            for a in range(0, len(rows), BLOCK):
                inside, large = np.arange(a, min(a + BLOCK, len(rows))), ~small[a : a + BLOCK]
                for at, places in ((inside, np.flatnonzero(~small_q)), (inside[large], np.flatnonzero(small_q))):
                    if len(at) and len(places):
                        search_block(mixed, places, query_ids, exact_queries, ids[at], whole_numbers(rows[at]), first_depth)
            best = mixed
        at = np.repeat(np.arange(len(queries)), [len(b) for b in best.scores])
        if not len(at):
            return at, np.empty(0, np.int64), np.empty(0, np.int64)
        scores = [max(min(-int(s), LONG), -LONG - 1) for s in np.concatenate(best.scores).tolist()]
        return at, np.concatenate(best.ids), np.array(scores, np.int64)

    return search


def search(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best for each row whose id is divisible by ``every``."""
    whole = F.col(vector_col)
    usable = table.where(F.col(id_col).isNotNull() & (F.size(whole) > 0) & vectors.finite(whole))
    # floor() makes longs, which hold no component beyond 2^63; from 2^53 on a double is whole already
    floor = lambda c: F.when(F.abs(c) < float(1 << 53), F.floor(c).cast("double")).otherwise(c)
    scaled = usable.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(whole, lambda c: floor(F.lit(float(scale)) * c.cast("double"))).alias("v"))
    return vectors.cells(scaled, every, threshold_search(k), k, "long", largest_first=True)


def op2_threshold_topk(spark, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "embeddings"))


OP2_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda c: floor(256 * c::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 5
"""
