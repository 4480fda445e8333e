"""Approximate nearest neighbours by low-dimensional stable projections in a kd-tree.

Vectors are projected on ``m`` Gaussian directions (2-stable: a projected squared distance is the true one times a
chi-square variable with m degrees of freedom). A kd-tree over the projections yields nodes in order of their
distance to the projected query; points of each leaf reached are verified with their true distance. With d_k the
k-th best true distance so far and r the projected radius reached, a point at distance d_k or less that hasn't
been reached has a projected distance over r, whose probability is at most 1 - chi2_m(r^2 / d_k^2). The search
stops once chi2_m(r^2 / d_k^2) > ``confidence``, so each true neighbour is found with that probability at least; at
d_k = 0 it goes on while a leaf can hold a point at projected distance 0, so of equal vectors the smallest ids are found.

Directions depend on the seed and the dimension only; every row is indexed. Recall against brute force is measured
in the tests (0.9 at least). Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id; vectors are compared with those of equal dimension; rows that
share the query's id are left out; other columns are ignored; fewer candidates give fewer rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

LEAF = 256


def chi_square(x: float, m: int) -> float:
    """P(X <= x) for a chi-square X with an even number m of degrees of freedom."""
    h = x / 2
    term = total = 1.0
    for i in range(1, m // 2):
        term *= h / i
        total += term
    return 1 - math.exp(-h) * total if h < 700 else 1.0


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 10.0 * m + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < p else (low, mid)
    return high


class KdTree:
    """Median splits along the widest side; boxes of all nodes; leaves are slices of one order."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self.nodes: list[tuple[int, int, int, int]] = []  # start, end, left, right
        self._build(points, 0, len(points))

    def _build(self, points: np.ndarray, a: int, b: int) -> int:
        own = points[self.order[a:b]]
        low, high = own.min(axis=0), own.max(axis=0)
        at = len(self.nodes)
        self.nodes.append((a, b, -1, -1))
        self.boxes.append((low, high))
        if b - a > LEAF and (high > low).any():
            axis, mid = int(np.argmax(high - low)), (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, axis], mid)]
            left, right = self._build(points, a, a + mid), self._build(points, a + mid, b)
            self.nodes[at] = (a, b, left, right)
        return at

    def leaves(self, q: np.ndarray):
        """(squared distance of the box, rows) of leaves, nearest box first."""
        heap = [(0.0, 0)]
        while heap:
            near, at = heapq.heappop(heap)
            a, b, left, right = self.nodes[at]
            if left < 0:
                yield near, self.order[a:b]
                continue
            for child in (left, right):
                low, high = self.boxes[child]
                gap = np.maximum(np.maximum(low - q, q - high), 0.0)
                heapq.heappush(heap, (float(gap @ gap), child))


def without_surplus(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that any query can have among its k best: of equal vectors the 2 k smallest ids are enough.

    A query leaves out its own id, which at most k of these rows have.
    """
    keys = np.ascontiguousarray(rows + 0.0).view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel()
    group = np.unique(keys, return_inverse=True)[1].ravel()

    def smallest(order: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
        places = np.arange(len(order))
        return order[places - np.maximum.accumulate(np.where(starts, places, 0)) < most]

    order = np.lexsort((ids, group))
    new_group = np.diff(group[order], prepend=-1) != 0
    order = smallest(order, new_group | np.append(True, ids[order][1:] != ids[order][:-1]), k)
    return np.sort(smallest(order, np.diff(group[order], prepend=-1) != 0, 2 * k))


def projected_search(k: int, m: int, confidence: float, seed: int):
    enough = chi_square_quantile(confidence, m)

    def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        queries, rows = queries.astype(np.float64), rows.astype(np.float64)
        # a common scale keeps squares of very large or small components finite
        scale = max(np.abs(rows).max(), np.abs(queries).max())
        directions = np.random.default_rng(seed).standard_normal((rows.shape[1], m))
        held = without_surplus(ids, rows, k)
        ids, rows = ids[held], rows[held]
        # scaled components are 1 at most: equal vectors may be so far apart once projected, by rounding
        slack = math.sqrt(m) * np.finfo(np.float64).eps * rows.shape[1] * float(np.abs(directions).sum(axis=0).max())
        low_rows, low_queries = (rows / scale) @ directions, (queries / scale) @ directions
        tree = KdTree(low_rows)
        at, found, scores = [], [], []
        for i, q in enumerate(queries):
            best_ids, best = np.empty(0, np.int64), np.empty(0)
            for near, leaf in tree.leaves(low_queries[i]):
                if len(best) == k and near > (math.sqrt(enough) * best[-1] / scale + slack) ** 2:
                    break
                own = leaf[ids[leaf] != query_ids[i]]
                d = np.sqrt((((rows[own] - q) / scale) ** 2).sum(axis=1)) * scale if scale > 1e100 or scale < 1e-100 else np.sqrt(((rows[own] - q) ** 2).sum(axis=1))
                if len(best) == k:
                    keep = d <= best[-1]
                    own, d = own[keep], d[keep]
                best_ids, best = vectors.merge(best_ids, best, ids[own], d, k)
            at.append(np.full(len(best), i))
            found.append(best_ids)
            scores.append(best)
        return np.concatenate(at), np.concatenate(found), np.concatenate(scores)

    return search


def search(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, m: int = 8, confidence: float = 0.97, seed: int = 17) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose id is divisible by ``every``; score: the Euclidean distance."""
    whole = F.col(vector_col)
    usable = table.where(F.col(id_col).isNotNull() & (F.size(whole) > 0) & vectors.finite(whole) & F.exists(whole, lambda c: c != 0))
    doubles = usable.select(F.col(id_col).cast("long").alias("vec_id"), whole.cast("array<double>").alias("v"))
    return vectors.cells(doubles, every, projected_search(k, m, confidence, seed), k, "double", largest_first=False)


def op3_projected_neighbours(spark, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "embeddings"))
