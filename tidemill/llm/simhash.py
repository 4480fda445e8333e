"""SimHash near-duplicates by pivot distance tables.

Fingerprints (64 bits) link at ``radius`` or fewer differing bits; components of links are the groups. Every
different fingerprint is handled once, however many documents share it.

Links are found among fingerprints that agree in some blocks of bits: of radius + s blocks, two that differ in
``radius`` bits at most agree in s, so with a key for each choice of s blocks no link is lost, and pairs aren't
enumerated over the whole corpus (a pivot table alone would have to). s is the least number for which a key's groups
have ``GROUP`` fingerprints on average, so comparisons grow about as the corpus does: s = 1 makes 5 keys of 12 bits, s = 2
15 of 20, s = 3 35 of 27, s = 4 70 of 32. Inside a group the pivot table decides: the Hamming distances of each fingerprint to
``PIVOTS`` reference fingerprints are computed once, a pair whose distances to any reference differ by more than the
radius is discarded (triangle inequality), and what survives is verified bit by bit. A group walks breadth-first
over fingerprints that aren't reached yet, so a dense group of near copies costs about its size, and only a forest
(a link to the smallest fingerprint reached) leaves the task, never all pairs.

Fingerprint: lower-case A-Z, words, shingles of four words joined by a space (all words, if fewer), XXH64 with seed
42; a bit is 1 if set in over half of the shingles' hashes. No words: zero, linked like any other.

Defined cases: a null text is an empty one (zero); an empty table gives an empty result; repeated rows are copies;
the component of rows whose ids are all null is null; other columns are ignored; whole texts are hashed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import common
from .graph import components

SHINGLE, SEED = 4, 42
PIVOTS = 24
#: Fingerprints of a group on average, if their bits were even.
GROUP = 16
#: Copies of a fingerprint, one for each key; 70 serve 10^11 fingerprints.
MOST_KEYS = 300
#: Groups up to this size compare all their rows of the table at once.
SMALL = 128
BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
BYTE_AT = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str | None) -> int:
    """As an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    starts = np.zeros(len(words), np.int64)
    np.cumsum([len(w) + 1 for w in words[:-1]], out=starts[1:])
    ends = (starts[SHINGLE - 1 :] + [len(w) for w in words[SHINGLE - 1 :]]).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends)], np.uint64)
    n = len(h)
    counts = np.bincount((h.view(np.uint8).reshape(n, 8) + BYTE_AT).ravel(), minlength=2048).reshape(8, 256) @ BITS_OF_BYTE
    return int.from_bytes(np.packbits((2 * counts > n).ravel(), bitorder="little").tobytes(), "little")


@F.pandas_udf(T.LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    """As signed longs."""
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every row."""
    return common.small_batches(docs).select(F.col(id_col).alias("id"), fingerprint_of(F.col(text_col)).alias("fp"))


def references() -> np.ndarray:
    return np.random.default_rng(64).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def forest(fps: np.ndarray, radius: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """(fingerprint, smallest one that it reaches within ``fps``) where these differ. ``fps`` are different and sorted."""
    n = len(fps)
    out = []
    if n < 2:
        return out
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    if n <= SMALL:
        near = np.ones((n, n), bool)
        for p in range(0, len(pivots), 8):
            near &= np.abs(table[:, None, p : p + 8] - table[None, :, p : p + 8]).max(axis=2) <= radius
        i, j = np.nonzero(np.triu(near, 1))
        close = np.bitwise_count(fps[i] ^ fps[j]) <= radius
        links: dict[int, list[int]] = {}
        for a, b in zip(i[close].tolist(), j[close].tolist()):
            links.setdefault(a, []).append(b)
            links.setdefault(b, []).append(a)
        done: set[int] = set()
        for root in sorted(links):
            if root not in done:
                stack = [root]
                done.add(root)
                while stack:
                    for x in links[stack.pop()]:
                        if x not in done:
                            done.add(x)
                            stack.append(x)
                            out.append((int(fps[x]), int(fps[root])))
        return out
    columns = np.ascontiguousarray(table.T)
    left = np.arange(n)  # not reached yet, in order
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            x = queue.pop()
            at = left
            for column in columns:
                at = at[np.abs(column[at] - column[x]) <= radius]
                if len(at) < 16:
                    break
            at = at[np.bitwise_count(fps[at] ^ fps[x]) <= radius]
            if len(at):
                queue += at.tolist()
                out += [(int(f), int(fps[root])) for f in fps[at]]
                left = np.setdiff1d(left, at, assume_unique=True)
    return out


def agreeing(n: int, radius: int) -> list[tuple[tuple[int, int], ...]]:
    """For each key, its blocks of bits (from, to): one key for each choice of as many blocks as must agree, for n fingerprints."""
    for s in range(1, 65 - radius):
        cuts = [64 * i // (radius + s) for i in range(radius + s + 1)]
        blocks = list(zip(cuts, cuts[1:]))
        keys = list(combinations(blocks, s))
        if n <= GROUP << min(sum(b - a for a, b in key) for key in keys) or comb(radius + s + 1, s + 1) > MOST_KEYS:
            return keys


def links(fps: DataFrame, n: int, radius: int = 4) -> DataFrame:
    """(a, b): links that connect what lies within the radius, a forest for each group of a key. ``n``: how many there are, or about."""
    keys = agreeing(n, radius)

    def value(blocks: tuple[tuple[int, int], ...]) -> Column:
        out = F.lit(0).cast("long")
        for a, b in blocks:
            out = F.shiftleft(out, b - a).bitwiseOR(F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)))
        return out

    rows = fps.select("fp", F.posexplode(F.array(*[value(k) for k in keys])).alias("i", "value")).select((F.col("value") * len(keys) + F.col("i")).alias("key"), "fp")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    pivots = references()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # of the group that may go on in the next batch
        open_key = None

        def close() -> list[tuple[int, int]]:
            return forest(np.sort(np.concatenate(held).view(np.uint64)), radius, pivots) if sum(map(len, held)) > 1 else []

        def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            a = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_pydict({"a": a[:, 0], "b": a[:, 1]})

        for batch in batches:
            found: list[tuple[int, int]] = []
            key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
            ends = np.append(starts[1:], len(key))
            # a fingerprint alone in its group has no link; the first and the last group may go on in other batches
            for i in np.unique(np.concatenate([np.flatnonzero(ends - starts > 1), [0, len(starts) - 1]])).tolist():
                k = int(key[starts[i]])
                if k != open_key:
                    if held:
                        found += close()
                    held, open_key = [], k
                held.append(fp[starts[i] : ends[i]])
            yield batch_of(found)
        if held:
            yield batch_of(close())

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


def groups(prints: DataFrame, radius: int = 4) -> DataFrame:
    """(fp, component_id): the smallest id of the component, for every different fingerprint of ``prints`` (id, fp)."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")), "fps")
    labels = components(links(distinct.select("fp"), distinct.count(), radius))
    labelled = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return labelled.join(smallest, "label").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """(id, fp, component_id) for every row."""
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    return prints.join(groups(prints, radius), "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row of each component: that of the smallest id, the first met of several."""
    rows = common.small_batches(docs).select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), fingerprint_of(F.col(text_col)).alias("fp"), F.monotonically_increasing_id().alias("uid"))
    held = materialize(rows, "fingerprints")  # also pins the uids
    of = groups(held.select("id", "fp"), radius)
    own = F.when(F.col("component_id").isNull(), F.col("fp"))  # groups without any id
    best = held.select("uid", "id", "fp").join(of, "fp").groupBy("component_id", own.alias("own")).agg(F.min(F.struct(F.col("id").isNull(), "id", "uid")).alias("best"))
    return held.join(best.select(F.col("best.uid").alias("uid")), "uid", "left_semi").select("row.*")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
