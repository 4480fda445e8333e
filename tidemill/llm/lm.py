"""Scoring texts with a hierarchical Pitman-Yor language model over words.

Restaurants. Each word has a restaurant for what follows it: its customers are the tokens after that word, their
dishes the words they are (a text starts after its own end). All of these share one parent, the restaurant of single
words, whose customers are their tables; its own new tables choose evenly among the known words and one event,
unknown, for all words that no training document has. So for each context the known words and unknown sum to 1:

    P(w | u) = (c(u,w) - d2 t(u,w) + (theta + d2 T(u)) P(w)) / (theta + c(u))
    P(w)     = (c1(w)  - d1 t1(w)  + (theta + d1 T1) / (V + 1)) / (theta + C1),    c1(w) = sum of t(u,w) over u

Seating is sampled by Gibbs. Given all others, a dish of c customers sits at t tables with a probability that is
proportional to the number of blocks of c customers in a Pitman-Yor process without strength, K(c) = t, times

    product over j from 1 to t - 1 of (theta / d + T' + j) / j * P'(w, j)

where T' and P' leave out the dish's own tables, P'(w, j) is the parent's probability once j + 1 of them are back.
``draw`` takes t from this conditional: exactly for up to EXACT customers, beyond on a grid of t, with K(c) scaled from
the next smaller c that is tabulated (K(c) / c^d has a limit). A dish with one customer has one table. Dishes are drawn in
parallel, each against the state of the sweep before. Discounts come from the dishes seen once and twice
(Kneser-Ney's estimate). After ``burn_in`` sweeps, ``samples`` states are kept, and a probability is the average of the
predictive probabilities in these very states. Nothing is pruned: every word and every pair of the corpus counts.

Scale. The corpus is cut into chunks of a bounded number of tokens. Words are known by a 64-bit hash (two in 10^10
words collide with a probability near 1, two in 10^8 with 3 in 10^4; they would count as one word). Parts of words (by hash) and parts of
pairs (by the hash of both, so no context is one task's) are of a size that doesn't grow with the corpus; between
chunks, parts of pairs and parts of words go packed arrays only. Pairs seen once never move again. The driver holds a
few sums. Each step is a table in the shared folder, and those of past sweeps are deleted.

Defined cases: a null text is an empty one, whose only token is the end; an empty table gives an empty result; rows
with a null id learn; repeated rows each count; other columns are ignored; without training rows every
token is unknown and has probability 1.
"""

from __future__ import annotations

import gc
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import discard, materialize
from . import common

CHUNK_TOKENS = 4_000_000
#: Tokens of the corpus for each part of pairs, and words of all chunks for each part of words.
PAIR_PART, WORD_PART = 3 << 20, 1 << 18
STRENGTH = 1.0
#: Customers up to which the number of tables is drawn exactly, and of the largest row of blocks that is tabulated.
EXACT, TABLE = 64, 4096

#: What parts send each other: ``key`` is the receiver, x and y are numbers to be summed over all senders.
PACKET = T.StructType([T.StructField("kind", T.StringType()), T.StructField("key", T.LongType()), T.StructField("sender", T.LongType()), T.StructField("data", T.ArrayType(T.BinaryType())), T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])
Packet = tuple[str, int, int, list[bytes], int, int]


# --- arrays in few bytes ---


def pack(a: np.ndarray) -> bytes:
    """Numbers that aren't negative, in as few bytes each as the largest needs, or float32; compressed byte by byte place."""
    a = np.asarray(a)
    if a.dtype.kind == "f":
        a = a.astype("<f4")
    else:
        a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return a.dtype.str.encode() + len(a).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    kind, n = np.dtype(b[:3].decode()), int.from_bytes(b[3:11], "little")
    planes = pa.decompress(b[11:], n * kind.itemsize, "zstd", asbytes=True)
    a = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()
    return a if kind.kind == "f" else a.astype(np.int64, copy=False)


def pack_sorted(h: np.ndarray) -> bytes:
    return pack(np.diff(h, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.int64).view(np.uint64)


# --- the number of tables of a dish ---


@dataclass(frozen=True)
class Blocks:
    """log P(K(c) = t), t from 1, without strength: for all c up to EXACT, and from there to TABLE in steps of a sixteenth."""

    discount: float
    rows: dict[int, np.ndarray]

    @staticmethod
    def of(discount: float) -> Blocks:
        row, rows, due = np.zeros(1), {1: np.zeros(1)}, EXACT
        with np.errstate(divide="ignore"):
            for n in range(1, TABLE):
                t = np.arange(1, n + 1)
                stay, more = row + np.log((n - discount * t) / n), row + np.log(discount * t / n)
                row = np.append(stay, -np.inf)
                row[1:] = np.logaddexp(row[1:], more)
                if n < EXACT or n + 1 == due:
                    rows[n + 1] = row
                    due = min(max(due, n + 1) * 17 // 16, TABLE) if n + 1 == due else due
        return Blocks(discount, rows)


def log_rise(a: np.ndarray, m: np.ndarray) -> np.ndarray:
    """log of a (a + 1) ... (a + m - 1) for any real m, without cancellation where a is large: Stirling's series from a + 6."""
    ratio = 1.0
    for i in range(6):
        ratio = ratio * ((a + m + i) / (a + i))
    x, y = a + 6.0, a + m + 6.0
    more = lambda z: (1 / 12 - (1 / 360 - 1 / (1260 * z * z)) / (z * z)) / z
    return (x - 0.5) * np.log1p(m / x) + m * np.log(y) - m + more(y) - more(x) - np.log(ratio)


def draw(blocks: Blocks, c: np.ndarray, own: np.ndarray, base: np.ndarray, whole: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with c customers; ``own`` is theta / d + T', and P'(w, j) is (base + j) / (whole + j)."""
    tables = np.ones(len(c), np.int64)
    order = np.argsort(c, kind="stable")
    ends = np.searchsorted(c[order], np.arange(EXACT + 2))
    for m in range(2, EXACT + 1):
        for a in range(ends[m], ends[m + 1], 1 << 16):
            at = order[a : min(a + (1 << 16), ends[m + 1])]
            j = np.arange(1.0, m)
            A, B, D = own[at, None], base[at, None], whole[at, None]
            log_w = np.zeros((len(at), m))
            np.cumsum(np.log((A + j) * (B + j) / (j * (D + j))), axis=1, out=log_w[:, 1:])
            log_w += blocks.rows[m]
            w = np.cumsum(np.exp(log_w - log_w.max(axis=1, keepdims=True)), axis=1)
            tables[at] = 1 + (w < rng.random(len(at))[:, None] * w[:, -1:]).sum(axis=1)
    for a in range(ends[EXACT + 1], len(c), 1 << 12):
        at = order[a : a + (1 << 12)]
        tables[at] = draw_large(blocks, c[at], own[at, None], base[at, None], whole[at, None], rng)
    return tables


def draw_large(blocks: Blocks, c: np.ndarray, A: np.ndarray, B: np.ndarray, D: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``c`` ascending. The grid has every t up to EXACT and then steps of a sixteenth, weighed at their middle."""
    grid = [*range(1, EXACT + 1)]
    while grid[-1] < c[-1]:
        grid.append(grid[-1] + max(1, grid[-1] // 16))
    first = np.array(grid, float)
    width = np.clip(np.append(first[1:], first[-1] + 1)[None, :], None, c[:, None] + 1.0) - first
    t = first + (np.maximum(width, 1) - 1) / 2
    log_w = log_rise(A + 1, t - 1) - log_rise(1.0, t - 1) + log_rise(B + 1, t - 1) - log_rise(D + 1, t - 1)
    steps = np.array(sorted(blocks.rows))
    held = steps[np.searchsorted(steps, c, "right") - 1]
    for h in np.unique(held):
        i = np.flatnonzero(held == h)
        row = blocks.rows[int(h)]
        log_w[i] += np.interp(np.clip(t[i] * ((h / c[i]) ** blocks.discount)[:, None], 1, h), np.arange(1, h + 1), row)
    log_w = np.where(width > 0, log_w + np.log(np.maximum(width, 1)), -np.inf)
    w = np.cumsum(np.exp(log_w - log_w.max(axis=1, keepdims=True)), axis=1)
    k = (w < rng.random(len(c))[:, None] * w[:, -1:]).sum(axis=1)
    return (first[k] + np.floor(rng.random(len(c)) * width[np.arange(len(c)), k])).astype(np.int64)


def discount_of(once: int, twice: int) -> float:
    return float(np.clip(once / (once + 2 * twice), 0.05, 0.95)) if once + twice else 0.5


# --- chunks ---


def chunks(docs: DataFrame, id_col: str, text_col: str, held_out: Column) -> DataFrame:
    """Documents as numbers of their chunk's words: (chunk, ids, held, ends, tokens, words (hashes), counts, n_tokens, n_words)."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("held", T.ArrayType(T.BooleanType())),
            T.StructField("ends", T.BinaryType()),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_words", T.LongType()),
        ]
    )
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 30
        ids, held, ends, tokens, words = [], [], [], array("I"), defaultdict(count().__next__)

        def row() -> pa.RecordBatch:
            t = np.frombuffer(tokens, np.uint32)
            learns = np.repeat(~np.array(held, bool), np.diff(ends, prepend=0))
            counts = np.bincount(t[learns], minlength=len(words))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
            values = [chunk, ids, held, pack(np.array(ends)), pack(t), pack(hashes), pack(counts), len(t), len(words)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, target)], schema=target)

        for batch in batches:
            for doc, out, text in zip(*[c.to_pylist() for c in batch.columns]):
                tokens.extend(map(words.__getitem__, (text or "").encode("utf-8", "surrogatepass").lower().split()))
                tokens.append(words[b""])  # the end
                ids.append(doc)
                held.append(bool(out))
                ends.append(len(tokens))
                if len(tokens) >= CHUNK_TOKENS:
                    yield row()
                    chunk += 1
                    ids, held, ends, tokens, words = [], [], [], array("I"), defaultdict(count().__next__)
        if ids:
            yield row()

    return common.small_batches(docs).select(F.col(id_col), held_out.alias("held"), F.col(text_col)).mapInArrow(run, schema)


@dataclass(frozen=True)
class Parts:
    """How many parts of words and of pairs there are."""

    words: int
    pairs: int

    def of_words(self, hashes: np.ndarray) -> list[np.ndarray]:
        """For each part, the places of its hashes, in their order."""
        part = (hashes % np.uint64(self.words)).astype(np.int64)
        order = np.lexsort((hashes, part))
        return np.split(order, np.searchsorted(part[order], np.arange(1, self.words)))

    def of_pairs(self, before: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
        mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (word * np.uint64(0xC2B2AE3D27D4EB4F))
        part = ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(self.pairs)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        return np.split(order, np.searchsorted(part[order], np.arange(1, self.pairs)))


@dataclass
class Chunk:
    """A chunk's words by hash, and its pairs by the hashes of their words."""

    hashes: np.ndarray
    counts: np.ndarray
    ends: np.ndarray
    before: np.ndarray
    word: np.ndarray
    pair_of_token: np.ndarray

    @staticmethod
    def of(ends: bytes, tokens: bytes, words: bytes, counts: bytes) -> Chunk:
        hashes = unpack(words).view(np.uint64)
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ends, token = unpack(ends), rank[unpack(tokens)]
        before = np.roll(token, 1)
        before[np.append(0, ends[:-1])] = token[ends[-1] - 1]  # a text starts after an end, which is its last token
        pairs, at = np.unique(before * len(hashes) + token, return_inverse=True)
        return Chunk(hashes[order], unpack(counts)[order], ends, pairs // len(hashes), pairs % len(hashes), at)


def word_packets(kind: str, chunk: int, hashes: np.ndarray, counts: np.ndarray | None, parts: Parts) -> Iterator[Packet]:
    for q, at in enumerate(parts.of_words(hashes)):
        if len(at):
            yield kind, q, chunk, [pack_sorted(hashes[at])] + ([pack(counts[at])] if counts is not None else []), 0, 0


def pair_packets(chunk: int, c: Chunk, held: np.ndarray, parts: Parts) -> Iterator[Packet]:
    learns = np.repeat(~held, np.diff(c.ends, prepend=0))
    n = np.bincount(c.pair_of_token[learns], minlength=len(c.word))
    for r, at in enumerate(parts.of_pairs(c.hashes[c.before], c.hashes[c.word])):
        if len(at):
            before, runs = np.unique(c.before[at], return_counts=True)
            word, places = np.unique(c.word[at], return_inverse=True)
            yield "chunk", r, chunk, [pack_sorted(c.hashes[before]), pack(runs), pack_sorted(c.hashes[word]), pack(places), pack(n[at])], 0, 0


# --- parts: each function takes a part's packets and gives those that it sends ---


def count_words(q: int, packets: list[Packet]) -> Iterator[Packet]:
    """The training words of a part, and how often each is seen; x: words, y: tokens."""
    h, n = [unpack_sorted(p[3][0]) for p in packets], [unpack(p[3][1]) for p in packets]
    words, at = np.unique(np.concatenate(h), return_inverse=True)
    c = np.bincount(at, weights=np.concatenate(n)).astype(np.int64)
    yield "words", q, q, [pack_sorted(words[c > 0]), pack(c[c > 0])], int((c > 0).sum()), int(c.sum())


def spread(kind: str, r: int, hashes: np.ndarray, parts: Parts, *values: np.ndarray) -> Iterator[Packet]:
    """To each part of words what concerns its words."""
    for q, at in enumerate(parts.of_words(hashes)):
        if len(at):
            yield kind, q, r, [pack_sorted(hashes[at]), *[pack(v[at]) for v in values]], 0, 0


def count_pairs(r: int, packets: list[Packet], parts: Parts) -> Iterator[Packet]:
    """Pairs of all chunks as one; x, y: pairs seen once, twice. To the parts of words: how many pairs each word starts and ends."""
    opened = [[unpack_sorted(d[0]), unpack(d[1]), unpack_sorted(d[2]), unpack(d[3]), unpack(d[4])] for *_, d, _, _ in packets]
    names = np.unique(np.concatenate([x for o in opened for x in (o[0], o[2])]))
    keys = [np.repeat(np.searchsorted(names, b), runs) << 32 | np.searchsorted(names, w)[at] for b, runs, w, at, _ in opened]
    pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
    c = np.bincount(at, weights=np.concatenate([o[4] for o in opened])).astype(np.int64)
    # of each chunk's pairs: 0 for none in training, 1 for once, else 2 and the place among those seen more often
    many = np.flatnonzero(c > 1)
    code = np.minimum(c, 1)
    code[many] = 2 + np.arange(len(many))
    for p, part in zip(packets, np.split(code[at], np.cumsum([len(k) for k in keys])[:-1])):
        yield "codes", r, p[2], [pack(part)], 0, 0
    known = pairs[c > 0]
    starts, ends = np.bincount(known >> 32, minlength=len(names)), np.bincount(known & 0xFFFFFFFF, minlength=len(names))
    seen = np.flatnonzero(starts + ends)
    yield from spread("base", r, names[seen], parts, starts[seen], ends[seen])
    before, word = pairs[many] >> 32, pairs[many] & 0xFFFFFFFF
    used, place = np.unique(np.concatenate([before, word]), return_inverse=True)
    before, word = place[: len(many)], place[len(many) :]
    zero = np.zeros(len(used), np.int64)
    yield "pairs", r, r, [pack_sorted(names[used]), pack(np.bincount(before, minlength=len(used))), pack(word), pack(c[many])], int((c == 1).sum()), int((c == 2).sum())
    yield "tables", r, r, [pack(np.zeros(len(many), np.int64)), pack(np.zeros(len(many), np.int64))], 0, 0
    yield from spread("more", r, names[used], parts, zero, zero)


@dataclass(frozen=True)
class State:
    """Sums of the whole model, and what draws numbers of tables."""

    words: int
    customers: int
    tables: int
    single: Blocks
    pair: Blocks


def gather_words(q: int, packets: list[Packet]) -> Iterator[Packet]:
    """The first state of a part's words, one table for each pair: words, c, pairs started, pairs ended, tables. x, y: words that end one pair, two."""
    held = next(p[3] for p in packets if p[0] == "words")
    names = unpack_sorted(held[0])
    starts, ends = np.zeros((2, len(names)), np.int64)
    for p in packets:
        if p[0] == "base":
            at = np.searchsorted(names, unpack_sorted(p[3][0]))
            starts[at] += unpack(p[3][1])
            ends[at] += unpack(p[3][2])
    yield "words", q, q, [*held, pack(starts), pack(ends), pack(np.minimum(ends, 1))], int((ends == 1).sum()), int((ends == 2).sum())


def seat_words(q: int, packets: list[Packet], state: State, keep: bool, seed: int) -> Iterator[Packet]:
    """A sweep over the restaurant of single words; x: its tables, y: its customers. After the state come the samples: T(u), c1, t1 of each."""
    held = next(p[3] for p in packets if p[0] == "words")
    names, _, starts, ends, tables = unpack_sorted(held[0]), *map(unpack, held[1:5])
    follow, customers = starts.copy(), ends.copy()
    asked = []
    for p in packets:
        if p[0] == "more":
            at = np.searchsorted(names, unpack_sorted(p[3][0]))
            follow[at] += unpack(p[3][1])
            customers[at] += unpack(p[3][2])
            asked.append((p[2], at))
    # the base is even: (base + j) / (whole + j) with both so large that j doesn't count
    even = np.full(len(names), 1e18)
    tables = draw(state.single, customers, STRENGTH / state.single.discount + state.tables - tables, even / (state.words + 1), even, np.random.default_rng([seed, 0, q]))
    samples = [*held[5:], *([pack(follow), pack(customers), pack(tables)] if keep else [])]
    yield "words", q, q, [*held[:4], pack(tables), *samples], int(tables.sum()), int(customers.sum())
    for r, at in asked:
        yield "reply", r, q, [pack(follow[at]), pack(customers[at]), pack(tables[at])], 0, 0


def seat_pairs(r: int, packets: list[Packet], state: State, parts: Parts, keep: bool, seed: int) -> Iterator[Packet]:
    """A sweep over the pairs of a part. Tables are kept as those beyond the first: now, and summed over the samples."""
    held = next(p[3] for p in packets if p[0] == "pairs")
    names, word, c = unpack_sorted(held[0]), unpack(held[2]), unpack(held[3])
    before = np.repeat(np.arange(len(names)), unpack(held[1]))
    now, total = map(unpack, next(p[3] for p in packets if p[0] == "tables"))
    follow, customers, tables = np.zeros((3, len(names)), np.int64)
    of_part = parts.of_words(names)
    for p in packets:
        if p[0] == "reply":
            at = of_part[p[2]]
            follow[at], customers[at], tables[at] = map(unpack, p[3])
    t = now + 1
    others = customers[word] - t
    own = STRENGTH / state.pair.discount + follow[before] - t
    # the first of the own tables opens one above if no other child has the dish
    above = np.maximum(np.minimum(tables[word], others), 1)
    base = others - state.single.discount * above + (STRENGTH + state.single.discount * state.tables) / (state.words + 1)
    now = draw(state.pair, c, own, base, STRENGTH + state.customers - t.astype(float), np.random.default_rng([seed, 1, r])) - 1
    yield "tables", r, r, [pack(now), pack(total + now if keep else total)], 0, 0
    sums = [np.bincount(x, weights=now, minlength=len(names)).astype(np.int64) for x in (before, word)]
    yield from spread("more", r, names, parts, *sums)


def answer_pairs(r: int, packets: list[Packet], discount: float, samples: int) -> Iterator[Packet]:
    """For each chunk, c - d t of its pairs: codes 0, 1 and 2, and the values of the latter."""
    c = unpack(next(p[3] for p in packets if p[0] == "pairs")[3])
    total = unpack(next(p[3] for p in packets if p[0] == "tables")[1])
    left = c - discount * (1 + total / max(samples, 1))
    for p in packets:
        if p[0] == "codes":
            code = unpack(p[3][0])
            yield "pair", p[2], r, [pack(np.minimum(code, 2)), pack(left[code[code > 1] - 2])], 0, 0


def answer_words(q: int, packets: list[Packet]) -> Iterator[Packet]:
    """For each chunk, c and the samples' numbers of its words; 0 for unknown words."""
    held = next((p[3] for p in packets if p[0] == "words"), None)
    names, columns = (unpack_sorted(held[0]), [unpack(x) for x in [held[1], *held[5:]]]) if held else (np.empty(0, np.uint64), [])
    for p in packets:
        if p[0] == "ask":
            h = unpack_sorted(p[3][0])
            at = np.minimum(np.searchsorted(names, h), max(len(names) - 1, 0))
            known = names[at] == h if len(names) else np.zeros(len(h), bool)
            yield "word", p[2], q, [pack(np.where(known, x[at], 0)) if len(names) else pack(np.zeros(len(h), np.int64)) for x in columns], 0, 0


def probabilities(c: Chunk, packets: list[Packet], state: State, sums: list[tuple[int, int]], parts: Parts) -> tuple[np.ndarray, np.ndarray]:
    """Counts of a chunk's words, and the average predictive probability of each of its pairs. ``sums``: C1 and T1 of each sample."""
    n_columns = max((len(p[3]) for p in packets if p[0] == "word"), default=1)
    columns = np.zeros((n_columns, len(c.hashes)), np.int64)
    left = np.zeros(len(c.word))
    of_words, of_pairs = parts.of_words(c.hashes), parts.of_pairs(c.hashes[c.before], c.hashes[c.word])
    for kind, _, sender, data, _, _ in packets:
        if kind == "word":
            for i, x in enumerate(data):
                columns[i, of_words[sender]] = unpack(x)
        else:
            code = unpack(data[0])
            value = np.where(code == 1, 1 - state.pair.discount, 0.0)
            value[code == 2] = unpack(data[1])
            left[of_pairs[sender]] = value
    counts, samples = columns[0], columns[1:].reshape(-1, 3, len(c.hashes))
    d1, d2 = state.single.discount, state.pair.discount
    up = np.zeros(len(c.word))
    for (follow, customers, tables), (all_customers, all_tables) in zip(samples, sums):
        p = (customers - d1 * tables + (STRENGTH + d1 * all_tables) / (state.words + 1)) / (STRENGTH + all_customers)
        up += (STRENGTH + d2 * follow[c.before]) * p[c.word]
    up = up / len(samples) if len(samples) else np.full(len(c.word), STRENGTH / (state.words + 1))
    return counts, (left + up) / (STRENGTH + counts[c.before])


# --- the steps in Spark ---


def send(cut: DataFrame, columns: list[str], make) -> DataFrame:
    """Packets that ``make`` gives for each chunk."""
    target = to_arrow_schema(PACKET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield rows_of(make(*[c[i].as_py() for c in batch.columns]), target)

    return common.small_batches(cut).select(*columns).mapInArrow(run, PACKET)


def rows_of(packets: Iterator[Packet], target: pa.Schema) -> pa.RecordBatch:
    rows = list(packets)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(target)], schema=target)


def packets_of(table: pa.Table) -> list[Packet]:
    return list(zip(*[table.column(c).to_pylist() for c in PACKET.names]))


def step(packets: DataFrame, parts: int, fn) -> DataFrame:
    """What the parts send when each of them, by its key, has its packets."""
    target = to_arrow_schema(PACKET)

    def run(table: pa.Table) -> pa.Table:
        held = packets_of(table)
        return pa.Table.from_batches([rows_of(fn(held[0][1], held), target)])

    return packets.repartition(parts, "key").groupBy("key").applyInArrow(run, PACKET)


class Steps:
    """Tables of packets by kind. A kind that comes again takes the place of the one before, whose table is deleted once none of its kinds is held."""

    def __init__(self) -> None:
        self.tables: dict[str, DataFrame] = {}

    def add(self, packets: DataFrame, name: str, *kinds: str) -> None:
        table = materialize(packets, f"lm-{name}", by="kind")
        before = {id(t): t for t in (self.tables.get(k) for k in kinds) if t is not None}
        self.tables |= dict.fromkeys(kinds, table)
        for t in before.values():
            if not any(t is x for x in self.tables.values()):
                discard(t)
        del packets, before
        # the driver forgets the step, so Spark deletes its shuffle files
        gc.collect()
        table.sparkSession._jvm.System.gc()

    def of(self, *kinds: str) -> DataFrame:
        frames = [self.tables[k].where(F.col("kind") == k).select(*PACKET.names) for k in kinds]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def sums(self, kind: str) -> tuple[int, int]:
        r = self.of(kind).agg(F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
        return r[0], r[1]

def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", burn_in: int = 2, samples: int = 3, seed: int = 11) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row; learns from rows that aren't held out."""
    cut = materialize(chunks(docs, id_col, text_col, F.coalesce(held_out, F.lit(False))), "lm-chunks")
    tokens, words = cut.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    parts = Parts(-(-words // WORD_PART) or 1, -(-tokens // PAIR_PART) or 1)
    steps, packed = Steps(), ["chunk", "ends", "tokens", "words", "counts"]
    opened = lambda chunk, words, counts: word_packets("found", chunk, *sorted_words(words, counts), parts)
    steps.add(step(send(cut, ["chunk", "words", "counts"], opened), parts.words, count_words), "words", "words")
    paired = lambda chunk, held, *rest: pair_packets(chunk, Chunk.of(*rest), np.array(held, bool), parts)
    steps.add(step(send(cut, ["chunk", "held", *packed[1:]], paired), parts.pairs, lambda r, p: count_pairs(r, p, parts)), "pairs", "codes", "base", "pairs", "tables", "more")
    (kinds, total), (once, twice) = steps.sums("words"), steps.sums("pairs")
    steps.add(step(steps.of("words", "base"), parts.words, gather_words), "words", "words")
    single_once, single_twice = steps.sums("words")
    state = State(kinds, 0, kinds, Blocks.of(discount_of(single_once, single_twice)), Blocks.of(discount_of(once, twice)))
    sums: list[tuple[int, int]] = []

    def sweep_words(keep: bool, at: int) -> None:
        nonlocal state
        now = state
        steps.add(step(steps.of("words", "more"), parts.words, lambda q, p: seat_words(q, p, now, keep, at)), "words", "words", "reply")
        tables, customers = steps.sums("words")
        state = State(now.words, customers, tables, now.single, now.pair)

    if total:
        sweep_words(False, seed)
    for i in range(burn_in + samples if total else 0):
        now, keep = state, i >= burn_in
        steps.add(step(steps.of("pairs", "tables", "reply"), parts.pairs, lambda r, p: seat_pairs(r, p, now, parts, keep, seed + i)), "tables", "tables", "more")
        sweep_words(keep, seed + 1 + i)
        sums += [(state.customers, state.tables)] if keep else []

    asked = lambda chunk, words, counts: word_packets("ask", chunk, sorted_words(words, counts)[0], None, parts)
    of_pairs = step(steps.of("pairs", "tables", "codes"), parts.pairs, lambda r, p: answer_pairs(r, p, state.pair.discount, len(sums)))
    of_words = step(steps.of("words").unionByName(send(cut, ["chunk", "words", "counts"], asked)), parts.words, answer_words)
    kind = docs.schema[id_col].dataType
    longs = ("n_tokens", "n_known")
    schema = T.StructType([T.StructField("id", kind), T.StructField("held_out", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    target = to_arrow_schema(schema)
    last, base_of = state, np.log10(total + kinds + 1)

    def apply(rows: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = rows.to_pylist()
        c = Chunk.of(*[row[k] for k in packed[1:]])
        counts, p = probabilities(c, packets_of(answers), last, sums, parts)
        n = counts[c.word]
        starts = np.append(0, c.ends[:-1])
        add = lambda x: np.add.reduceat(x[c.pair_of_token], starts)
        columns = [row["ids"], row["held"], c.ends - starts, add((n > 0).astype(np.int64)), add(np.log10(n + 1.0) - base_of), add(np.log10(p))]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, target)], schema=target)

    scored = cut.select("ids", "held", *packed).groupBy("chunk").cogroup(of_pairs.unionByName(of_words).groupBy("key")).applyInArrow(apply, schema)
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))


def sorted_words(words: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    hashes = unpack(words).view(np.uint64)
    order = np.argsort(hashes, kind="stable")
    return hashes[order], unpack(counts)[order]


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, tokens, perplexity) of the model over the rows of ``score``."""
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def op5_pitman_yor(spark, sf_dir: str) -> DataFrame:
    found = score(common.table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
    return found.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
