"""5: the language model, against slow forms of all its parts."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemill.llm import lm

DOCS = "doc_id long, text string"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def test_counts_and_base(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = {r["id"]: r for r in lm.score(docs, out).collect()}
    texts = {r["doc_id"]: words(lower(r["text"])) + ["\0"] for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    c = Counter(w for d, t in texts.items() if not held[d] for w in t)
    n, v = sum(c.values()), len(c)
    for d, t in texts.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    for part in (True, False):  # better than the base on what it has learnt and on what it hasn't
        rows = [r for r in got.values() if r["held_out"] == part]
        assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_contexts_sum_to_one(spark, monkeypatch):
    """Through ``score``, over several chunks and parts: texts give the products of P(next | word) around loops. That is the
    matrix of these up to a scaling of its rows and columns by each other's inverse, which leaves its largest eigenvalue: 1."""
    monkeypatch.setattr(lm, "WORD_PART", 4)
    monkeypatch.setattr(lm, "PAIR_PART", 16)
    rng = np.random.default_rng(4)
    names = ["a", "b", "c", "d", "e", "new"]
    learnt = [(-1 - i, " ".join(rng.choice(names[:5], rng.integers(0, 9), p=[0.4, 0.3, 0.15, 0.1, 0.05]))) for i in range(60)]
    asked = [(), *[(x,) for x in names], *itertools.product(names, names)]
    docs = spark.createDataFrame([*learnt, *[(i, " ".join(x)) for i, x in enumerate(asked)]], DOCS).repartition(3)
    got = {r["id"]: r["score"] for r in lm.score(docs, F.col("doc_id") >= 0).collect()}
    score = {x: got[i] for i, x in enumerate(asked)}
    n = len(names)
    m = np.zeros((n + 1, n + 1))  # the last is the end; scaled so that from the end to any word is 1
    m[n, n] = 10 ** score[()]
    for i, x in enumerate(names):
        m[n, i], m[i, n] = 1, 10 ** score[x,]
        for j, y in enumerate(names):
            m[i, j] = 10 ** (score[x, y] - score[y,])
    assert abs(max(abs(np.linalg.eigvals(m))) - 1) < 1e-6


def exact(c, d, own, base, whole):
    rows = {(1, 1): 1.0}
    for n in range(1, c):
        for t in range(1, n + 2):
            rows[n + 1, t] = rows.get((n, t - 1), 0.0) + (n - d * t) * rows.get((n, t), 0.0)
    w, factor = [], 1.0
    for t in range(1, c + 1):
        w.append(rows[c, t] * factor)
        factor *= d * (own + t) * (base + t) / (whole + t)
    return np.array(w) / sum(w)


@pytest.mark.parametrize("c, d, own, base, whole", [(2, 0.8, 30.0, 0.4, 50.0), (5, 0.5, 3.0, 2.0, 9.0), (40, 0.7, 200.0, 1.5, 60.0), (64, 0.3, 8.0, 20.0, 40.0), (100, 0.7, 200.0, 15.0, 600.0), (150, 0.6, 30.0, 8.0, 400.0), (120, 0.9, 900.0, 50.0, 2000.0), (150, 0.7, 4000.0, 300.0, 20000.0), (90, 0.5, 60.0, 1e17, 1e18)])
def test_tables_of_a_dish(c, d, own, base, whole):
    """Against sums over all seatings; beyond EXACT customers within some hundredths. (A restaurant's tables are customers above: whole > own.)"""
    want = exact(c, d, own, base, whole)
    n, rng = 40_000, np.random.default_rng(2)
    got = lm.draw(lm.Blocks.of(d), np.full(n, c), np.full(n, own), np.full(n, base), np.full(n, whole), rng)
    t = np.arange(1, c + 1)
    mean, spread = (want * t).sum(), math.sqrt((want * t * t).sum() - (want * t).sum() ** 2)
    near = 5 * spread / math.sqrt(n) + (0.04 * mean if c > lm.EXACT else 0)
    assert abs(got.mean() - mean) < near and abs(got.std() - spread) < 0.05 * spread + 0.02
    if c <= lm.EXACT:
        assert np.abs(np.bincount(got, minlength=c + 1)[1:] / n - want).max() < 0.012


PAIRS = (("a", "a"), ("b", "a"), ("\0", "b"), ("a", "c"))


class Slow:
    """One customer at a time is taken out and seated again: tables have sizes, and every table is a customer above."""

    def __init__(self, texts, d1, d2, seed):
        self.rng = np.random.default_rng(seed)
        self.d = {0: d1, 1: d2}
        self.sizes = {0: defaultdict(list), 1: defaultdict(list)}  # of level and (context, word)
        self.words = {w for t in texts for w in t}
        self.customers = [(u, w) for t in texts for u, w in zip(["\0", *t], t)]
        self.n, self.t = Counter(), Counter()
        for u, w in self.customers:
            self.seat(1, u, w)

    def probability(self, level, u, w):
        if level < 0:
            return 1 / (len(self.words) + 1)
        d, key = self.d[level], (level, u)
        own = sum(self.sizes[level][u, w]) - d * len(self.sizes[level][u, w])
        return (own + (1 + d * self.t[key]) * self.probability(level - 1, None, w)) / (1 + self.n[key])

    def seat(self, level, u, w):
        if level < 0:
            return
        s, d, key = self.sizes[level][u, w], self.d[level], (level, u)
        weights = [x - d for x in s] + [(1 + d * self.t[key]) * self.probability(level - 1, None, w)]
        k = self.rng.choice(len(weights), p=np.array(weights) / sum(weights))
        self.n[key] += 1
        if k == len(s):
            s.append(1)
            self.t[key] += 1
            self.seat(level - 1, None, w)
        else:
            s[k] += 1

    def leave(self, level, u, w):
        if level < 0:
            return
        s, key = self.sizes[level][u, w], (level, u)
        k = self.rng.choice(len(s), p=np.array(s) / sum(s))
        s[k] -= 1
        self.n[key] -= 1
        if not s[k]:
            s.pop(k)
            self.t[key] -= 1
            self.leave(level - 1, None, w)

    def sweep(self):
        for u, w in self.customers:
            self.leave(1, u, w)
            self.seat(1, u, w)
            # a table of the level above may move by itself
            self.leave(0, None, w)
            self.seat(0, None, w)


def test_sweeps_agree_with_one_by_one():
    rng = np.random.default_rng(9)
    texts = [["abcdefgh"[min(int(rng.exponential(1.8)), 7)] for _ in range(rng.integers(3, 12))] + ["\0"] for _ in range(60)]
    d1, d2 = 0.5, 0.7
    slow, mean, n = Slow(texts, d1, d2, 1), Counter(), 300
    for i in range(n + 50):
        slow.sweep()
        if i >= 50:
            mean.update({"pairs": slow.n[0, None] / n, "words": slow.t[0, None] / n})
            for u, w in PAIRS:
                mean[u, w] += slow.probability(1, u, w) / n
    # the sweeps of the parts, without Spark
    names = sorted({w for t in texts for w in t})
    number = {w: i for i, w in enumerate(names)}
    hashes = np.array([xxhash.xxh64_intdigest(b"" if w == "\0" else w.encode()) for w in names], np.uint64)
    tokens = np.array([number[w] for t in texts for w in t])
    parts = lm.Parts(2, 3)
    chunk = lm.Chunk.of(lm.pack(np.cumsum([len(t) for t in texts])), lm.pack(tokens), lm.pack(hashes), lm.pack(np.bincount(tokens)))

    def run(packets, fn, *args):
        by = defaultdict(list)
        for p in packets:
            by[p[1]].append(p)
        return [x for key, held in by.items() for x in fn(key, held, *args)]

    def of(packets, *kinds):
        return [p for p in packets if p[0] in kinds]

    at = run(list(lm.word_packets("found", 0, chunk.hashes, chunk.counts, parts)), lm.count_words)
    pairs = run(list(lm.pair_packets(0, chunk, np.zeros(len(texts), bool), parts)), lm.count_pairs, parts)
    at = run(at + of(pairs, "base"), lm.gather_words)
    v = len(names)
    state = lm.State(v, 0, v, lm.Blocks.of(d1), lm.Blocks.of(d2))
    fixed, moving, got, n = of(pairs, "pairs", "codes"), of(pairs, "tables", "more"), Counter(), 600
    order = {w: int(np.flatnonzero(chunk.hashes == hashes[number[w]])[0]) for w in names}
    for i in range(n + 50):
        at = run(of(at, "words") + of(moving, "more"), lm.seat_words, state, False, 2 * i)
        state = lm.State(v, sum(p[5] for p in of(at, "words")), sum(p[4] for p in of(at, "words")), state.single, state.pair)
        if i >= 50:
            # as a sample of its own
            words_now = [("words", p[1], p[2], [*p[3], *kept(p[3], moving, p[1])], 0, 0) for p in of(at, "words")]
            asked = list(lm.word_packets("ask", 0, chunk.hashes, None, parts))
            tables = [("tables", p[1], p[2], [p[3][0], p[3][0]], 0, 0) for p in of(moving, "tables")]
            answers = run(words_now + asked, lm.answer_words) + run(fixed + tables, lm.answer_pairs, d2, 1)
            _, p = lm.probabilities(chunk, answers, state, [(state.customers, state.tables)], parts)
            got.update({"pairs": state.customers / n, "words": state.tables / n})
            for u, w in PAIRS:
                k = np.flatnonzero((chunk.before == order[u]) & (chunk.word == order[w]))
                got[u, w] += p[k[0]] / n
        moving = run(of(fixed, "pairs") + of(moving, "tables") + of(at, "reply"), lm.seat_pairs, state, parts, False, 2 * i + 1)
    for k, x in mean.items():
        assert abs(got[k] - x) < 0.03 * x, (k, x, got[k])


def kept(held, moving, q):
    """T(u), c1 and t1 of the words of a part, as ``seat_words`` keeps them."""
    names, follow, customers = lm.unpack_sorted(held[0]), lm.unpack(held[2]).copy(), lm.unpack(held[3]).copy()
    for p in moving:
        if p[0] == "more" and p[1] == q:
            at = np.searchsorted(names, lm.unpack_sorted(p[3][0]))
            follow[at] += lm.unpack(p[3][1])
            customers[at] += lm.unpack(p[3][2])
    return [lm.pack(follow), lm.pack(customers), held[4]]


def test_rising_factorials():
    for a, m in ((0.3, 1), (0.3, 40), (5.0, 7), (1e4, 300), (1e17, 100)):
        assert math.isclose(lm.log_rise(a, m), sum(math.log(a + i) for i in range(m)), rel_tol=1e-9, abs_tol=1e-9)


def test_arrays_in_few_bytes():
    rng = np.random.default_rng(1)
    for a in (np.empty(0, np.int64), np.arange(300), np.array([0, 1 << 40]), np.zeros(1000, np.int64)):
        assert (lm.unpack(lm.pack(a)) == a).all() and len(lm.unpack(lm.pack(a))) == len(a)
    h = np.sort(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(h)) == h).all()
    assert np.allclose(lm.unpack(lm.pack(np.array([0.25, 3.5]))), [0.25, 3.5])
