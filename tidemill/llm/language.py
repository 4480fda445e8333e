"""Language identification in two levels: families first, then close languages within the family.

Features are hashed byte n-grams (two to four bytes, so short words with their spaces) of the whole text (lower case; anything ASCII but letters counts as
one kind of space), as shares of their number. Linear support vector machines (hinge loss, dual coordinate descent)
decide one against one: first between language families, then between the languages of the family that won.
All weights of a pair are one column, so a text costs one table lookup per n-gram and pair.

Labels that no family lists are put into families by their texts: as many as the root of their number, around labels far
from each other in their mean shares. So L labels make some L^1.5 pairs. Pairs are trained in tasks.

Learning uses a bounded sample of the labelled rows (``per_language`` documents of each label, those with the
smallest hash, SAMPLE in all; FEATURES of the most frequent n-grams of each) as feature counts, never the texts;
prediction covers all rows and whole texts. The weights (one column a pair) are broadcast: their size depends on the
number of languages only, and n-grams share rows where pairs are so many that they would take more than WEIGHTS numbers.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is every text if no labelled row
is there to learn from; an empty table gives an empty result; repeated rows give repeated results; rows with a null
label don't teach; other columns are ignored. Ties go to the label that sorts first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

UNDETERMINED = "und"
#: Families (fixed values, ISO 639-1); any other label is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("am", "ar", "he", "mt"),
    "sinitic": ("yue", "zh"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "austronesian": ("id", "jv", "mg", "ms", "su", "tl"),
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes}
BUCKETS = 1 << 16
#: Bytes of a text that are looked at together.
PIECE = 1 << 15
#: Bytes that aren't part of a word become a space.
SPACED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
#: Shares are small; this brings vectors to a length near 1.
SCALE = 20.0
MAX_LANGUAGES = 400
#: Bounds of what the driver holds: documents of the sample, n-grams of each, and weights (of 4 bytes).
SAMPLE, FEATURES, WEIGHTS = 20_000, 8192, 1 << 26


def grams(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of all n-grams of a text, in pieces of bounded size."""
    whole = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(SPACED) + b" ", np.uint8)
    for a in range(0, len(whole) - 1, PIECE):
        b = whole[a : a + PIECE + 3].astype(np.uint32)
        two = b[:-1] << 8 | b[1:]
        three = (two[:-1] * np.uint32(2654435761) + b[2:] * np.uint32(40503)) >> np.uint32(16)
        four = (two[:-2] * np.uint32(2654435761) + two[2:] * np.uint32(2246822519)) >> np.uint32(16)
        yield np.concatenate([two[:PIECE], three[:PIECE] + np.uint32(BUCKETS), four[:PIECE] + np.uint32(2 * BUCKETS)])


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, counts) of a text."""
    n = np.zeros(3 * BUCKETS, np.int64)
    for at in grams(text):
        n += np.bincount(at, minlength=3 * BUCKETS)
    found = np.flatnonzero(n)
    if len(found) > FEATURES:
        found = np.sort(found[np.argsort(-n[found], kind="stable")[:FEATURES]])
    return found.astype(np.uint32), n[found].astype(np.uint32)


def has_letter(text: str | None) -> bool:
    return text is not None and next(filter(str.isalpha, text), None) is not None


def train_pair(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, cost: float = 10.0, rounds: int = 30, size: int = 3 * BUCKETS) -> np.ndarray:
    """Weights of a linear support vector machine; the last is the bias."""
    w = np.zeros(size + 1)
    alpha = np.zeros(len(rows))
    norms = [float(v @ v) + 1.0 for _, v in rows]
    shuffled = np.random.default_rng(5)
    for _ in range(rounds):
        moved = 0.0
        for i in shuffled.permutation(len(rows)):
            at, v = rows[i]
            gradient = signs[i] * (float(w[at] @ v) + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            if (step := (new - alpha[i]) * signs[i]) != 0.0:
                w[at] += step * v
                w[-1] += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


Sample = tuple[str, np.ndarray, np.ndarray]


def families_of(samples: list[Sample]) -> dict[str, str]:
    """The family of each label: the listed one, or that of the nearest of some labels which are far from each other."""
    known = {s[0]: FAMILY_OF[s[0]] for s in samples if s[0] in FAMILY_OF}
    rest = sorted({s[0] for s in samples} - set(known))
    if len(rest) <= 3:
        return known | {label: label for label in rest}
    place = {label: i for i, label in enumerate(rest)}
    means = np.zeros((len(rest), 3 * BUCKETS >> 6))
    for label, at, counts in samples:
        if label in place:
            # n-grams share places here: likeness needs no more
            np.add.at(means[place[label]], at >> 6, np.sqrt(counts / counts.sum()))
    means /= np.linalg.norm(means, axis=1, keepdims=True)
    near = means @ means.T
    centres = [0]
    while len(centres) < math.ceil(math.sqrt(len(rest))):
        centres.append(int(np.argmin(near[:, centres].max(axis=1))))
    most = 2 * math.ceil(math.sqrt(len(rest)))  # a family grows no larger, so pairs stay few
    sizes, out = dict.fromkeys(centres, 0), {}
    for i in sorted(range(len(rest)), key=lambda i: (-near[i, centres].max(), i)):
        c = next(c for c in sorted(centres, key=lambda c: (-near[i, c], c)) if sizes[c] < most)
        sizes[c] += 1
        out[rest[i]] = f"like {rest[c]}"
    return known | out


class Model:
    """Columns of weights: pairs of families, then pairs of languages within each family."""

    def __init__(self, samples: list[Sample], spark=None):
        """Pairs are trained in tasks of ``spark``; here, without."""
        labels, family = sorted({s[0] for s in samples}), families_of(samples)
        self.families = sorted(set(family.values()))
        self.members = [[x for x in labels if family[x] == f] for f in self.families]
        place = {label: [i for i, s in enumerate(samples) if s[0] == label] for label in labels}
        in_family = [[i for label in own for i in place[label]] for own in self.members]
        duels: list[tuple[list[int], list[int]]] = []

        def pairs(groups: list[list[int]]) -> list[tuple[int, int, int]]:
            out = []
            for a, b in combinations(range(len(groups)), 2):
                out.append((a, b, len(duels)))
                duels.append((groups[a], groups[b]))
            return out

        self.family_pairs = pairs(in_family)
        self.pairs = [pairs([place[label] for label in own]) for own in self.members]
        self.bits = 16
        while self.bits > 8 and len(duels) * 3 << self.bits > WEIGHTS:
            self.bits -= 1
        rows = []
        for _, at, counts in samples:
            kept, own = np.unique(self.fold(at), return_inverse=True)
            rows.append((kept, np.bincount(own, weights=counts) * (SCALE / counts.sum())))
        columns = trained(rows, duels, 3 << self.bits, spark)
        w = np.stack(columns, axis=1) if columns else np.zeros((3 << self.bits, 1), np.float32)
        self.weights, self.bias = w[:-1] * np.float32(SCALE) if columns else w, w[-1].astype(np.float64)

    def fold(self, at: np.ndarray) -> np.ndarray:
        """n-grams of each length in fewer places."""
        return at if self.bits == 16 else (at >> 16 << self.bits) | (at & np.uint32((1 << self.bits) - 1))

    def margins(self, texts: list[str]) -> np.ndarray:
        out = np.empty((len(texts), self.weights.shape[1]))
        for i, text in enumerate(texts):
            total, n = np.zeros(self.weights.shape[1]), 0
            for at in grams(text):
                found, times = (at, None) if self.weights.shape[1] < 64 else np.unique(self.fold(at), return_counts=True)
                if times is None:
                    total += self.weights[self.fold(found)].sum(axis=0, dtype=np.float64)
                else:  # wide rows: each n-gram once
                    for a in range(0, len(found), 1024):
                        total += times[a : a + 1024].astype(np.float32) @ self.weights[found[a : a + 1024]]
                n += len(at)
            out[i] = total / n + self.bias
        return out

    @staticmethod
    def vote(pairs: list[tuple[int, int, int]], n: int, margins: np.ndarray) -> tuple[int, float]:
        """The winner of most duels, then of the largest margins; the least certain of its duels."""
        wins, sums = [0] * n, [0.0] * n
        for a, b, k in pairs:
            m = float(margins[k])
            wins[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
        best = max(range(n), key=lambda i: (wins[i], sums[i], -i))
        sure = [1 / (1 + np.exp(-2 * float(np.clip(margins[k] * (1 if a == best else -1), -300, 300)))) for a, b, k in pairs if best in (a, b)]
        return best, min(sure, default=1.0)

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for margins in self.margins(texts):
            f, sure = self.vote(self.family_pairs, len(self.families), margins)
            label, within = self.vote(self.pairs[f], len(self.members[f]), margins)
            out.append((self.members[f][label], float(sure * within)))
        return out


def trained(rows: list[tuple[np.ndarray, np.ndarray]], duels: list[tuple[list[int], list[int]]], size: int, spark) -> list[np.ndarray]:
    """The weights of each duel."""

    def train(one: list[int], other: list[int], held: list) -> np.ndarray:
        return train_pair([held[i] for i in one + other], np.array([1.0] * len(one) + [-1.0] * len(other)), size=size).astype(np.float32)

    if spark is None or len(duels) < 2:
        return [train(*d, rows) for d in duels]
    shared, pairs = spark.sparkContext.broadcast(rows), spark.sparkContext.broadcast(duels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"k": [k], "w": [train(*pairs.value[k], shared.value).tobytes()]})

    n = len(duels)
    found = spark.range(n, numPartitions=min(n, 1000)).mapInArrow(run, "k long, w binary").collect()  # WEIGHTS numbers at most
    shared.unpersist()
    pairs.unpersist()
    return [np.frombuffer(r["w"], np.float32) for r in sorted(found)]


def fit(docs: DataFrame, training: Column, id_col: str, text_col: str, label_col: str, per_language: int) -> Model | None:
    usable = docs.where(training & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(label_col).count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels: {label_col} doesn't hold languages")
    if not counts:
        return None
    per_language = max(20, min(per_language, SAMPLE // len(counts)))
    # twice the share that is needed, by hash; then the smallest hashes
    hashed = F.xxhash64(F.col(id_col), F.lit("sample"))
    share = F.create_map(*[x for label, n in counts.items() for x in (F.lit(label), F.lit(min(1.0, 2.0 * per_language / n)))])
    uniform = F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.where(uniform < share[F.col(label_col)]).select(F.col(label_col).alias("label"), hashed.alias("h"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("h", T.LongType()), T.StructField("at", T.BinaryType()), T.StructField("n", T.BinaryType())])

    def count(cols: dict[str, list]) -> dict[str, list]:
        kept = [(label, h, *counted(t)) for label, h, t in zip(cols["label"], cols["h"], cols["text"]) if has_letter(t)]
        return {"label": [k[0] for k in kept], "h": [k[1] for k in kept], "at": [k[2].tobytes() for k in kept], "n": [k[3].tobytes() for k in kept]}

    features = common.map_batches(drawn, count, schema)
    best = features.withColumn("r", F.row_number().over(W.partitionBy("label").orderBy("h", "at"))).where(F.col("r") <= per_language)
    rows = sorted(best.select("label", "h", "at", "n").collect())
    return Model([(r["label"], np.frombuffer(r["at"], np.uint32), np.frombuffer(r["n"], np.uint32).astype(float)) for r in rows], docs.sparkSession) if rows else None


def labeller(docs: DataFrame, training: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = 300) -> Callable[[Column], Column]:
    """Learns from rows where ``training`` holds (all, if None); returns what makes (lang_pred, score) of a text column."""
    common.small_batches(docs)
    model = fit(docs, F.lit(True) if training is None else F.coalesce(training, F.lit(True)), id_col, text_col, label_col, per_language)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pd.Series) -> pd.DataFrame:
        known = held.value
        use = [i for i, t in enumerate(texts) if known is not None and has_letter(t)]
        found = dict(zip(use, known.predict([texts.iloc[i] for i in use]))) if use else {}
        both = [found.get(i, (UNDETERMINED, 0.0)) for i in range(len(texts))]
        return pd.DataFrame({"lang_pred": [x[0] for x in both], "score": [x[1] for x in both]})

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    # not to be run once more for each condition on its result
    return F.pandas_udf(predict, kind).asNondeterministic()


def identify(docs: DataFrame, training: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = 300) -> DataFrame:
    """(id, lang_pred, score) for every row; learns from rows where ``training`` holds (all, if None)."""
    label = labeller(docs, training, id_col, text_col, label_col, per_language)
    return docs.select(F.col(id_col).alias("id"), label(F.col(text_col)).alias("found")).select("id", "found.lang_pred", "found.score")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op8_language(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text", "lang"), training=~held_out()).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
