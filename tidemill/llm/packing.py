"""Harmonic packing of documents into sequences.

Lengths fall into reciprocal classes: class k holds pieces over C/(k+1) and up to C/k tokens, and k of them share a
sequence of C. Every worker fills the bins of each class by itself with exactly k pieces; nothing is shuffled.

Documents may be cut, so a rest is cut down to the full length floor(C/k) of a class, and its own rest again, until
it nearly fills its class: bins of full lengths waste under k tokens. What is left in unfinished bins when a worker
ends is laid end to end and cut at C; the last stretch is cut into powers of two, at which nothing is padded.

Tokens: by a public vocabulary; it lowers case and drops white space, so a text's ids are those of its words one
after another. Words are encoded once per worker (a cache of bounded size) and in bulk where that is the same.

Defined cases: a null text is an empty one, whose only id is the end; an empty table gives an empty result;
repeated rows are packed each; a null id is kept; other columns are ignored. Sequence numbers are unique within a
result: the partition's number in the upper bits.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common

CAPACITY = 2048
#: Rests are cut down to classes up to this one; shorter ones join the class of their own length.
CUT_CLASSES = 32
#: A piece that fills this share of its class's length isn't cut further.
NEARLY = 0.99
END = 1
#: Words that a worker remembers: about 65 MB.
CACHE_WORDS = 300_000
#: Letters between ASCII marks, which are pieces of their own; apostrophes are left out, as they bind letters.
ENDS = frozenset(bytes([c]) for c in b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')
FRAMED = re.compile(r"^(?:([!-&(-/:-@\[-`{-~]*)([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)|(.*))$", re.MULTILINE)


class Words:
    """ids (little-endian, four bytes each) of whole words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: For words of lower-case letters only: the same model without what such words don't need.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {b"": b""}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Letters between marks are one piece of text to the vocabulary wherever they stand, and so are the marks.

        That holds for letters before and after normalisation. The vocabulary lowers letter by letter; only a capital
        sigma is lowered by its place in str.lower, so words with one are encoded by themselves, like all others.
        """
        known = self.known
        if len(self.marks) > 10_000:
            self.marks = {b"": b""}
        marks, parts, rest = self.marks, [], []
        for w in words:  # ASCII letters, and one mark at most after them
            if w.isalpha():
                parts.append((w, b"", w.lower(), b""))
            elif w[:-1].isalpha() and w[-1:] in ENDS:
                parts.append((w, b"", w[:-1].lower(), w[-1:]))
            else:
                rest.append(w)
        text = b"\n".join(rest).decode("utf-8", "surrogatepass")
        for w, s, (before, low, after, _) in zip(rest, text.split("\n"), FRAMED.findall(text.lower())):
            if low and (s.isascii() or (low.isalpha() and "Σ" not in s and unicodedata.is_normalized("NFC", s) and unicodedata.is_normalized("NFC", low))) and "<|" not in before:
                parts.append((w, before.encode(), low.encode(), after.encode()))
            else:
                known[w] = self.encode(s)
        fresh = self.in_bulk(list({low for _, _, low, _ in parts}.difference(known)))
        for w, before, low, after in parts:
            ids = fresh.get(low) or known[low]
            if before or after:
                for mark in (before, after):
                    if mark not in marks:
                        marks[mark] = self.encode(mark.decode())
                ids = marks[before] + ids + marks[after]
            known[w] = ids

    def in_bulk(self, words: list[bytes]) -> dict[bytes, bytes]:
        out = {}
        for a in range(0, len(words), 2000):
            some = words[a : a + 2000]
            got = self.plain.encode(b" ".join(some).decode(), add_special_tokens=False)
            of = np.array(got.word_ids)
            if of[-1] + 1 == len(some):
                raw, cuts = np.array(got.ids, "<u4").tobytes(), (4 * np.searchsorted(of, np.arange(len(some) + 1))).tolist()
                out |= zip(some, [raw[i:j] for i, j in zip(cuts, cuts[1:])])
            else:
                out |= {w: self.encode(w.decode()) for w in some}
        return out

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text; words are learned for all texts at once."""
        known = self.known
        split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        missing = list(set(chain.from_iterable(split)).difference(known))
        full = len(known) + len(missing) > CACHE_WORDS
        if missing:
            self.learn(missing)
        for words in split:
            yield b"".join(map(known.__getitem__, words))
        if full:  # words met first stay: frequent ones are among them
            for w in missing:
                del known[w]


@functools.cache
def words_of(path: str) -> Words:
    return Words(path)


def cuts(n: int) -> Iterator[tuple[int, int]]:
    """(length, class) of the pieces of n tokens."""
    while n >= CAPACITY:
        yield CAPACITY, 1
        n -= CAPACITY
    while n:
        k = CAPACITY // n
        if k >= CUT_CLASSES or n >= NEARLY * (CAPACITY // k):
            yield n, k
            return
        full = CAPACITY // (k + 1)
        yield full, k + 1
        n -= full


class Bins:
    """The open bins of one worker."""

    def __init__(self, partition: int):
        self.open: dict[int, list[tuple]] = {}
        self.next_id = partition << 40
        self.done: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, length, crc, total, _ in pieces:
            self.done.append((doc, start, length, crc, total, self.next_id, at))
            at += length
        self.next_id += 1

    def add(self, piece: tuple, k: int) -> None:
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            self.close(bin_)
            del self.open[k]

    def finish(self) -> None:
        left = [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(p[2] for p in left)
        sizes = [CAPACITY] * (total // CAPACITY) + [1 << b for b in reversed(range(11)) if total % CAPACITY >> b & 1]
        held, room = [], 0
        queue = iter(sizes)
        for doc, start, length, _, total, ids in left:
            while length:
                if not room:
                    if held:
                        self.close(held)
                    held, room = [], next(queue)
                take = min(room, length)
                held.append((doc, start, take, zlib.crc32(ids[: 4 * take]), total, None))
                start, length, ids, room = start + take, length - take, ids[4 * take :], room - take
        if held:
            self.close(held)
        self.open = {}


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None) -> DataFrame:
    """A row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    path = vocabulary_path or vocabulary()
    longs = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in longs]])
    target = to_arrow_schema(schema)
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bins = words_of(path), Bins(TaskContext.get().partitionId())

        def out() -> pa.RecordBatch:
            columns = list(zip(*bins.done)) or [()] * len(target)
            bins.done = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), words.ids(batch.column(1).to_pylist())):
                ids += end
                total, start = len(ids) // 4, 0
                for length, k in cuts(total):
                    piece = ids[4 * start : 4 * (start + length)]
                    # ids are kept only while the bin is open
                    bins.add((doc, start, length, zlib.crc32(piece), total, piece), k)
                    start += length
            yield out()
        bins.finish()
        yield out()

    return common.small_batches(docs).select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
