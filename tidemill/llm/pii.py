"""Information-theoretic sanitisation of personal data.

Fixed patterns give the protected entities (an e-mail address, a phone number, ... with its value). Terms that
stand near an entity can give it away too: a name that the corpus shows almost only beside one address discloses
that address. Over all lines of the corpus

    IC(e)     = -log2(n_e / N)
    PMI(t; e) = log2(n_te * N / (n_t * n_e)) = IC(e) + log2(n_te / n_t)

and the disclosure of e by t is PMI / IC, at most 1. Terms from ``generalise_at`` are generalised (to NAME or
WORD), those from ``remove_at`` are removed. A pair counts only if it is seen in ``min_contexts`` different
contexts (the terms around the entity): copies of one line count in all numbers alike, but make no pair evident.

Terms are runs of three letters and more outside all entities. Unit of all numbers is a line of a row: n_te lines in
which t is one of the ``window`` terms before or after e, however far away they are; n_t lines with t; n_e lines with
e; N all lines. Everything is counted over all rows. Pairs are counted by Spark with partial aggregation. Lines with a
term are counted for candidate terms only: tasks get these as a Bloom filter of fixed size (``BLOOM_BITS``), so false
positives cost some rows and an exact join drops them. Disclosing pairs are joined to where they occur, whatever
their number; only rows with terms near an entity take part in that join.

Defined cases: a null text is an empty one; an empty table gives an empty result; repeated rows give repeated
results; other columns are ignored; a null id is kept.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialize
from . import common

KINDS = ("email", "ip", "card", "phone", "term")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match from inside a run of digits fails where one from its start fails.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")
NOT_DIGIT = re.compile(r"[^0-9]+")
#: 1 MB.
BLOOM_BITS = 1 << 23


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that don't overlap, from each @ outwards: no run is scanned twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        after = at + 1
        if at > free and text[at - 1] in LOCAL and (m := DOMAIN.match(text, at + 1)):
            start = at - 1
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            free = after = m.end()
            yield start, free
        at = text.find("@", after)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, value), by start and kind."""
    found = [(s, 0, e, text[s:e].lower()) for s, e in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), 1, m.end(), m[0]))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end(), d))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(d := NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end(), d))
    found.sort()
    return found


def near_terms(text: str, spans: list[tuple[int, int, int, str]], window: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """For each base span: its entity, the start of its line, a hash of the terms around it, and their places. A line is scanned once."""
    low, high, held = 0, -1, []

    def line() -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
        places, at = [], low
        for start, _, end, _ in [*held, (high, 0, high, "")]:
            if start > at:
                places += [m.span() for m in TERM.finditer(text, at, start)]
            at = max(at, end)
        starts, ends = [s for s, _ in places], [e for _, e in places]
        for start, kind, end, value in held:
            n, m = bisect_right(ends, start), bisect_left(starts, end)
            near = places[max(0, n - window) : n] + places[m : m + window]
            words = " ".join(text[s:e].lower() for s, e in near)
            yield f"{KINDS[kind]}:{value}", low, xxhash.xxh64_intdigest(words.encode("utf-8", "surrogatepass")) - (1 << 63), near

    for span in spans:  # by start
        if span[0] > high:
            if held:
                yield from line()
            low = text.rfind("\n", max(high, 0), span[0]) + 1 or max(high, 0)
            high = text.find("\n", span[2])
            high = len(text) if high < 0 else high
            held = []
        held.append(span)
    if held:
        yield from line()


HIT = T.StructType([T.StructField("entity", T.StringType()), T.StructField("term", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
EVIDENCE = T.StructType([T.StructField("entity", T.StringType()), T.StructField("term", T.StringType()), T.StructField("context", T.LongType()), T.StructField("n", T.LongType())])


def evidence_of(near: list[tuple[str, int, int, list[tuple[int, int]]]], terms: list[list[str]]) -> Iterator[tuple[str, str | None, int | None, int]]:
    """(entity, term, context, n) of a text. Over the contexts of a pair, n adds up to the lines that have it; without a term, to those of the entity."""
    lines = {(entity, at) for entity, at, _, _ in near}
    for entity, _ in lines:
        yield entity, None, None, 1
    counted, seen = set(), Counter()
    for (entity, at, context, _), words in zip(near, terms):
        for term in set(words):
            first = (entity, term, at) not in counted
            counted.add((entity, term, at))
            seen[entity, term, context] += first
    for (entity, term, context), n in seen.items():
        yield entity, term, context, n


def find_base(docs: DataFrame, id_col: str, text_col: str, window: int, keep_rows: bool) -> DataFrame:
    """(uid, id, n_lines, spans, hits, evidence[, row]): base spans, and the terms near them; the columns of a row that has any as c0, c1, ..."""
    kept = docs.schema.fields if keep_rows else []
    named = {f"c{i}": f for i, f in enumerate(kept)}
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(f"`{f.name}`").alias(c) for c, f in named.items() if f.name not in (id_col, text_col)])
    own = {c: {id_col: "id", text_col: "text"}.get(f.name, c) for c, f in named.items()}
    fields = [T.StructField("uid", T.LongType()), T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_lines", T.LongType()), T.StructField("spans", common.SPAN), T.StructField("hits", T.ArrayType(HIT)), T.StructField("evidence", T.ArrayType(EVIDENCE))]
    schema = T.StructType([*fields, *[T.StructField(c, f.dataType) for c, f in named.items()]])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = of(batch.column("text").to_pylist())
            columns = [pa.array(range(uid, uid + batch.num_rows), pa.int64()), batch.column("id"), *[pa.array(x, target.field(n).type) for n, x in zip(("n_lines", "spans", "hits", "evidence"), found)]]
            # rows without hits leave theirs behind
            places = pa.array([i if h else None for i, h in enumerate(found[2])], pa.int64())
            columns += [batch.column(own[c]).take(places) for c in named]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)
            uid += batch.num_rows

    def of(texts: list[str | None]) -> tuple[list, list, list, list]:
        n_lines, all_spans, all_hits, all_evidence = [], [], [], []
        for text in texts:
            text = text or ""
            spans = base_spans(text)
            n_lines.append(text.count("\n") + 1)
            all_spans.append([{"kind": KINDS[k], "start": s, "end": e, "base": True, "weight": None} for s, k, e, _ in spans])
            near = list(near_terms(text, spans, window)) if spans else []
            terms = [[text[s:e].lower() for s, e in places] for *_, places in near]
            all_hits.append([{"entity": entity, "term": term, "start": s, "end": e} for (entity, _, _, places), own in zip(near, terms) for (s, e), term in zip(places, own)])
            all_evidence.append([{"entity": e, "term": t, "context": c, "n": n} for e, t, c, n in evidence_of(near, terms)])
        return n_lines, all_spans, all_hits, all_evidence

    return common.small_batches(source).mapInArrow(run, schema)


def bloom_places(term: bytes) -> tuple[int, int, int]:
    h = xxhash.xxh64_intdigest(term)
    return h % BLOOM_BITS, (h >> 23) % BLOOM_BITS, (h >> 41) % BLOOM_BITS


def bloom(terms: DataFrame) -> np.ndarray:
    """A Bloom filter of the terms: at most BLOOM_BITS / 64 rows reach the driver, however many terms there are."""
    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM_BITS // 64, dtype=np.uint64)
        for batch in batches:
            for term in batch.column(0).to_pylist():
                for i in bloom_places(term.encode()):
                    bits[i >> 6] |= np.uint64(1 << (i & 63))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_pydict({"word": at.astype(np.int64), "bits": bits[at].view(np.int64)})

    out = np.zeros(BLOOM_BITS // 64, dtype=np.uint64)
    for row in terms.mapInArrow(run, schema).groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        out[row["word"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return out


def term_lines(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """(term, n_t): lines with each term, over the whole corpus."""
    held = docs.sparkSession.sparkContext.broadcast(bloom(terms))
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("n_t", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        known: dict[str, bool] = {}

        def likely(term: str) -> bool:
            if (x := known.get(term)) is None:
                if len(known) > 200_000:
                    known.clear()
                x = known[term] = all(int(bits[i >> 6]) >> (i & 63) & 1 for i in bloom_places(term.encode("utf-8", "surrogatepass")))
            return x

        count: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in (text or "").split("\n"):
                    count.update(t for t in set(TERM.findall(line.lower())) if likely(t))
            if len(count) > 100_000:
                yield pa.RecordBatch.from_pydict({"term": list(count), "n_t": list(count.values())}, schema=pa.schema([("term", pa.string()), ("n_t", pa.int64())]))
                count.clear()
        yield pa.RecordBatch.from_pydict({"term": list(count), "n_t": list(count.values())}, schema=pa.schema([("term", pa.string()), ("n_t", pa.int64())]))

    counted = common.small_batches(docs).select(text_col).mapInArrow(run, schema).groupBy("term").agg(F.sum("n_t").alias("n_t"))
    return counted.join(terms, "term", "left_semi")


def disclosures(docs: DataFrame, found: DataFrame, text_col: str, generalise_at: float, min_contexts: int) -> DataFrame | None:
    """(entity, term, disclosure) from ``generalise_at``; None if no pair has enough contexts. ``found``: ``find_base`` of docs."""
    seen = found.where(F.size("evidence") > 0).select(F.explode("evidence").alias("e")).select("e.*").groupBy("entity", "term", "context").agg(F.sum("n").alias("n"))
    seen = materialize(seen, "pii-evidence")
    pairs = seen.where(F.col("term").isNotNull()).groupBy("entity", "term").agg(F.sum("n").alias("n_te"), F.count("*").alias("contexts"))
    pairs = materialize(pairs.where(F.col("contexts") >= min_contexts), "pii-pairs")
    if pairs.isEmpty():
        return None
    n_lines = found.agg(F.sum("n_lines")).first()[0]
    entities = seen.where(F.col("term").isNull()).select("entity", F.col("n").alias("n_e"))
    terms = term_lines(docs, text_col, pairs.select("term").distinct())
    scored = pairs.join(entities, "entity").join(terms, "term")
    information = -F.log2(F.col("n_e") / F.lit(float(n_lines)))
    scored = scored.withColumn("disclosure", F.when(information > 0, 1 + F.log2(F.col("n_te") / F.greatest("n_t", "n_te")) / information).otherwise(F.lit(0.0)))
    return materialize(scored.where(F.col("disclosure") >= generalise_at).select("entity", "term", "disclosure"), "pii-disclosures")


def terms_of(found: DataFrame, held: DataFrame) -> DataFrame:
    """(uid, more): the spans of disclosing terms, for rows that have any."""
    hits = found.select("uid", F.explode("hits").alias("h")).select("uid", "h.*")
    terms = hits.join(held, ["entity", "term"]).groupBy("uid", "start", "end").agg(F.max("disclosure").alias("weight"))
    return terms.groupBy("uid").agg(F.collect_list(F.struct(F.lit("term").alias("kind"), "start", "end", F.lit(False).alias("base"), "weight")).alias("more"))


def with_terms(near: DataFrame, held: DataFrame | None) -> DataFrame:
    """Rows of ``find_base`` that have hits, with disclosing terms among their spans."""
    if held is None:
        return near
    place = "2 * sign(a.start - b.start) + sign(array_position({0}, a.kind) - array_position({0}, b.kind))".format("array({})".format(", ".join(f"'{k}'" for k in KINDS)))
    merged = F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.expr(f"array_sort(concat(spans, more), (a, b) -> cast({place} as int))"))
    return near.join(terms_of(near, held), "uid", "left").withColumn("spans", merged).drop("more")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 8, min_contexts: int = 3, generalise_at: float = 0.8) -> DataFrame:
    """(id, spans) for every row. A span: kind (email, ip, card, phone, term), start, end (code points), base, weight (disclosure of a term)."""
    found = materialize(find_base(docs, id_col, text_col, window, False), "pii-base")  # also pins the uids
    near = with_terms(found.where(F.size("hits") > 0), disclosures(docs, found, text_col, generalise_at, min_contexts))
    return near.select("id", "spans").unionByName(found.where(F.size("hits") == 0).select("id", "spans"))


def masked(text: str | None, spans: list[dict], remove_at: float) -> str | None:
    """Base spans become their kind; terms are removed from ``remove_at`` and else generalised."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            word = text[s["start"] : s["end"]]
            out += [text[at : s["start"]], f"<{s['kind'].upper()}>" if s["base"] else "" if s["weight"] >= remove_at else "<NAME>" if word[:1].isupper() else "<WORD>"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 8, min_contexts: int = 3, generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """The rows of ``docs`` with personal data masked in the text; other columns as they were.

    Rows with terms near an entity are kept from the first reading, for the join with disclosing pairs; all others are
    masked as they are read again. Which a row is depends on its text alone.
    """
    found = materialize(find_base(docs, id_col, text_col, window, True), "pii-base")
    held = disclosures(docs, found, text_col, generalise_at, min_contexts)
    names = docs.columns
    at = names.index(text_col)
    target = to_arrow_schema(docs.schema)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, texts = [], []
            for i, text in enumerate(batch.column(at).to_pylist()):
                base = base_spans(text or "")
                if not any(places for *_, places in near_terms(text or "", base, window)):
                    kept.append(i)
                    texts.append(masked(text, [{"kind": KINDS[k], "start": s, "end": e, "base": True} for s, k, e, _ in base], remove_at))
            columns = [pa.array(texts, f.type) if i == at else c.take(pa.array(kept, pa.int64())).cast(f.type) for i, (c, f) in enumerate(zip(batch.columns, target))]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    def mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([masked(t, list(s), remove_at) for t, s in zip(texts, spans)], dtype=object)

    near = with_terms(found.where(F.size("hits") > 0), held).withColumn(f"c{at}", F.pandas_udf(mask, T.StringType())(F.col(f"c{at}"), F.col("spans")))
    return near.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)]).unionByName(common.small_batches(docs).mapInArrow(rest, docs.schema))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return find(common.table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        *[common.count_kind(spans, k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(common.spans_text(common.base_only(spans)), 256).alias("base_sha256"),
        common.spans_text(spans).alias("spans"),
    )
