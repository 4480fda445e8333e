"""Operators on documents, against brute force on the smallest tables and on small cases."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import language, lm, mixing, packing, pii, secrets, simhash, warc

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: A column of every name that operators use inside.
CLASHES = ("id", "uid", "fp", "size", "order", "score", "spans", "hits", "c0", "position", "chunk", "held", "bucket", "label", "term", "start")

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 4),
    (4, "!!! 123", "en", None, 7),
    (None, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
    (5, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
    (5, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
    (6, "x" * 50_000 + " " + "1" * 50_000 + " " + "a@" * 5000, "en", "b", None),
    (7, "Grüße, naïve 中文 \U0001f600 İ ΣΑΣ é don't <|endoftext|>", "de", "a", None),
    (8, "mail a.b@c.example.org or +1 (555) 123-4567 now", "fr", "c", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit("clash"))
    return docs.cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


# --- 1 and 9: spans ---


def slow_pii(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(spans)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c a@b a@@b.c x.y%z@q-w.e.f,g@h.i.j.k a@b.c_d@e.f .@a.b",
        "1.2.3.4 256.1.1.1 0001.2.3.4 1.2.3.4.5.6.7.8 1.2.3 1..2.3.4 " + "9" * 30 + ".1.1.1",
        "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 5 5 5 12",
        "+1 (555) 123-4567 +1234 +12345678901234567890 ++4912345678 +1-2",
        "",
        "é@b.co +49 30 123456 ü1.1.1.1",
    ],
)
def test_pii_base(text):
    assert [(s, k, e) for s, k, e, _ in pii.base_spans(text)] == slow_pii(text)


def test_covered():
    from tidemill.llm.common import Covered

    rng = np.random.default_rng(6)
    for _ in range(50):
        spans = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 50, 6), rng.integers(1, 20, 6))]
        covered = Covered(spans)
        assert all(covered(a, b) == any(s < b and a < e for s, e in spans) for a in range(60) for b in range(a + 1, 62))
    assert not Covered([])(0, 5)


def test_many_entities_take_linear_time():
    text = " ".join(f"word{i} a{i}@b.example +1 (555) 010-{i:04}" for i in range(3000))
    spans = pii.base_spans(text)
    assert len(spans) >= 6000 and sum(len(p) for *_, p in pii.near_terms(text, spans, 8)) > 0


def slow_near(text, spans, window):
    """(entity, start of its line, places of the terms around it): terms are runs of letters outside all entities."""
    out = []
    for start, kind, end, value in spans:
        a = text.rfind("\n", 0, start) + 1
        b = text.find("\n", end)
        inside = [any(s <= i < e for s, _, e, _ in spans) for i in range(len(text))]
        line = "".join("0" if inside[i] else text[i] for i in range(a, b if b >= 0 else len(text)))
        places = [(a + m.start(), a + m.end()) for m in re.finditer(r"[^\W\d_]{3,}", line)]
        out.append((f"{pii.KINDS[kind]}:{value}", a, [p for p in places if p[1] <= start][-window:] + [p for p in places if p[0] >= end][:window]))
    return out


def test_terms_near_entities():
    rng = np.random.default_rng(5)
    bits = ["a@b.example", "+1 (555) 010-0199", "10.1.2.3", "\n", " ", "word", "longer", "it", "éèê", "x" * 700, "1" * 600, "."]
    for _ in range(300):
        text = "".join(rng.choice(bits, rng.integers(1, 30)))
        spans = pii.base_spans(text)
        assert [(e, a, p) for e, a, _, p in pii.near_terms(text, spans, 3)] == slow_near(text, spans, 3), text
    far = "Quentina" + " " * 5000 + "q@b.example" + "9 " * 3000 + "Waldemar"
    assert [p for *_, p in pii.near_terms(far, pii.base_spans(far), 8)][0] == [(0, 8), (len(far) - 8, len(far))]


def test_evidence_counts_lines(spark):
    """All numbers count lines of rows, copies too; contexts tell lines apart."""
    text = "Ann Lee ann@x.example ann@x.example\nAnn ann@x.example\nann@x.example\nAnn none"
    docs = spark.createDataFrame([(1, text), (1, text), (2, None)], "doc_id long, text string")
    found = pii.find_base(docs, "doc_id", "text", 8, False)
    n = {}
    contexts = defaultdict(set)
    for r in found.collect():
        for e in r["evidence"]:
            n[e["entity"], e["term"]] = n.get((e["entity"], e["term"]), 0) + e["n"]
            contexts[e["term"]].add(e["context"])
    assert n == {("email:ann@x.example", None): 6, ("email:ann@x.example", "ann"): 4, ("email:ann@x.example", "lee"): 2}
    assert len(contexts["ann"]) == 2 and len(contexts["lee"]) == 1 and sum(r["n_lines"] for r in found.collect()) == 9
    assert {r["term"]: r["n_t"] for r in pii.term_lines(docs, "text", spark.createDataFrame([("ann",), ("lee",)], "term string")).collect()} == {"ann": 8, "lee": 2}


def test_pii_documents(docs):
    found = {r["id"]: [(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["spans"] if s["base"]] for r in pii.find(docs).collect()}
    assert found == {r["doc_id"]: slow_pii(r["text"]) for r in docs.collect()}


def test_pii_disclosure(spark):
    """A name that stands beside one address in several contexts is found; common words and copies aren't."""
    rows = [(i, f"{w} Quentina wrote from quentina.w@mail.example.com about the {w} report", "en", "a", 0) for i, w in enumerate(WORDS[:4])]
    rows += [(100 + i, f"the report about {w} from the office\nwrote about the {w} report", "en", "a", 0) for i, w in enumerate(WORDS * 5)]
    rows += [(200 + i, "Waldemar sent it from waldemar@mail.example.org today", "en", "a", 0) for i in range(5)]
    docs = spark.createDataFrame(rows, DOCS)
    for r in pii.find(docs).collect():
        text = {x[0]: x[1] for x in rows}[r["id"]]
        terms = {text[s["start"] : s["end"]] for s in r["spans"] if not s["base"]}
        assert terms == ({"Quentina"} if r["id"] < 4 else set())
    texts = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert texts[0] == "alpha  wrote from <EMAIL> about the alpha report"
    assert texts[100] == rows[4][1]


def slow_secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_secrets(docs):
    found = {r["id" if "id" in r else "doc_id"]: [(s["start"], secrets.KINDS.index(s["kind"]), s["end"]) for s in r["spans"] if s["base"]] for r in secrets.scan(docs).collect()}
    assert found == {r["doc_id"]: slow_secrets(r["text"]) for r in docs.collect()}


@pytest.mark.parametrize(
    ("text", "random"),
    [
        ("key Zx9Kq2LmN8vRt4YpW3sD7fGh1jBc here", True),
        ("commit da39a3ee5e6b4b0d3255bfef95601890afd80709", False),
        ("id 123E4567-e89b-12d3-A456-426614174000 end", False),
        ("internationalization_of_everything and more", False),
        ("sha256-47DEQpj8HBSa/TImW5JCeuQeRkm5NMpJWZG3hSuFU= x", False),
        ("2024-01-01/2024-01-02/2024 1234567890123456789012", False),
    ],
)
def test_random_strings(text, random):
    found = secrets.random_spans(text, secrets.base_spans(text), secrets.vocabulary(), 2.0)
    assert bool(found) == random


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("jwt eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jTNvLZxT9bWqk1mAoeFp2cVhR7sYu0E ok", [(4, 96)]),
        ("the key is Zx9Kq2LmN8vRt4YpW3sD7fGh1jBc. Then more", [(11, 39)]),
        ("auth:Zx9Kq2LmN8vRt4YpW3sD7fGh1jBc", [(5, 33)]),
        ("https://user:Zx9Kq2LmN8vRt4YpW3sD@git.example.org/team/repo", [(13, 33)]),
        ("https://git.example.org/team?key=Zx9Kq2LmN8vRt4YpW3sD", [(29, 53)]),
        ("user:Zx9Kq2LmN8vRt4YpW3sD@git.example.org", [(5, 25)]),
        ("letters qWzXkVbTjRfGpLhYmCdNsKwQ only", [(8, 32)]),
        ("100%Zx9Kq2LmN8vRt4YpW3sD7fGh1jBc", [(4, 32)]),
        ("internationalization.responsibility.environment.configuration.Zx9Kq2LmN8vRt4YpW3sD7f", [(62, 84)]),
        ("https://cdn.example.org/a1b2/Zx9Kq2LmN8vRt4YpW3sD7f see", []),
        ("url=https://cdn.example.org:8080/Zx9Kq2LmN8vRt4YpW3sD7f", []),
        ("write to q7x9k2m4z8w1v5t3r6p0n.k8j2@mail.example.org.", []),
        ("q7x9k2m4z8w1v5t3r6p0n.cloudfront.net, and www.example.org/q7x9k2m4z8w1v5t3r6p0n", []),
        ("images/q7x9k2m4z8w1v5t3r6p0nK.png:", []),
        ("java.util.concurrent.ConcurrentHashMap and INTERNATIONALIZATION", []),
        ("a-b-c-d-e-f-g-h-i-j-k-l 1.2.3.4.5.6.7.8.9.10.11 3.14159265358979323846264 10.0.19041-beta12+build20240101", []),
        ("SHA1:DA39A3EE5E6B4B0D3255BFEF95601890AFD80709.", []),
    ],
)
def test_random_strings_beside_marks(text, spans):
    found = secrets.random_spans(text, secrets.base_spans(text), secrets.vocabulary(), 2.0)
    assert [(a, b) for _, a, b, _ in found] == spans


def test_random_letters_are_found():
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), n)) for n in range(20, 41) for _ in range(10)]
    assert sum(bool(secrets.random_spans(t, [], secrets.vocabulary(), 2.0)) for t in texts) >= 0.99 * len(texts)


def test_marks_take_linear_time():
    start = time.monotonic()
    for t in ("a.", "1.1-", "a@", "://", "x:y@", "Ab1.", "ab1cd2ef3gh4ij5kl6mn7:", "ab1cd2ef3gh4ij5kl6mn7@"):
        secrets.random_spans(t * 40_000 + "!", [], secrets.vocabulary(), 2.0)
    assert time.monotonic() - start < 20


def test_secret_case_is_ascii():
    assert secrets.base_spans("paſsword=abcdef KPASSWORD: 'abcdef'") == [("assign", 17, 34)]


# --- 4: mixing ---


def test_mixing(spark, docs):
    rows = mixing.plan(docs).collect()
    sizes = {r["doc_id"]: len(words(r["text"])) for r in docs.collect()}
    assert {r["id"]: r["size"] for r in rows} == sizes
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    assert math.isclose(sum(b[0]["target"] for b in by.values()), sum(sizes.values()))
    for own in by.values():
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert sum(r["taken"] for r in own) == round(own[0]["target"])
        assert all(r["taken"] <= 3 * r["size"] for r in own)
        # positions follow the order in which the source is taken
        at = sorted((r["position"] for r in own if r["position"] is not None))
        assert all(0 <= x <= 1 for x in at)
    assert {(r["id"], r["taken"]) for r in mixing.plan(docs, bucket_rows=7).collect()} == {(r["id"], r["taken"]) for r in rows}


def test_mixing_targets(spark):
    def slow(sizes, most=3):
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        total, capped = sum(sizes.values()), set()
        while True:
            free = [s for s in names if s not in capped]
            left = total - sum(most * sizes[s] for s in capped)
            w = sum(weight[s] for s in free)
            t = {s: most * sizes[s] if s in capped else left * weight[s] / w for s in names}
            over = {s for s in free if t[s] > most * sizes[s]}
            if not over:
                return t
            capped |= over

    for sizes in ({"a": 10, "b": 1000, None: 3}, {"a": 0, "b": 0}, {"x": 5}, {str(i): i * i for i in range(12)}, {"a": 1, "b": 100, "c": 100, "d": 1}):
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = slow(sizes)
        assert all(math.isclose(r["target"], want[r["source"]], abs_tol=1e-9) for r in got) and len(got) == len(sizes)


def test_mixed_rows(docs):
    plan = {r["id"]: r for r in mixing.plan(docs).collect()}
    got = defaultdict(list)
    for r in mixing.mix(docs).collect():
        got[r["doc_id"]].append(len(words(r["text"])))
    assert {d: sum(n) for d, n in got.items()} == {d: r["taken"] for d, r in plan.items() if r["taken"]}


def test_schedule_is_inverted(spark):
    for schedule in mixing.SCHEDULES + (((0.0, 0.0), (0.5, 2.0), (1.0, 0.0)),):
        at = [r[0] for r in spark.range(101).select(mixing.position(F.col("id") / 100.0, schedule)).collect()]
        pieces = mixing.integral(schedule)
        for share, t in zip(np.arange(101) / 100, at):
            start, factor, slope, so_far = [p for p in pieces if p[0] <= t + 1e-12][-1]
            assert math.isclose(so_far + factor * (t - start) + slope * (t - start) ** 2 / 2, share, abs_tol=1e-9)


# --- 6: near-duplicates ---


def slow_print(text):
    w = words(lower(text))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64(s.encode("utf-8", "surrogatepass"), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(prints, radius=4):
    ids = sorted(prints)
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates(docs):
    prints = {r["doc_id"]: slow_print(r["text"]) for r in docs.collect()}
    groups = slow_groups(prints)
    got = {r["id"]: (r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (prints[d], groups[d]) for d in prints}
    kept = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
    assert sorted(kept) == sorted(set(groups.values()))


@pytest.mark.parametrize("small", [simhash.SMALL, 2])
def test_links_lose_nothing(spark, monkeypatch, small):
    """Chains and dense clusters of random fingerprints; both ways through a group."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = np.random.default_rng(8)
    fps = set(int(x) for x in rng.integers(0, 2**64, 150, dtype=np.uint64))
    for _ in range(12):
        x = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(25):
            for b in rng.choice(64, rng.integers(1, 7), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    want = slow_groups({i: f for i, f in enumerate(fps)})
    got = simhash.groups(spark.createDataFrame([(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(fps)], "id long, fp long")).collect()
    assert {fps.index(r["fp"] % 2**64): r["component_id"] for r in got} == want
    local = simhash.forest(np.array(fps, np.uint64), 4, simhash.references())
    assert len(local) == len(fps) - len(set(want.values()))


def test_keys_lose_no_pair():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    near = fps.copy()
    for i in range(len(near)):
        for b in rng.choice(64, 4, replace=False):
            near[i] ^= np.uint64(1 << int(b))
    for n, count in ((10, 5), (10**6, 15), (10**9, 35), (10**10, 70)):
        keys = simhash.agreeing(n, 4)
        assert len(keys) == count
        agree = np.zeros(len(fps), bool)
        for key in keys:
            mask = np.uint64(sum((1 << b) - (1 << a) for a, b in key))
            agree |= (fps & mask) == (near & mask)
        assert agree.all()


def test_comparisons_grow_with_the_corpus():
    """Pairs that share a group, over all keys, at sizes 16 times apart."""
    rng = np.random.default_rng(2)

    def compared(n):
        fps, total = rng.integers(0, 2**64, n, dtype=np.uint64), 0
        for key in simhash.agreeing(n, 4):
            _, sizes = np.unique(fps & np.uint64(sum((1 << b) - (1 << a) for a, b in key)), return_counts=True)
            total += int((sizes * (sizes - 1) // 2).sum())
        return total / n

    at = [compared(n) for n in (25_000, 100_000, 400_000)]
    assert max(at) <= 16 * 15 and at[2] < at[0] * 16 ** 0.3


@pytest.mark.parametrize("group", [4, 0.05])
def test_links_by_finer_keys(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", 1)
    keys = simhash.agreeing
    monkeypatch.setattr(simhash, "agreeing", lambda n, radius: keys(1 << (16 if group == 4 else 25), radius))
    test_links_lose_nothing(spark, monkeypatch, 128)


# --- 7: WARC ---


def test_warc_round_trip(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet").limit(20)
    made = warc.derive(warc.responses_of_pages(pages)).cache()
    assert sum(r["records"] for r in warc.write(made, f"file://{tmp_path}/out").collect()) == 40
    back = {r["headers"]["warc-record-id"]: r for r in warc.read(spark, f"{tmp_path}/out").collect()}
    for r in made.collect():
        h, block = back[r["record_id"]]["headers"], bytes(back[r["record_id"]]["block"])
        assert block.decode() == r["block"] and h["warc-refers-to"] == r["refers_to"] and h["warc-type"] == r["warc_type"]
        assert h["warc-block-digest"] == r["block_digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
        if r["warc_type"] == "metadata":
            assert r["source_digest"] in r["block"] and all(line in r["block"] for line in r["source_headers"].split("\r\n"))


def test_warc_responses(spark, tmp_path):
    import gzip

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\nX-A: 1\r\n\r\n"
    page = "<html><title>T\xe9st</title><p>one<br>two &lt;3 &#233;<script>no</script></html>".encode("latin-1")
    record = warc.serialise({"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Target-URI": "http://a", "WARC-Date": "2020-01-01T00:00:00Z"}, http + page)
    info = warc.serialise({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:0>"}, b"software: x\r\n")
    (tmp_path / "a.warc").write_bytes(info + record)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(record))
    got = warc.derive(warc.responses(warc.read(spark, str(tmp_path)))).collect()
    assert [r["block"] for r in got if r["warc_type"] == "conversion"] == ["Tést\none\ntwo <3 é"] * 2
    assert all("source-header: X-A: 1\r\n" in r["block"] and "title: Tést\r\n" in r["block"] for r in got if r["warc_type"] == "metadata")


@pytest.mark.parametrize(("page", "text"), [("", ""), ("a<!-- b -- c", "a"), ("a<b", "a"), ("<p>a</p>\n\n <p> b  c</p>", "a\nb c"), ("<script>x</scr", ""), ("a &amp;lt; b&nbsp;c", "a &lt; b\xa0c"), ("1 < 2 > 0", "1 < 2 > 0")])
def test_plain_text(page, text):
    assert warc.plain_text(page) == text


def test_warc_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "<p>" * 20000)], "page_id long, url string, html string").withColumn("record_id", F.lit("clash"))
    got = warc.derive(warc.responses_of_pages(pages)).collect()
    assert len(got) == 8 and all(r["content_length"] == len(r["block"].encode()) for r in got)
    assert warc.derive(warc.responses_of_pages(pages.limit(0))).count() == 0


def test_tags_against_patterns():
    """Tag by tag, the same is found as by the patterns from every start."""
    rng = np.random.default_rng(6)
    bits = ["<a ", "<A", "<html ", "<meta ", "<title", ">", '"', 'href="', 'lang="', "charset=", "utf-8", " ", "x", "<", "/a", "hrefs", "é", "\n", "<ab"]
    for _ in range(4000):
        page = "".join(rng.choice(bits, rng.integers(1, 25)))
        flags = re.IGNORECASE | re.ASCII
        assert list(warc.LINK.values(page)) == re.findall(warc.LINK_TAG, page, flags), page
        for tags, pattern in ((warc.LANGUAGE, warc.LANGUAGE_TAG), (warc.CHARSET, warc.CHARSET_TAG)):
            m = re.search(pattern, page, flags)
            assert next(tags.values(page), None) == (m[1] if m else None), page
        m = re.search(warc.TITLE_TAG, page, flags)
        assert warc.title(page) == (warc.collapsed(m[1]) if m else ""), page


def test_open_tags_take_linear_time():
    for tag in ("<html ", "<meta ", "<a ", "<title ", '<a href="', "<!--", "<script ", "</script ", '<meta charset="'):
        page = tag * (5_000_000 // len(tag))
        start = time.monotonic()
        list(warc.derive_one("r", "", "", page))
        assert time.monotonic() - start < 5, tag


def test_damaged_warc(spark, tmp_path):
    """What is damaged is reported, the rest is read."""
    import gzip
    import io

    good = [warc.serialise({"WARC-Type": "response", "WARC-Record-ID": f"<urn:uuid:{i}>", "WARC-Concurrent-To": "<a>"}, b"HTTP/1.1 200 OK\r\n\r\n" + bytes([97 + i]) * 50_000) for i in range(4)]
    bad = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nabc\r\n\r\n"
    packed = [gzip.compress(g, mtime=0) for g in good]
    torn = packed[1][:60] + b"\xff" * 30 + packed[1][90:]
    cases = {
        "plain": (good[0] + bad + good[1], [0, 1]),
        "cut": (good[0] + good[1][:-30_000], [0]),
        "noise": (good[0] + b"garbage\nmore\n" + good[1], [0, 1]),
        "packed": (packed[0] + gzip.compress(bad) + packed[2], [0, 2]),
        "packed cut": (packed[0] + packed[1][:-20], [0]),
        "torn": (packed[0] + torn + packed[2] + packed[3], [0, 2, 3]),
        "empty": (b"", []),
    }
    for name, (data, whole) in cases.items():
        got = list(warc.parse(io.BytesIO(data)))
        assert [h["warc-record-id"] for h, _, problem in got if problem is None] == [f"<urn:uuid:{i}>" for i in whole], name
        assert (sum(problem is not None for *_, problem in got) > 0) == (name != "empty"), name
        (tmp_path / f"{name}.warc").write_bytes(data)
    double = warc.serialise({"WARC-Type": "warcinfo"}, b"").replace(b"Content-Length", b"X-A: 1\r\nX-A: 2\r\nContent-Length")
    assert next(warc.parse(io.BytesIO(double)))[0]["x-a"] == "1, 2"
    records = warc.read(spark, str(tmp_path))
    assert records.where("problem is not null").count() >= 6
    assert warc.derive(warc.responses(records)).count() == 2 * sum(len(w) for _, w in cases.values())
    payload = gzip.compress(b"<p>one" + bytes(np.random.default_rng(1).integers(97, 122, 90_000, dtype=np.uint8)))
    assert warc.unzipped(payload[: len(payload) // 2]).startswith(b"<p>one") and warc.unzipped(b"no gzip") == b""


# --- 8: language ---


def test_language(spark, sf, docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = language.identify(docs, training=~out).join(docs.select(F.col("doc_id").alias("id"), "lang", out.alias("out")), "id").where("out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_grams_in_pieces(monkeypatch):
    text = "Ein kurzer Text, and some more of it: ñandú! " * 40
    whole = language.counted(text)
    monkeypatch.setattr(language, "PIECE", 7)
    assert all(np.array_equal(a, b) for a, b in zip(language.counted(text), whole))
    n = len(text.lower().encode()) + 2
    assert whole[1].sum() == (n - 1) + (n - 2) + (n - 3)


def test_language_learns_from_labels_only(spark):
    rows = [(i, " ".join([w] * 9), lang, None, None) for i, (w, lang) in enumerate([("aaaa", "xx"), ("bbbb", "yy"), ("cccc", None), ("dddd", "zz")] * 5)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["id"]: r["lang_pred"] for r in language.identify(docs, training=F.col("lang") != "zz").collect()}
    assert all(got[i] == r[2] for i, r in enumerate(rows) if r[2] in ("xx", "yy")) and "zz" not in got.values()
    assert {r["lang_pred"] for r in language.identify(docs, training=F.lit(False)).collect()} == {"und"}


def test_machine_against_plain_descent():
    """The same margin as a slow subgradient descent on the same objective."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 5))
    y = np.where(x @ np.array([1.0, -2.0, 0.5, 0.0, 1.0]) + 0.3 + rng.normal(size=40) > 0, 1.0, -1.0)
    w = language.train_pair([(np.arange(5), v) for v in x], y, cost=0.5, rounds=3000, size=5)
    z = np.column_stack([x, np.ones(40)])
    cost = lambda w: w @ w / 2 + 0.5 * np.maximum(0, 1 - y * (z @ w)).sum()
    slow, best = np.zeros(6), math.inf
    for t in range(1, 60_000):
        slow -= (slow - 0.5 * (z * y[:, None])[y * (z @ slow) < 1].sum(axis=0)) / (t + 10)
        best = min(best, cost(slow))
    assert cost(w) <= best * 1.0005 and (language.Model.vote([(0, 1, 0), (0, 2, 1), (1, 2, 2)], 3, np.array([-1.0, 2.0, 3.0]))[0]) == 1


def test_many_unlisted_labels(spark, monkeypatch):
    """Labels that no family lists make families of their own; pairs and weights stay few."""
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words_of = {f"x{i:02}": ["".join(rng.choice(letters, 4)) for _ in range(12)] for i in range(40)}
    texts = [(label, " ".join(rng.choice(own, 30))) for label, own in words_of.items() for _ in range(6)]
    family = language.families_of([(label, *language.counted(t)) for label, t in texts])
    sizes = Counter(family.values())
    assert len(sizes) <= 7 and max(sizes.values()) <= 14 and len(family) == 40
    monkeypatch.setattr(language, "WEIGHTS", 1 << 20)
    model = language.Model([(label, *language.counted(t)) for label, t in texts[::2] + texts[1::2][:0]], spark)
    duels = model.weights.shape[1]
    assert duels <= 21 + sum(n * (n - 1) // 2 for n in sizes.values()) and model.weights.size <= 1 << 20
    again = language.Model([(label, *language.counted(t)) for label, t in texts[::2]])
    assert np.array_equal(model.weights, again.weights)
    found = [label for label, _ in model.predict([t for _, t in texts[1::2]])]
    assert np.mean([a == b for a, (b, _) in zip(found, texts[1::2])]) > 0.95


# --- 10: packing ---


def slow_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check_packing(rows, texts, spare=0.02):
    """Every id in one piece; sequences without gaps; little padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for d, text in texts.items():
        ids, at = np.array(slow_ids(tokenizer, text), "<u4"), 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= spare * total


def test_packing(docs):
    check_packing(packing.pack(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_packing_odd(odd):
    unique = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(packing.pack(unique).collect(), {r["doc_id"]: r["text"] for r in unique.collect()}, spare=1)


def test_cuts():
    for n in range(1, 5000):
        got = list(packing.cuts(n))
        assert sum(x for x, _ in got) == n and all(x * k <= 2048 < x * (k + 1) or x * k <= 2048 for x, k in got)


# --- nulls, empty texts, clashing names, empty tables ---


def test_odd_rows(odd):
    n = len(ODD)
    assert pii.find(odd).count() == n
    assert secrets.scan(odd, redact=True).count() == n
    assert mixing.plan(odd).count() == n
    assert lm.score(odd, F.col("doc_id") == 5).count() == n
    near = simhash.near_duplicates(odd).collect()
    assert len(near) == n and {r["component_id"] for r in near if r["id"] in (None, 5)} == {5}
    found = {(r["id"], r["lang_pred"]) for r in language.identify(odd).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und")} <= found
    for kept in (simhash.keep_one(odd), pii.sanitise(odd), mixing.mix(odd)):
        assert kept.columns == odd.columns and kept.count() > 0 and {r["c0"] for r in kept.collect()} == {"clash"}
    assert {r["text"] for r in pii.sanitise(odd).collect() if r["doc_id"] == 8} == {"mail <EMAIL> or <PHONE> now"}


def test_empty_tables(none):
    for empty in (pii.find(none), pii.sanitise(none), secrets.scan(none), mixing.plan(none), mixing.mix(none), lm.score(none, F.lit(False)), simhash.near_duplicates(none), simhash.keep_one(none), language.identify(none), packing.pack(none)):
        assert empty.count() == 0


def test_all_held_out(spark):
    docs = spark.createDataFrame([(1, "a b", None, None, None)], DOCS)
    r = lm.score(docs, F.lit(True)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0)
