"""Secret scan: fixed patterns, then a token-efficiency test for random strings.

A string that a byte-pair vocabulary can only spell in short pieces looks random: its characters per
token are few. Digests and identifiers look alike and are harmless, so their known shapes are excluded.

Defined cases: a null text is an empty one and has no findings; an empty table gives an empty result;
repeated rows give repeated results; columns other than the id and the text are ignored; a null id is kept.
Texts are searched whole, in time linear in their length.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Order of kinds that start at the same place.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs under 24 characters fail and would be dropped; a run that is long enough is taken whole.
HEX = re.compile(r"[0-9a-f]{24,}")

#: Runs of base64 characters; parts joined by single dots are one run.
RUN = re.compile(r"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")
LEAST = 20
#: Known digests and identifiers (fixed forms): MD5, SHA-1, SHA-2 in hex; UUIDs; subresource digests; dates and plain numbers;
#: versions; initials and numbered sections.
HARMLESS = re.compile(
    r"(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128}"
    r"|[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
    r"|sha(?:1|256|384|512)-[A-Za-z0-9+/]+=*|[0-9+/_=.-]+|[+-]?[0-9]+\.[0-9]+[eE][+-]?[0-9]+|[0-9]{8}T[0-9]{6}\.[0-9]+Z?"
    r"|[vV]?[0-9]+\.[0-9]+(?:[-+.][a-z]{0,10}[0-9]{0,10})*"
    r"|(?:[A-Za-z]{1,3}[./_+=-]+)+[A-Za-z]{0,3}|(?:[A-Za-z0-9]{1,3}\.)+[A-Za-z0-9]{1,3})\Z"
)
#: A whole host, with its path, and a whole file name, by known endings (fixed lists); a label in mixed case isn't of a host.
HOST = re.compile(
    r"/*(?:[A-Z]?[a-z0-9-]*\.)+(?:[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|pro|app|dev|cloud|online|site|shop|xyz|tech|club|top"
    r"|example|test|invalid|local|localhost|internal|lan|onion|arpa|museum|travel|jobs|mobi)(?:/.*)?\Z",
    re.DOTALL,
)
FILE = re.compile(
    r".+\.(?i:txt|md|rst|pdf|docx?|xlsx?|pptx?|od[tsp]|csv|tsv|jsonl?|xml|ya?ml|toml|ini|cfg|conf|log|x?html?|s?css|[cm]?js|[jt]sx?|map|py|pyc|ipynb|java|class|jar|c|h|cc|[ch]pp|cs|go|rs|rb|php|pl|sh|bat|ps1|sql|swift|kt|scala|lua"
    r"|jpe?g|png|gif|svg|webp|bmp|tiff?|ico|mp[34]|m4a|wav|ogg|flac|avi|mov|mkv|webm|zip|t?gz|bz2|xz|zst|7z|rar|tar|iso|img|dmg|exe|dll|so|lib|deb|rpm|whl|apk|bin|dat|db|sqlite|parquet|avro|orc|warc|woff2?|ttf|otf|eot|epub|tex|bib|git|lock|bak|tmp)\Z",
    re.DOTALL,
)
MAIL = re.compile(r"(?:mailto:)?[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}\Z")
#: Host and path of a URL; what stands before an @, in a query or in a fragment is tested.
URL = re.compile(r"://(?:[^/?#@]*@)?([A-Za-z0-9+/_=.:%-]*)")
#: Between such characters stands what may be an address as a whole.
WORD = re.compile(r"""[^\s"'`<>(){}\[\],;|]+""")


@functools.cache
def encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Runs that are long enough and no part of an address."""
    words, start, end, urls = WORD.finditer(text), 0, 0, None
    for m in RUN.finditer(text):
        a, b = m.span()
        if b - a < LEAST:
            continue
        while end <= a:
            start, end = next(words).span()
            urls = None
        if urls is None:
            word = text[start:end]
            urls = [(0, len(word))] if MAIL.match(word.strip(".,:!?")) else [u.span(1) for u in URL.finditer(word)] if "://" in word else []
            inside = common.Covered([(start + x, start + y) for x, y in urls if x < y])
        if a and text[a - 1] == ":" and text.startswith("//", a):
            a += 2
        if b - a >= LEAST and not inside(a, b):
            yield a, b


def random_spans(text: str, taken: list[tuple[str, int, int]], path: str, most_chars_per_token: float) -> list[tuple[str, int, int, float]]:
    out = []
    covered = common.Covered([(s, e) for _, s, e in taken])

    def random(a: int, b: int) -> bool:
        s = text[a:b]
        if HARMLESS.match(s) or covered(a, b):
            return False
        ratio = len(s) / len(encoding(path).encode_ordinary(s))
        if ratio <= most_chars_per_token:
            out.append(("random", a, b, ratio))
        return ratio <= most_chars_per_token

    for a, b in candidates(text):
        s = text[a:b]
        if HARMLESS.match(s) or HOST.match(s) or FILE.match(s):
            continue
        parts, at = [], a
        for part in s.split("."):
            parts += [(at, at + len(part))] if len(part) >= LEAST else []
            at += len(part) + 1
        # a run is tested as one; if it isn't random, or a part is harmless, its parts are
        whole = not any(HARMLESS.match(text[x:y]) for x, y in parts) and random(a, b)
        if not whole and "." in s:
            for x, y in parts:
                random(x, y)
    return out


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None, most_chars_per_token: float = 2.0, redact: bool = False) -> DataFrame:
    """(id, spans[, redacted]) for every row. A span: kind, start, end (code points), base, weight (characters per token of a random string)."""
    path = vocabulary_path or vocabulary()
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("spans", common.SPAN)] + ([T.StructField("redacted", T.StringType())] if redact else []))

    def run(cols: dict[str, list]) -> dict[str, list]:
        spans, texts = [], []
        for text in cols[text_col]:
            text = text or ""
            base = base_spans(text)
            found = [(s, KINDS.index(k), e, k, True, None) for k, s, e in base]
            found += [(s, KINDS.index(k), e, k, False, r) for k, s, e, r in random_spans(text, base, path, most_chars_per_token)]
            found.sort(key=lambda x: x[:3])
            spans.append([{"kind": k, "start": s, "end": e, "base": b, "weight": w} for s, _, e, k, b, w in found])
            if redact:
                texts.append(blank(text, [(s, e, k) for s, _, e, k, _, _ in found]))
        return {id_col: cols[id_col], "spans": spans} | ({"redacted": texts} if redact else {})

    return common.map_batches(docs.select(id_col, text_col), run, schema)


def blank(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for s, e, k in sorted(spans):
        if s >= at:
            out += [text[at:s], f"<{k.upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[common.count_kind(spans, k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(common.spans_text(common.base_only(spans)), 256).alias("base_sha256"),
        common.spans_text(spans).alias("spans"),
    )
