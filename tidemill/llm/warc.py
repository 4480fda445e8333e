"""WARC derivatives: a metadata and a plain-text conversion record for every response.

Both records name the response they were made from (WARC-Refers-To) and its address and date; its HTTP headers and
payload digest go into the metadata record, which also names the conversion. Record ids are made from the response's
id, so a second run gives the same ones. Responses come from WARC files (``read`` and ``responses``) or from a table of
pages (``responses_of_pages``); ``write`` makes compressed WARC files, one a partition.

Text: comments and the contents of script, style, noscript and template go; block elements end lines; other tags go;
character references are decoded; white space is collapsed and empty lines are dropped. What is cut off inside a tag,
comment or script at the end of a page goes too.

All patterns take time linear in the page, also where tags are never closed.

Defined cases: null HTML is an empty page (its text is empty); a null address stays null; repeated rows give repeated
records with the same ids; an empty table gives an empty result; other columns are ignored. A damaged record of a WARC
file (no WARC line, no length, cut off, not decompressed) is a row that says so in ``problem``, and reading goes on
at the next record that is whole; headers that come several times are joined by commas. A payload whose compression is
damaged counts as far as it could be decompressed.
"""

from __future__ import annotations

import gzip
import hashlib
import html
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.mirror import open_path
from . import common

DATE = "2024-01-01T00:00:00Z"
SILENT = ("script", "style", "noscript", "template")
#: Elements that end a line (fixed values of HTML).
BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
DROPPED = "|".join(["<!--.*?(?:-->|\\Z)", *[f"<{s}\\b[^>]*(?:>.*?(?:</{s}\\s*>|\\Z)|\\Z)" for s in SILENT]])
DROP = re.compile(DROPPED, re.IGNORECASE | re.DOTALL | re.ASCII)
BLOCK_TAG = f"</?(?:{BLOCKS})\\b[^>]*(?:>|\\Z)"
BLOCK = re.compile(BLOCK_TAG, re.IGNORECASE | re.ASCII)
ANY_TAG = "<[/!?a-zA-Z][^>]*(?:>|\\Z)"
TAG = re.compile(ANY_TAG)
SPACES, LINES = re.compile("[ \t\r\f\v]+"), re.compile(" ?\n[ \n]*")
#: What is looked for; each start of a tag would look up to the end of the page, so pages are searched tag by tag instead.
TITLE_TAG = "<title[^>]*>([^<]*)"
LANGUAGE_TAG = "<html\\b[^>]*?\\blang=\"([^\"]*)\""
CHARSET_TAG = "<meta\\b[^>]*?\\bcharset=\"?([\\w-]+)"
LINK_TAG = "<a\\b[^>]*?\\bhref=\"([^\"]*)\""


class Tags:
    """``LANGUAGE_TAG`` and the like, one tag after another: what an open tag lacks up to its end, tags that start in it lack too."""

    def __init__(self, tag: str, attribute: str, quoted: bool):
        self.tag, self.attribute, self.quoted = re.compile(tag, re.IGNORECASE | re.ASCII), re.compile(attribute, re.IGNORECASE | re.ASCII), quoted

    def values(self, page: str) -> Iterator[str]:
        at, end = 0, -1
        while m := self.tag.search(page, at):
            if end < m.end():
                end = page.find(">", m.end())
                end = len(page) if end < 0 else end
            at = end
            if found := self.attribute.search(page, m.end(), end):
                if not self.quoted:
                    yield found[1]
                elif (close := page.find('"', found.end())) >= 0:
                    yield page[found.end() : close]
                    at = close + 1


LANGUAGE, CHARSET, LINK = Tags(r"<html\b", r'\blang="', True), Tags(r"<meta\b", r'\bcharset="?([\w-]+)', False), Tags(r"<a\b", r'\bhref="', True)
TITLE = re.compile("<title", re.IGNORECASE | re.ASCII)

RECORDS = T.StructType(
    [
        T.StructField("warc_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("warc_date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("block_digest", T.StringType()),
        T.StructField("source_digest", T.StringType()),
        T.StructField("source_headers", T.StringType()),
        T.StructField("block", T.StringType()),
    ]
)


def collapsed(text: str) -> str:
    return LINES.sub("\n", SPACES.sub(" ", text)).strip(" \n")


def plain_text(page: str) -> str:
    text = TAG.sub("", BLOCK.sub("\n", DROP.sub(" ", page)))
    return collapsed(html.unescape(text) if "&" in text else text)


def derived_id(source_id: str | None, kind: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{kind}|{source_id or ""}'.encode()).hexdigest())}>"


def digest(data: bytes) -> str:
    return f"sha256:{hashlib.sha256(data).hexdigest()}"


def title(page: str) -> str:
    m = TITLE.search(page)
    start = page.find(">", m.end()) + 1 if m else 0
    end = page.find("<", start)
    return collapsed(html.unescape(page[start : end if end >= 0 else len(page)])) if start else ""


def first(tags: Tags, page: str) -> str:
    return collapsed(html.unescape(next(tags.values(page), "")))


def derive_one(record_id: str | None, headers: str, payload_digest: str, page: str) -> Iterator[tuple[str, str, str, bytes]]:
    """(type, id, content type, block) of both records."""
    conversion = derived_id(record_id, "conversion")
    fields = [("title", title(page)), ("language", first(LANGUAGE, page)), ("charset", first(CHARSET, page)), ("source-payload-digest", payload_digest), ("conversion", conversion)]
    fields += [("source-header", line) for line in headers.splitlines() if line]
    fields += [("outlink", html.unescape(link)) for link in LINK.values(DROP.sub(" ", page))]
    yield "metadata", derived_id(record_id, "metadata"), "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    yield "conversion", conversion, "text/plain; charset=utf-8", plain_text(page).encode("utf-8", "surrogatepass")


def derive(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two records for each of ``responses`` (record_id, target_uri, warc_date, headers, payload_digest, page), with columns to keep in front."""
    kept = [T.StructField(f"k{i}", responses.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*kept, *RECORDS.fields])

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {f.name: [] for f in schema}
        for i, (record_id, uri, date, headers, payload_digest, page) in enumerate(zip(*[cols[c] for c in ("record_id", "target_uri", "warc_date", "headers", "payload_digest", "page")])):
            for kind, own, content_type, block in derive_one(record_id, headers or "", payload_digest or "", page or ""):
                row = [*[cols[k.name][i] for k in kept], kind, own, record_id, uri, date, content_type, len(block), digest(block), payload_digest, headers, block.decode("utf-8", "surrogatepass")]
                for column, value in zip(out.values(), row):
                    column.append(value)
        return out

    source = responses.select(*[F.col(c).alias(k.name) for c, k in zip(keep, kept)], "record_id", "target_uri", "warc_date", "headers", "payload_digest", "page")
    made = common.map_batches(source, run, schema)
    return made.select(*[F.col(k.name).alias(c) for c, k in zip(keep, kept)], *RECORDS.names)


def as_uuid(hexes: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(hexes, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def responses_of_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """(source_id, record_id, target_uri, warc_date, headers, payload_digest, page) as a crawler would have stored the pages."""
    page = F.coalesce(F.col(html_col), F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(page).cast("string"), F.lit("\r\n"))
    name = F.concat(F.lit("response|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(url_col), F.lit("")))
    return pages.select(F.col(id_col).alias("source_id"), as_uuid(F.md5(name)).alias("record_id"), F.col(url_col).alias("target_uri"), F.lit(date).alias("warc_date"), headers.alias("headers"), F.concat(F.lit("sha256:"), F.sha2(page, 256)).alias("payload_digest"), page.alias("page"))


# --- WARC files ---


class Damaged(Exception):
    pass


class Bytes:
    """The bytes of a plain or a compressed stream, a piece at a time. Damage is raised once; reading goes on behind it."""

    MAGIC = b"\x1f\x8b\x08"

    def __init__(self, stream):
        self.stream, self.held, self.raw = stream, b"", stream.read(1 << 16)
        self.packed = self.raw.startswith(self.MAGIC[:2])
        self.member = None

    def more(self) -> bool:
        """Hold some more bytes; False at the end."""
        if not self.raw:
            self.raw = self.stream.read(1 << 16)
        if not self.packed:
            out, self.raw = self.raw, b""
        else:
            out = b""
            while not out:
                self.raw = self.raw or self.stream.read(1 << 16)
                if not self.raw:
                    cut, self.member = self.member is not None, None
                    if cut:
                        raise Damaged("the last member is cut off")
                    return False
                self.member = self.member or zlib.decompressobj(31)
                try:
                    out = self.member.decompress(self.raw, 1 << 20)
                except zlib.error as e:
                    self.skip()
                    raise Damaged(f"not decompressed: {e}") from None
                self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
                if self.member.eof:
                    self.member = None
        self.held += out
        return bool(out)

    def skip(self) -> None:
        """To where the next member seems to start."""
        self.member, raw = None, self.raw[1:]
        while (at := raw.find(self.MAGIC)) < 0 and (new := self.stream.read(1 << 16)):
            raw = raw[-2:] + new
        self.raw = raw[at:] if at >= 0 else b""

    def readline(self) -> bytes:
        """Up to a line's end; at most 1 MB of a line."""
        parts, size = [], 0
        while True:
            at = self.held.find(b"\n") + 1
            part, self.held = (self.held[:at], self.held[at:]) if at else (self.held, b"")
            parts.append(part)
            size += len(part)
            if at or size > 1 << 20 or not self.more():
                return b"".join(parts)

    def read(self, n: int) -> bytes:
        parts = []
        while n > 0 and (self.held or self.more()):
            parts.append(self.held[:n])
            self.held = self.held[n:]
            n -= len(parts[-1])
        if n > 0:
            raise Damaged(f"{n} bytes are missing")
        return b"".join(parts)


def parse(stream) -> Iterator[tuple[dict[str, str], bytes | None, str | None]]:
    """(headers in lower case, block, problem) of each record of a plain or a compressed stream."""
    source, lost = Bytes(stream), False
    while True:
        headers: dict[str, str] = {}
        try:
            line = source.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                if line.strip() and not lost:
                    lost = True
                    raise Damaged(f"not a WARC record: {line[:40]!r}")
                continue  # up to the next record
            lost, last = False, None
            while (line := source.readline().rstrip(b"\r\n")) != b"":
                text = line.decode("utf-8", "replace")
                if text[0] in " \t" and last:
                    headers[last] += " " + text.strip()
                    continue
                name, _, value = text.partition(":")
                last = name.strip().lower()
                headers[last] = f"{headers[last]}, {value.strip()}" if last in headers else value.strip()
            length = headers.get("content-length", "")
            if not (length.isascii() and length.isdigit()):
                lost = True
                raise Damaged(f"no length: {length!r}")
            block = source.read(int(length))
        except Damaged as e:
            lost = True
            yield headers, None, str(e)
            continue
        yield headers, block, None


def serialise(headers: dict[str, str | None], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def read(spark, path: str) -> DataFrame:
    """(headers, block, problem) of the records of WARC files, from any store that Spark reads; a file is one task.

    Files are streamed where pyarrow knows the store too; otherwise Spark hands over the whole file, of 2 GB at most.
    """
    schema = T.StructType([T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("block", T.BinaryType()), T.StructField("problem", T.StringType())])
    kind = pa.schema([("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary()), ("problem", pa.string())])
    files = spark.read.format("binaryFile").load(path)
    probe = files.select("path").first()
    streamed = probe is not None and known_to_arrow(probe[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0):
                with opened(file.as_py()) if streamed else io.BytesIO(file.as_buffer()) as stream:
                    held, size = [], 0
                    for headers, block, problem in parse(stream):
                        held.append((list(headers.items()), block, problem))
                        size += len(block or b"")
                        if size > 8 << 20:
                            yield rows(held)
                            held, size = [], 0
                    yield rows(held)

    def rows(held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], f.type) for i, f in enumerate(kind)], schema=kind)

    return common.small_batches(files.select("path" if streamed else "content")).mapInArrow(run, schema)


def known_to_arrow(path: str) -> bool:
    try:
        open_path(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def opened(path: str):
    store, base = open_path(path)
    return store.open_input_stream(base, compression=None)


def unzipped(data: bytes) -> bytes:
    """As far as it goes."""
    out, member = [], zlib.decompressobj(31)
    try:
        for a in range(0, len(data), 1 << 14):
            out.append(member.decompress(data[a : a + (1 << 14)]))
    except zlib.error:
        pass
    return b"".join(out)


def responses(records: DataFrame) -> DataFrame:
    """Response records of ``read`` in the form that ``derive`` takes; the payload is decoded by its declared charset."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("record_id", "target_uri", "warc_date", "headers", "payload_digest", "page")])

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in schema.names}
        for headers, block in zip(cols["headers"], cols["block"]):
            h = dict(headers)
            head, _, payload = block.partition(b"\r\n\r\n")
            http = head.decode("iso-8859-1") + "\r\n"
            if re.search(r"(?im)^content-encoding:\s*gzip", http):
                payload = unzipped(payload)
            charset = re.search(r"(?im)^content-type:.*charset=\"?([\w-]+)", http)
            try:
                page = payload.decode(charset[1] if charset else "utf-8", "replace")
            except LookupError:
                page = payload.decode("utf-8", "replace")
            for c, v in zip(schema.names, (h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"), http, h.get("warc-payload-digest") or digest(payload), page)):
                out[c].append(v)
        return out

    whole = F.col("block").isNotNull() & (F.col("headers")["warc-type"] == "response")
    return common.map_batches(records.where(whole), run, schema)


def write(records: DataFrame, path: str) -> DataFrame:
    """Write derivative records as compressed WARC files, one a partition; an action. Returns (file, records).

    A file gets its name once it is whole, and a task that runs again writes the same one.
    """
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("records", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base)
        name = f"{base}/part-{TaskContext.get().partitionId():05d}.warc.gz"
        part, n = f"{name}.{TaskContext.get().taskAttemptId()}", 0
        with store.open_output_stream(part, compression=None) as out:
            for batch in batches:
                for r in batch.to_pylist():
                    h = {"WARC-Type": r["warc_type"], "WARC-Record-ID": r["record_id"], "WARC-Date": r["warc_date"], "WARC-Target-URI": r["target_uri"], "WARC-Refers-To": r["refers_to"], "WARC-Block-Digest": r["block_digest"], "Content-Type": r["content_type"]}
                    out.write(gzip.compress(serialise(h, r["block"].encode("utf-8", "surrogatepass")), mtime=0))
                    n += 1
        store.move(part, name)
        yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]}, schema=pa.schema([("file", pa.string()), ("records", pa.int64())]))

    done = common.small_batches(records).select(*RECORDS.names).mapInArrow(run, schema).collect()  # a row for each file
    return records.sparkSession.createDataFrame(done, schema)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    return derive(responses_of_pages(common.table(spark, sf_dir, "pages")).withColumnRenamed("source_id", "page_id"), keep=("page_id",))


def sql() -> str:
    """For DuckDB; of character references, it decodes those that the table has."""
    rx = lambda p: p.replace("\\Z", "\\z").replace("'", "''")
    decode = lambda x: f"regexp_replace(replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&amp;?', '&', 'g')"
    collapse = lambda x: f"trim(regexp_replace(regexp_replace({x}, '[ \\t\\r\\f\\v]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"
    as_id = lambda x: f"'<urn:uuid:' || regexp_replace(md5({x}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') || '>'"
    first = lambda p: collapse(decode(f"regexp_extract(page, '{rx(p)}', 1, 'i')"))
    return f"""
with source as (
  select page_id, url as target_uri, coalesce(html, '') as page, {as_id("'response|' || coalesce(page_id::varchar, '') || '|' || coalesce(url, '')")} as refers_to
  from pages
), named as (
  select *, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(page) || chr(13) || chr(10) as source_headers,
    'sha256:' || sha256(page) as source_digest, {as_id("'conversion|' || refers_to")} as conversion_id, {as_id("'metadata|' || refers_to")} as metadata_id,
    regexp_replace(page, '{rx(DROPPED)}', ' ', 'gis') as visible
  from source
), blocks as (
  select *, {collapse(decode(f"regexp_replace(regexp_replace(visible, '{rx(BLOCK_TAG)}', chr(10), 'gi'), '{rx(ANY_TAG)}', '', 'g')"))} as conversion,
    'title: ' || {first(TITLE_TAG)} || chr(13) || chr(10) || 'language: ' || {first(LANGUAGE_TAG)} || chr(13) || chr(10) || 'charset: ' || {first(CHARSET_TAG)} || chr(13) || chr(10)
    || 'source-payload-digest: ' || source_digest || chr(13) || chr(10) || 'conversion: ' || conversion_id || chr(13) || chr(10)
    || 'source-header: HTTP/1.1 200 OK' || chr(13) || chr(10) || 'source-header: Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'source-header: Content-Length: ' || strlen(page) || chr(13) || chr(10)
    || array_to_string(list_transform(regexp_extract_all(visible, '{rx(LINK_TAG)}', 1, 'i'), lambda x: 'outlink: ' || {decode('x')} || chr(13) || chr(10)), '') as metadata
  from named
), records as (
  select *, 'metadata' as warc_type, metadata_id as record_id, 'application/warc-fields' as content_type, metadata as block from blocks
  union all by name
  select *, 'conversion' as warc_type, conversion_id as record_id, 'text/plain; charset=utf-8' as content_type, conversion as block from blocks
)
select page_id, warc_type, record_id, refers_to, target_uri, '{DATE}' as warc_date, content_type, strlen(block)::bigint as content_length,
  'sha256:' || sha256(block) as block_digest, source_digest, source_headers, block
from records
"""
