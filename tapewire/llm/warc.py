"""WARC derivatives: metadata and plain-text conversion records of response records.

A response is a row with its record id, target URI, date, the headers of its HTTP message and
its body. From each the builder makes two records that refer to it: a ``metadata`` record
with fields about the page, its source headers and the response's digest, and a
``conversion`` record with the page's text. Records are rows too; written as text they are
WARC files, which the reader takes apart again.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewire.llm.store import bound_batches

RESPONSE = (
    "page_id long, record_id string, target_uri string, date string, http_headers string, "
    "body string, payload_digest string"
)
RECORD = (
    "page_id long, warc_type string, record_id string, refers_to string, target_uri string, "
    "date string, content_type string, content_length long, block_digest string, "
    "source_digest string, block string"
)
# Rows of one file that a reader takes apart in one task.
FILE_ROWS = 50_000
_SPACE_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: URL namespace

_BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|"
    "footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|"
    "thead|tr|ul"
)
_HIDDEN = (
    r"<!--.*?(?:-->|\Z)|<(?P<{0}>script|style|noscript|template)\b[^>]*>.*?(?:</(?P={0})\s*>|\Z)"
)
# A head ends, also where its end tag is left out, before the first text that is not the title's
# and before the first block element.
_SILENT = re.compile(
    _HIDDEN.format("kind")
    + r"|<head\b[^>]*>(?:\s+|"
    + _HIDDEN.format("within")
    + rf"|<title\b[^>]*>(?:(?!</?(?:title|head|{_BLOCKS})\b).)*"
    + rf"|<(?!/?(?:head|{_BLOCKS})\b)[A-Za-z/!?][^>]*>)*",
    re.S | re.I,
)
_BREAKS = re.compile(rf"</?(?:{_BLOCKS})\b[^>]*>", re.I)
_TAG = re.compile(r"</?[A-Za-z][^>]*>|<![^>]*>|<\?[^>]*>")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def digest(data: bytes) -> str:
    """A labelled SHA-1 digest in base 32, as WARC headers have it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE_IDS, ' '.join(map(str, parts)))}>"


def page_text(page: str) -> str:
    """The text of an HTML page: block elements end lines, and markup, comments, scripts,
    styles and the head are left out."""
    text = _TAG.sub("", _BREAKS.sub("\n", _SILENT.sub("", page)))
    text = _BLANKS.sub(" ", html.unescape(text) if "&" in text else text)
    return _LINES.sub("\n", text).strip()


def _clean(value: str) -> str:
    """A field value on one line."""
    return " ".join(html.unescape(value).split())


def _fields(headers: str, body: str, source_digest: str) -> str:
    """The block of a metadata record, as application/warc-fields."""
    out = [("source-payload-digest", source_digest)]
    lines = [x for x in headers.replace("\r\n", "\n").split("\n") if x.strip()]
    if lines:
        out.append(("source-status-line", lines[0].strip()))
    for line in lines[1:]:
        name, _, value = line.partition(":")
        out.append((f"source-header-{name.strip().lower()}", value.strip()))
    # Links and title of what is no comment or script.
    bare = re.sub(r"<!--.*?(?:-->|\Z)", "", body, flags=re.S)
    if found := _TITLE.search(bare):
        out.append(("title", _clean(found[1])))
    if found := _LANG.search(bare):
        out.append(("languages-html", found[1].lower()))
    out += [("outlink", _clean(a or b or c)) for a, b, c in _LINK.findall(bare)]
    return "".join(f"{name}: {value}\r\n" for name, value in out)


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for page, url, date, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            body = body or ""
            raw = body.encode()
            headers = (
                "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {len(raw)}\r\n"
            )
            found = digest(raw)
            rows.append((page, _id("response", page, url, date, found), url, date, headers, body,
                         found))
        yield _batch(rows, RESPONSE)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64() if x.endswith(" long") else pa.string() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def responses(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, date, html) as response records with plain HTTP headers.

    For tables that keep no headers; a null page has an empty body. Repeated rows get the
    same record id. Other columns are not read.
    """
    bound_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.col("date").cast("string"), "html"
    )
    return rows.mapInArrow(_responses, RESPONSE)


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RESPONSE.split(", ")]
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part = batch.slice(low, 500)
            rows = []
            columns = (part.column(n).to_pylist() for n in names)
            for page, source, url, date, headers, body, found in zip(*columns, strict=True):
                body = body or ""
                found = found or digest(body.encode())
                made = [
                    ("metadata", "application/warc-fields", _fields(headers or "", body, found)),
                    ("conversion", "text/plain; charset=utf-8", page_text(body)),
                ]
                for kind, content, block in made:
                    raw = block.encode()
                    rows.append((page, kind, _id(kind, source), source, url, date, content,
                                 len(raw), digest(raw), found, block))
            yield _batch(rows, RECORD)


def derivatives(found: DataFrame) -> DataFrame:
    """Two records (``RECORD``) for each response (``RESPONSE``): metadata and conversion.

    Both refer to the response's record id and keep its URI, date and payload digest; a digest
    that is null is computed from the body. Record ids follow from the response's. A null or
    empty body gives an empty text and a record all the same; null headers, URI and date are
    left out. Repeated responses give repeated records. Other columns are not read.
    """
    bound_batches(found.sparkSession)
    names = [x.split()[0] for x in RESPONSE.split(", ")]
    return found.select(*names).mapInArrow(_derive, RECORD)


def _head(name: str, value: str):
    """A header line, or nothing where the value is null."""
    return F.concat(F.lit(f"{name}: "), F.col(value).cast("string"), F.lit("\r\n"))


def write_warc(records: DataFrame, path: str) -> None:
    """Records as WARC 1.1 files, one after another with the blank lines that end each."""
    lines = [
        F.lit("WARC/1.1\r\n"),
        _head("WARC-Type", "warc_type"),
        _head("WARC-Record-ID", "record_id"),
        _head("WARC-Refers-To", "refers_to"),
        _head("WARC-Target-URI", "target_uri"),
        _head("WARC-Date", "date"),
        _head("WARC-Block-Digest", "block_digest"),
        _head("X-Source-Payload-Digest", "source_digest"),
        _head("X-Page-ID", "page_id"),
        _head("Content-Type", "content_type"),
        _head("Content-Length", "content_length"),
        F.lit("\r\n"),
        F.col("block"),
    ]
    text = records.select(F.concat_ws("", *lines).alias("value"))
    # Every row ends with two line ends, which is what ends a record.
    text.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", FILE_ROWS).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names lowered) and block of each record of a WARC file."""
    at = 0
    while (begin := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", begin)
        lines = data[begin:end].decode().split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        at = end + 4 + int(headers["content-length"])
        yield headers, data[end + 4 : at]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = {
        "warc_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to",
        "target_uri": "warc-target-uri", "date": "warc-date", "content_type": "content-type",
        "block_digest": "warc-block-digest", "source_digest": "x-source-payload-digest",
    }
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for headers, block in parse(content.as_py()):
                row = {k: headers.get(v) for k, v in names.items()}
                page = headers.get("x-page-id")
                row |= {"page_id": page and int(page), "content_length": len(block),
                        "block": block.decode()}
                rows.append(tuple(row[x.split()[0]] for x in RECORD.split(", ")))
            yield _batch(rows, RECORD)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files written by ``write_warc``, a file in a task."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse, RECORD)
