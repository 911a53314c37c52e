"""WARC derivatives: metadata and plain-text conversion records of responses.

``responses`` wraps pages as WARC response records (an HTTP head and the
page). ``derive`` turns each response into two linked records:

* a ``metadata`` record (application/warc-fields): status, the source's HTTP
  head, content type, title, out-links, lengths and payload digest;
* a ``conversion`` record (text/plain): the visible text, a line a block.

Both name the response in ``WARC-Refers-To``, keep its target, date and payload
digest (serialised as ``WARC-Refers-To-Target-URI``, ``WARC-Refers-To-Date`` and
``WARC-Source-Payload-Digest``), and carry a block digest of their own.
Digests are SHA-1 in base 32, as the format's tools write them. Record ids
are UUIDs made from type, page id, url and payload, so reruns agree and equal
rows have equal ids.

Null url is an empty target; null html an empty payload; both still give
their two records. A payload that isn't UTF-8 is decoded with replacements.
Line breaks in a header value become blanks. Very long pages are read whole.
Other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import html as _html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: WARC-Date of the wrapped responses: a parameter of the crawl, not of the clock.
CRAWL_DATE = "2024-01-01T00:00:00Z"
RECORD = ("page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
          "content_type string, block_digest string, payload_digest string, block binary")

#: Attributes up to the end of a tag: a quote opens a value only after an equals sign.
_ATTRS = r"(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?)*+(?:>|\Z)"
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title)\b.*?(?:</\1\b[^>]*>|\Z)", re.S | re.I)
_BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head"
                    r"|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|tr|ul)\b" + _ATTRS, re.I)
_TAG = re.compile(r"<[/!?a-zA-Z]" + _ATTRS)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\b|\Z)", re.S | re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)


def sha1(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(kind: str, page_id: int | None, url: str, digest: str) -> str:
    raw = hashlib.sha256(f"{kind}\n{page_id}\n{url}\n{digest}".encode("utf-8", "surrogatepass")).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=raw, version=5)}>"


def _line(value: str) -> str:
    return " ".join(value.split())


def visible_text(page: str) -> str:
    text = _TAG.sub("", _BLOCK.sub("\n", _HIDDEN.sub(" ", page.replace("\n", " "))))
    return "\n".join(t for line in _html.unescape(text).split("\n") if (t := " ".join(line.split())))


def _records(schema: str, make):
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, held = [], 0
            for i in range(b.num_rows):
                rows = list(make(*(c[i].as_py() for c in b.columns)))
                out += rows
                held += sum(len(r[-1]) for r in rows)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)
    return run


def _response(date: str):
    def make(page_id, url, page):
        payload = (page or "").encode("utf-8", "surrogatepass")
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        digest, target = sha1(payload), _line(url or "")
        yield (page_id, "response", record_id("response", page_id, target, digest), None, target, date,
               "application/http; msgtype=response", sha1(head + payload), digest, head + payload)
    return make


def responses(pages: DataFrame, date: str = CRAWL_DATE) -> DataFrame:
    """Response records of ``pages`` (page_id, url, html)."""
    return pages.select("page_id", "url", "html").mapInArrow(_records(RECORD, _response(date)), RECORD)


def derivatives(page_id, source, target, date, block_digest, payload_digest, block) -> Iterator[tuple]:
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *fields = head.decode("utf-8", "replace").split("\r\n")
    page = payload.decode("utf-8", "replace")
    title = _TITLE.search(page)
    links = [_line(_html.unescape(a or b or c)) for a, b, c in _LINK.findall(page)]
    lines = [("status", status), *(("source-header", f) for f in fields), ("source-block-digest", block_digest),
             ("source-payload-digest", payload_digest), ("payload-length", str(len(payload))),
             ("title", _html.unescape(title[1]) if title else ""), *(("outlink", x) for x in links)]
    meta = "".join(f"{k}: {_line(v)}\r\n" for k, v in lines).encode("utf-8", "surrogatepass")
    text = visible_text(page).encode("utf-8", "surrogatepass")
    for kind, content, body in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        digest = sha1(body)
        yield page_id, kind, record_id(kind, page_id, source, digest), source, target, date, content, digest, payload_digest, body


def derive(records: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response record."""
    return (records.filter("warc_type = 'response'")
            .select("page_id", "record_id", "target_uri", "warc_date", "block_digest", "payload_digest", "block")
            .mapInArrow(_records(RECORD, derivatives), RECORD))


def serialise(page_id, warc_type, record, refers_to, target, date, content_type, block_digest, payload_digest, block) -> bytes:
    """One record in the WARC/1.1 format."""
    fields = [("WARC-Type", warc_type), ("WARC-Record-ID", record), ("WARC-Date", date), ("WARC-Target-URI", target or None),
              ("WARC-Refers-To", refers_to), ("Content-Type", content_type), ("WARC-Block-Digest", block_digest),
              ("WARC-Payload-Digest", payload_digest if warc_type == "response" else None),
              # of a derived record: where, when and what its source was
              ("WARC-Refers-To-Target-URI", refers_to and (target or None)), ("WARC-Refers-To-Date", refers_to and date),
              ("WARC-Source-Payload-Digest", refers_to and payload_digest), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def warc_bytes(records: DataFrame) -> DataFrame:
    """(page_id, warc): each record as the bytes of a WARC file; files are their concatenation."""
    schema = "page_id long, warc binary"
    return records.select([c.split()[0] for c in RECORD.split(", ")]).mapInArrow(
        _records(schema, lambda *r: iter([(r[0], serialise(*r))])), schema)


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record in the bytes of a WARC file."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        first, *lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines)
        n = int(head["Content-Length"])
        yield head, raw[end + 4:end + 4 + n]
        at = end + 4 + n + 4
