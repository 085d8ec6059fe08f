"""WARC derivatives (operator 10): linked metadata and plain-text conversion records from response records.

A response becomes one `metadata` record (title, links, and the source's own headers and digests as fields) and one
`conversion` record (the page's text). Both refer to the response by WARC-Refers-To and carry digests of their own blocks.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPTURED = "2024-01-01T00:00:00Z"
HIDDEN = re.compile(r"(?is)<!--.*?-->|<(script|style|head|noscript|template)\b.*?</\1\s*>")
BREAK = re.compile(r"(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|main|aside|pre|blockquote)\b[^>]*>")
TAG = re.compile(r"<[^>]*>")
TITLE = re.compile(r"(?is)<title\b[^>]*>(.*?)</title\s*>")
LINK = re.compile(r"""(?i)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
RECORD = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, "
    "block_digest string, source_block_digest string, source_payload_digest string, block string"
)
RESPONSE = "page_id long, record_id string, target_uri string, warc_date string, http_headers string, payload string, block_digest string, payload_digest string"


def digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw, usedforsecurity=False).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def _flat(text: str) -> str:
    return " ".join(html.unescape(TAG.sub(" ", text)).split())


def plain_text(page: str) -> str:
    """The visible text, one line for each block that has any."""
    lines = (_flat(x) for x in BREAK.sub("\n", HIDDEN.sub(" ", page)).split("\n"))
    return "\n".join(x for x in lines if x)


def links(page: str, base: str | None) -> list[str]:
    out = []
    for m in LINK.finditer(HIDDEN.sub(" ", page)):
        href = html.unescape(next(x for x in m.groups() if x is not None)).strip()
        try:
            out.append(urljoin(base or "", href))
        except ValueError:  # not a URL: kept as it stands
            out.append(href)
    return list(dict.fromkeys(out))


def _field(text: str) -> str:
    return " ".join(text.split())


def responses(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """Response records of the table `pages` (page_id, url, html): HTTP header lines, payload and digests.

    A null url or html is an empty one; the record id is made of page_id, url and payload, so repeated rows are one record
    written again.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, page in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html")), strict=True):
                raw = (page or "").encode()
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}\r\n"
                own = record_id(str(page_id), url or "", digest(raw))
                rows.append((page_id, own, url, captured, http, page or "", digest(http.encode() + b"\r\n" + raw), digest(raw)))
            yield _batch(rows, build_schema)

    build_schema = _arrow(RESPONSE)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(build, RESPONSE)


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(n, pa.int64() if k == "long" else pa.string()) for n, k in (x.strip().split(" ") for x in ddl.split(","))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def derive(source: DataFrame) -> DataFrame:
    """Two records for each response. An empty page gives an empty conversion and metadata without title and links; null headers
    count as none, a null record id leaves refers_to null. Repeated responses give the same records again."""
    schema = _arrow(RECORD)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                page, url = r["payload"] or "", r["target_uri"]
                title = TITLE.search(page)
                fields = [("title", _flat(title[1]))] if title else []
                fields += [(f"source-{k.strip().lower()}", v) for k, _, v in (x.partition(":") for x in (r["http_headers"] or "").split("\r\n")) if v]
                fields += [(f"source-{k}-digest", r[f"{k}_digest"]) for k in ("block", "payload") if r[f"{k}_digest"]]
                fields += [("outlink", x) for x in links(page, url)]
                metadata = "".join(f"{k}: {_field(v)}\r\n" for k, v in fields)
                for kind, content, block in (("metadata", "application/warc-fields", metadata), ("conversion", "text/plain; charset=utf-8", plain_text(page))):
                    raw = block.encode()
                    rows.append((r["page_id"], kind, record_id(r["record_id"] or str(r["page_id"]), kind), r["record_id"], url, r["warc_date"], content, len(raw),
                                 digest(raw), r["block_digest"], r["payload_digest"], block))
            yield _batch(rows, schema)

    return source.select("page_id", "record_id", "target_uri", "warc_date", "http_headers", "payload", "block_digest", "payload_digest").mapInArrow(build, RECORD)


def serialised(records: DataFrame) -> DataFrame:
    """One column `value`: header lines, an empty line and the block of each record, without the two line ends that close it.

    The source's payload digest stands in WARC-Source-Payload-Digest; a null field has no line.
    """
    lines = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
             ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Source-Payload-Digest", "source_payload_digest"),
             ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    parts = [F.coalesce(F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit("\r\n")), F.lit("")) for name, column in lines]
    return records.select(F.concat(F.lit("WARC/1.1\r\n"), *parts, F.lit("\r\n"), F.col("block")).alias("value"))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files, one for each partition, through Spark's own writer: any store Spark reaches, and retried tasks leave no halves."""
    serialised(records).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)
