"""WARC derivatives: a metadata and a plain-text conversion record for every HTTP response.

Both records refer to the response's identifier, carry its target, date and digests, and name each other as
concurrent. The metadata block keeps the source's HTTP headers and adds what the page says of itself: title,
language and outgoing links. Identifiers are derived from the source's, so a recomputed task writes the same
records.

Defined results: a null payload is an empty one; a null target is left out of the headers and links then stay as
written; rows without a page_id work as all others. A page of any length or shape gives both records, text
behind an unclosed comment or script being lost as in a browser. Repeated rows give repeated records, with equal
identifiers because they are the same capture. Other columns are not read. An empty table gives no records.
"""

from __future__ import annotations

import re
from base64 import b32encode
from collections.abc import Iterator
from hashlib import md5, sha1
from html import unescape
from urllib.parse import urljoin
from uuid import UUID

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the record format.
VERSION = "WARC/1.1"
FIELDS = "application/warc-fields"
PLAIN = "text/plain; charset=utf-8"
END = "\r\n\r\n"

DATE = "1970-01-01T00:00:00Z"  # of captures whose table has no date
_BREAKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split())
_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template|noscript|title)\b[^>]*>(?P<inner>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"""|</?(?P<tag>[a-z][a-z0-9]*)\b(?P<rest>(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>|<[!?/a-z][^<>]*+>?|(?P<text>[^<]+|<)""",
    re.I | re.S)
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + b32encode(sha1(data).digest()).decode()


def identifier(*parts: str) -> str:
    return f"<urn:uuid:{UUID(bytes=md5('|'.join(parts).encode('utf-8', 'surrogatepass')).digest(), version=3)}>"


def plain_text(html: str) -> tuple[str, str, str, list[str]]:
    """(text, title, language, links as written) of a page; lines are blocks, without empty ones."""
    out: list[str] = []
    links: list[str] = []
    title = language = ""
    for m in _PIECE.finditer(html):
        text = m["text"]
        if text is not None:
            out.append(text)
            continue
        raw = m["raw"]
        if raw is not None:
            if raw.lower() == "title" and not title:
                title = " ".join(unescape(m["inner"]).split())
            out.append("\n")
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BREAKS:
            out.append("\n")
        if tag == "a" or tag == "html":
            rest = m["rest"]
            if tag == "a" and (link := _HREF.search(rest)):
                links.append(unescape(link[1] or link[2] or link[3] or "").strip())
            elif tag == "html" and not language and (found := _LANG.search(rest)):
                language = found[1]
    text = "".join(out)
    if "&" in text:
        text = unescape(text)
    lines = (" ".join(line.split()) for line in text.splitlines())
    return "\n".join([x for x in lines if x]), title, language, links


def _resolved(base: str | None, link: str) -> str:
    try:
        return urljoin(base or "", link)
    except ValueError:  # not an address
        return link


def _one_line(value: str) -> str:
    return " ".join(value.split())


def _record(kind: str, record_id: str, other: str, source: dict, block: str, content_type: str) -> tuple[str, str, int]:
    """(header, block digest, block length)."""
    data = block.encode("utf-8", "surrogatepass")
    own = digest(data)
    lines = [
        VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Refers-To: {source['record_id']}",
        f"WARC-Concurrent-To: {other}", f"WARC-Date: {source['date']}", f"WARC-Block-Digest: {own}"]
    if source["target_uri"] is not None:
        target = _one_line(source["target_uri"])
        lines += [f"WARC-Target-URI: {target}", f"WARC-Refers-To-Target-URI: {target}"]
    lines += [f"WARC-Refers-To-Date: {source['date']}", f"Content-Type: {content_type}", f"Content-Length: {len(data)}"]
    return "\r\n".join(lines), own, len(data)


_RECORDS = ("page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, "
            "content_type string, content_length long, block_digest string, source_payload_digest string, "
            "source_block_digest string, header string, block string")


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response captures (page_id, target_uri, date, http_header, payload) of `pages` (page_id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                 F.octet_length(payload).cast("string")).alias("http_header"), payload.alias("payload"))


def derivatives(captures: DataFrame) -> DataFrame:
    """Two rows, metadata and conversion, for every row of `captures`; header and block make up the record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                out = [row for source in batch.slice(lo, 256).to_pylist() for row in _derive(source)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64() if i in (0, 7) else pa.string()) for i, column in enumerate(zip(*out))],
                    [x.split()[0] for x in _RECORDS.split(", ")])

    return captures.select("page_id", "target_uri", "date", "http_header", "payload").mapInArrow(run, _RECORDS)


def _derive(source: dict) -> list[tuple]:
    payload = (source["payload"] or "").encode("utf-8", "surrogatepass")
    source["date"] = source["date"] or DATE
    http = source["http_header"] or ""
    payload_digest = digest(payload)
    block_digest = digest(http.encode() + END.encode() + payload)
    target = source["target_uri"]
    source["record_id"] = identifier("response", str(source["page_id"]), target or "", source["date"], block_digest)
    text, title, language, links = plain_text(source["payload"] or "")
    ids = {kind: identifier(kind, source["record_id"]) for kind in ("metadata", "conversion")}
    status, *headers = http.split("\r\n")
    fields = [f"source-payload-digest: {payload_digest}", f"source-block-digest: {block_digest}", f"source-http-status: {status}"]
    fields += [f"source-http-{x}" for x in headers]
    fields += [f"title: {title}"] * bool(title) + [f"language: {language}"] * bool(language)
    fields += [f"outlink: {_one_line(_resolved(target, x))}" for x in links]
    out = []
    for kind, other, block, content in (
            ("metadata", "conversion", "\r\n".join(fields) + "\r\n", FIELDS), ("conversion", "metadata", text, PLAIN)):
        header, own, size = _record(kind, ids[kind], ids[other], source, block, content)
        out.append((source["page_id"], kind, ids[kind], source["record_id"], target, source["date"], content, size, own,
                    payload_digest, block_digest, header, block))
    return out


def write(records: DataFrame, path: str) -> None:
    """Write records (header, block) as gzipped WARC files; every record ends with two line breaks."""
    records.select(F.concat("header", F.lit(END), "block")).write.option("lineSep", END).option("compression", "gzip").text(path)
