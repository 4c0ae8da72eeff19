"""Web archive derivatives (operator 4): responses to linked metadata and
plain-text conversion records.

For each response two records are made. The metadata record holds the source's
HTTP status and headers and facts about the page; the conversion record holds
its plain text. Both refer to the response, keep its URI, date and digests,
and name each other as concurrent. Record ids follow from the response's id,
so a lost task that runs again writes the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.common import small_batches

DATE = "2024-01-01T00:00:00Z"  # of pages that come without one
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace

RESPONSE = ("record_id string, target_uri string, date string, http_headers string, payload binary, "
            "block_digest string, payload_digest string")
RECORD = ("warc_type string, record_id string, refers_to string, refers_to_date string, concurrent_to string, "
          "target_uri string, date string, content_type string, content_length bigint, source_headers string, "
          "source_block_digest string, source_payload_digest string, block_digest string, block binary")

# Elements whose content is not shown, and tags that end a line.
_HIDDEN = re.compile(r"<(script|style|noscript|template|svg|head)\b", re.I)
_CLOSE = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "svg", "head")}
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
                    r"h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z]")
_STOP = re.compile(r"[>\"']")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
_HTML, _LANG = re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_A, _HREF = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '|'.join(parts))}>"


class _Tags:
    """Where the tags of a page end. A tag ends at the first ``>`` outside quotes; one with a
    quote that is never closed has no end. Every ``>`` and quote is looked at once, so
    asking for all tags of a page takes time in proportion to its length."""

    def __init__(self, page: str):
        self.page, self.stop, self.ends = page, (0, -1), {}

    def end(self, at: int) -> int:
        """The place behind the tag whose inside begins at ``at``; -1 without end. Ask from left to right."""
        lo, hi = self.stop  # no stop lies between lo and hi
        if not lo <= at <= hi:
            found = _STOP.search(self.page, at)
            self.stop = lo, hi = at, found.start() if found else len(self.page)
        path, s = [], hi
        while s not in self.ends:
            path.append(s)
            if s >= len(self.page):
                self.ends[s] = -1
            elif self.page[s] == ">":
                self.ends[s] = s + 1
            else:
                close = self.page.find(self.page[s], s + 1)
                found = _STOP.search(self.page, close + 1) if close >= 0 else None
                s = found.start() if found else len(self.page)
        for x in path:
            self.ends[x] = self.ends[s]
        return self.ends[s]


def plain_text(page: str) -> str:
    """Visible text of a page: one line per block, runs of blanks are one space. Comments, scripts
    and the like are left out; a ``<`` that opens nothing that ends is text. One walk
    from left to right, whatever the page holds."""
    out, at, tags, missing = [], 0, _Tags(page), set()
    while (lt := page.find("<", at)) >= 0:
        out.append(page[at:lt])
        if page.startswith("<!--", lt) and "<!--" not in missing:
            end = page.find("-->", lt + 4)
            if end >= 0:
                out.append(" ")
                at = end + 3
                continue
            missing.add("<!--")  # none follows any later comment either
        hidden = _HIDDEN.match(page, lt)
        name = hidden and hidden[1].lower()
        if name and name not in missing:
            close = _CLOSE[name].search(page, hidden.end())
            if close:
                out.append(" ")
                at = close.end()
                continue
            missing.add(name)
        end = tags.end(lt + 2) if _TAG.match(page, lt) else -1
        if end < 0:
            out.append("<")
            at = lt + 1
        else:
            if _BREAK.match(page, lt):
                out.append("\n")
            at = end
    out.append(page[at:])
    lines = (" ".join(x.split()) for x in html.unescape("".join(out)).split("\n"))
    return "\n".join(x for x in lines if x)


def title(page: str) -> str:
    """Text of the first title element that ends."""
    found = _TITLE.search(page)
    start = page.find(">", found.end()) if found else -1
    close = _TITLE_END.search(page, start + 1) if start >= 0 else None
    return " ".join(html.unescape(page[start + 1:close.start()]).split()) if close else ""


def language(page: str) -> str:
    """The ``lang`` of the first html tag that has one."""
    at = 0
    while found := _HTML.search(page, at):
        at = page.find(">", found.end())
        at = len(page) if at < 0 else at
        if lang := _LANG.search(page, found.end(), at):
            return lang[1]
    return ""


def links(page: str) -> int:
    """Number of anchors with a target."""
    n, at, end = 0, 0, -1
    while found := _A.search(page, at):
        if end < found.end():
            end = page.find(">", found.end())
            end = len(page) if end < 0 else end
        href = _HREF.search(page, found.end(), end)
        n, at = (n + 1, href.end()) if href else (n, end)
    return n


def unchunked(body: bytes) -> bytes:
    """A body in chunks put together; as it is if it does not begin with a chunk, and
    what there is of one that breaks off."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0].strip() or b"-", 16)
        except ValueError:
            break
        if size <= 0:
            return b"".join(out) if size == 0 else body
        out.append(body[end + 2:end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out) if out else body


def inflated(body: bytes, bits: int) -> bytes:
    """A gzip or deflate body unpacked, all members; as it is if it is none, and what there is of one
    that breaks off."""
    out, rest = [], body
    while rest:
        d = zlib.decompressobj(bits)
        try:
            out.append(d.decompress(rest))
        except zlib.error:
            break
        rest = d.unused_data
        if bits < 0:
            break
    return b"".join(out) if any(out) else body


def decoded(headers: str, payload: bytes) -> tuple[bytes, list[str]]:
    """The payload without its transfer and content encodings, and encodings that could not be undone."""
    def values(name: str) -> list[str]:
        found = re.findall(rf"(?im)^{name}:[ \t]*([^\r\n]*)", headers)
        return [x.strip().lower() for v in found for x in v.split(",") if x.strip()]

    unread = []
    for coding in [*reversed(values("transfer-encoding")), *reversed(values("content-encoding"))]:
        if unread:
            unread.append(coding)  # inside one that was not undone
        elif coding == "chunked":
            payload = unchunked(payload)
        elif coding in ("gzip", "x-gzip"):
            payload = inflated(payload, 31)
        elif coding == "deflate":  # with the zlib head, or without as some servers send it
            plain = inflated(payload, 15)
            payload = inflated(payload, -15) if plain is payload else plain
        elif coding != "identity":
            unread.append(coding)
    return payload, unread


def charset(headers: str) -> str:
    found = re.search(r"(?im)^content-type:.*?charset=[\"']?([\w.-]+)", headers)
    name = found[1] if found else "utf-8"
    try:
        "".encode(name)
    except (LookupError, ValueError):
        return "utf-8"
    return name


def encode(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


_START = re.compile(rb"WARC/\d+\.\d+\r\n")
GZIP = b"\x1f\x8b\x08"  # fixed value: how a gzip member begins


def decode(data: bytes) -> Iterator[tuple[dict[str, str], bytes] | int]:
    """Records of uncompressed archive bytes as (headers in lower case, block), and for each stretch
    of bytes that are no whole record its length. Behind such a stretch reading
    goes on where the next record begins."""
    at, head = 0, -1  # where the headers that begin at or behind ``at`` end
    while at < len(data):
        got = None
        if _START.match(data, at):
            if head < at:
                head = data.find(b"\r\n\r\n", at)
                head = head if head >= 0 else len(data)
            if head < len(data) and not _START.search(data, at + 1, head):
                got = _record(data, at, head)
        if got:
            headers, block, at = got
            yield headers, block
            continue
        found = _START.search(data, at + 1)
        end = found.start() if found else len(data)
        if data[at:end].strip(b"\r\n"):
            yield end - at
        at = end


def _record(data: bytes, at: int, head: int) -> tuple[dict[str, str], bytes, int] | None:
    headers: dict[str, str] = {}
    name = ""
    for line in data[at:head].decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:  # a folded header
            headers[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            headers[name] = value.strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or head + 4 + int(length) > len(data):
        return None
    stop = head + 4 + int(length)
    block = data[head + 4:stop]
    while data[stop:stop + 2] == b"\r\n":
        stop += 2
    return headers, block, stop


def members_of(data: bytes) -> Iterator[bytes | int]:
    """Unpacked gzip members one after the other (plain data is one member), and the length of each
    stretch that is no whole member. What a damaged member gave before the
    damage is kept."""
    if not data.startswith(GZIP):
        if data:
            yield data
        return
    at = 0
    while at < len(data):
        d = zlib.decompressobj(31)
        part = []
        if data.startswith(GZIP, at):
            try:
                for lo in range(at, len(data), 1 << 16):  # piece by piece, to keep what comes before damage
                    part.append(d.decompress(data[lo:lo + (1 << 16)]))
                    if d.eof:
                        break
            except zlib.error:
                pass
        if any(part):
            yield b"".join(part)
        if d.eof:
            at = min(lo + (1 << 16), len(data)) - len(d.unused_data)
            continue
        found = data.find(GZIP, at + 1)
        end = found if found >= 0 else len(data)
        yield end - at
        at = end


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes] | int]:
    """Records of a WARC file, plain or gzip, and the lengths of skipped stretches (of the file, or of an
    unpacked member)."""
    for part in members_of(data):
        if isinstance(part, int):
            yield part
        else:
            yield from decode(part)


def split_http(block: bytes) -> tuple[str, bytes]:
    """Status line with headers, and the payload, of an HTTP response."""
    head, mark, body = block.partition(b"\r\n\r\n")
    return (head.decode("latin-1"), body) if mark else ("", block)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    # Spark packs files into partitions of bounded size, a larger file is one partition; a file is one
    # value, which Spark bounds at 2 GB (archives are usually split at 1 GB)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response records of the WARC files (plain or gzip) below ``path``, a file to a task, unpacked
    member by member. Damage costs the records it hits; see :func:`damage`."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["content"]:
                rows = []
                for found in records(bytes(data)):
                    if isinstance(found, int) or found[0].get("warc-type", "").lower() != "response":
                        continue
                    h, block = found
                    head, body = split_http(block)
                    rows.append((h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"), head, body,
                                 h.get("warc-block-digest") or digest(block),
                                 h.get("warc-payload-digest") or digest(body)))
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in RESPONSE.split(", ")])

    return _archives(spark, path).select("content").mapInPandas(run, RESPONSE)


def damage(spark: SparkSession, path: str) -> DataFrame:
    """``path, records, stretches, skipped_bytes`` of every WARC file below ``path``: what was read, and
    what is no whole record."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, data in zip(b["path"], b["content"]):
                found = list(records(bytes(data)))
                lost = [x for x in found if isinstance(x, int)]
                rows.append((name, len(found) - len(lost), len(lost), sum(lost)))
            yield pd.DataFrame(rows, columns=["path", "records", "stretches", "skipped_bytes"])

    return _archives(spark, path).mapInPandas(run, "path string, records bigint, stretches bigint, skipped_bytes bigint")


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Crawled pages ``(page_id, url, html)`` as response records, with the ``page_id``.

    A NULL page has an empty payload, a NULL URL an empty target. Record ids
    follow from page_id, URL and payload, so repeated rows share them.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page, url, text in zip(b["page_id"], b["url"], b["html"]):
                body = (text or "").encode("utf-8", "surrogatepass")
                head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(body)}")
                payload = digest(body)
                rows.append((page, urn("response", str(page), url or "", payload), url or "", date, head, body,
                             digest(head.encode("latin-1") + b"\r\n\r\n" + body), payload))
            yield pd.DataFrame(rows, columns=["page_id", *[x.split()[0] for x in RESPONSE.split(", ")]]
                               ).astype({"page_id": "Int64"})

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInPandas(run, "page_id bigint, " + RESPONSE)


def derive(found: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response; columns besides
    those of a response are carried along, as ``in_<name>`` where a record has a
    column of that name. The text is that of the payload without its transfer and
    content encodings (chunked, gzip, deflate; a payload in another one has no
    text, and the metadata names it).

    ``source_headers`` are the response's HTTP status line and headers as they
    came; ``source_*_digest`` are its digests. Payloads that are not text in
    their charset are read with replacement marks. NULL fields are empty.
    """
    small_batches(found.sparkSession)
    own = [x.split()[0] for x in RESPONSE.split(", ")]
    made = [x.split()[0] for x in RECORD.split(", ")]
    found = found.withColumnsRenamed({c: f"in_{c}" for c in found.columns if c in made and c not in own})
    more = [c for c in found.columns if c not in own]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b[[*more, *own]].itertuples(index=False, name=None):
                extra, (rid, uri, date, head, payload, block_digest, payload_digest) = r[:len(more)], r[len(more):]
                head, date, uri, payload = head or "", date or "", uri or "", bytes(payload or b"")
                rid = rid or urn("response", uri, date, digest(payload))
                content, unread = decoded(head, payload)
                page = "" if unread else content.decode(charset(head), "replace")
                about = [*[(f"http-{'status' if i == 0 else 'header'}", x) for i, x in enumerate(head.split("\r\n")) if x],
                         ("title", title(page)), ("language", language(page)), ("outlinks", str(links(page))),
                         ("payload-length", str(len(payload))),
                         *[("decoded-length", str(len(content)))] * (content is not payload),
                         *[("encoding-unread", x) for x in unread]]
                facts = "".join(f"{k}: {v}\r\n" for k, v in about).encode("utf-8", "surrogatepass")
                text = plain_text(page).encode("utf-8", "surrogatepass")
                ids = {"metadata": urn("metadata", rid), "conversion": urn("conversion", rid)}
                for kind, other, mime, block in (
                        ("metadata", "conversion", "application/warc-fields", facts),
                        ("conversion", "metadata", "text/plain; charset=utf-8", text)):
                    rows.append((*extra, kind, ids[kind], rid, date, ids[other], uri, date, mime, len(block), head,
                                 block_digest or "", payload_digest or digest(payload), digest(block), block))
            yield pd.DataFrame(rows, columns=[*more, *made])

    types = "".join(f"`{n}` {t}, " for n, t in found.dtypes if n in more)
    return found.mapInPandas(run, types + RECORD)


def members(records: DataFrame) -> DataFrame:
    """Each derived record as one gzip member (column ``member``): the members of any
    selection, one after the other, are a valid ``.warc.gz`` file."""
    small_batches(records.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                head = [("WARC-Type", r.warc_type), ("WARC-Record-ID", r.record_id), ("WARC-Date", r.date),
                        ("WARC-Target-URI", r.target_uri), ("WARC-Refers-To", r.refers_to),
                        ("WARC-Refers-To-Target-URI", r.target_uri), ("WARC-Refers-To-Date", r.refers_to_date),
                        ("WARC-Concurrent-To", r.concurrent_to), ("WARC-Block-Digest", r.block_digest),
                        ("WARC-Source-Payload-Digest", r.source_payload_digest),
                        ("Content-Type", r.content_type), ("Content-Length", str(r.content_length))]
                out.append(gzip.compress(encode(head, bytes(r.block)), 6, mtime=0))
            yield pd.DataFrame({"record_id": b["record_id"], "warc_type": b["warc_type"], "member": out})

    return records.select(*[x.split()[0] for x in RECORD.split(", ")]).mapInPandas(
        run, "record_id string, warc_type string, member binary")


def derivatives(pages: DataFrame) -> DataFrame:
    """Both derived records of every page, blocks as text."""
    return derive(responses(pages)).withColumn("block", F.col("block").cast("string"))
