"""WARC derivatives: response records become linked metadata and plain-text conversion records.

A response keeps its own id where it has one, else it is derived from its URI and payload, so
derivatives can be made again at any time; each refers to its response by WARC-Refers-To, carries
the response's headers, and has digests of the payload and of its own block.  Pages are read
once from left to right, in time linear in their length, however malformed.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import io
import json
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.shared import settled

SCHEMA = "page_id long, record_type string, record_id string, refers_to string, target_uri string, content_type string, content_length long, block_digest string, headers map<string,string>, block string"
#: Headers of a response whose source gives none.
SOURCE_HEADERS = (("Content-Type", "text/html; charset=utf-8"),)

#: Elements whose content is no text; it ends at their end tag only.
_RAW = {k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "template", "noscript", "title", "textarea")}
_BREAKS = frozenset("p div br li ul ol tr table h1 h2 h3 h4 h5 h6 article section nav header footer blockquote pre hr dd dt dl figure form main aside body".split())
_LINKS = {"a": "href", "link": "href", "img": "src", "script": "src", "iframe": "src"}
_NAME = re.compile(r"/?[a-zA-Z][\w:-]*")
#: The rest of a tag: ">" ends it, but not within a quoted value; a quote that never closes is a sign like others.  Nothing is tried twice.
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+>")
_ATTR = re.compile(r"(?<![\w:-])([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def read_page(html: str) -> tuple[str, dict]:
    """Visible text and metadata (title, lang, metas, links), in one pass from left to right.

    Comments, head, and the elements whose content is no text are left out, block elements
    break lines, entities are resolved, blanks are squeezed.  A comment or such an element
    that never ends hides the rest; a head ends at its end tag or at body; a tag ends at
    the next ">" outside of a quoted value, and without one the rest is text.
    """
    out: list[str] = []
    found: dict = {"title": None, "lang": None, "metas": [], "links": []}
    at, head = 0, False

    def say(a: int, b: int) -> None:
        if not head and a < b:
            out.append(entities.unescape(html[a:b]))

    while (tag := html.find("<", at)) >= 0:
        say(at, tag)
        if html.startswith("<!--", tag):
            end = html.find("-->", tag + 4)
            out.append(" ")
            at = end + 3 if end >= 0 else len(html)
            continue
        if html[tag + 1 : tag + 2] not in _OPENERS:
            say(tag, tag + 1)
            at = tag + 1
            continue
        if html[tag + 1] in "!?":
            end = html.find(">", tag + 1)
        else:
            end = whole.end() - 1 if (whole := _REST.match(html, tag + 1)) else -1
        if end < 0:
            say(tag, len(html))
            at = len(html)
            break
        at = end + 1
        if not (m := _NAME.match(html, tag + 1, end)):
            continue
        name = m[0].lower()
        if name in ("meta", "html") or name in _LINKS:
            attrs = [(k, a or b or c) for k, a, b, c in _ATTR.findall(html[m.end() : end])]
            if name == "meta":
                found["metas"].append({k.lower(): v for k, v in attrs})
            elif name == "html":
                found["lang"] = found["lang"] or next((v for k, v in attrs if k.lower() == "lang"), None)
            elif url := next((v for k, v in attrs if k.lower() == _LINKS[name]), None):
                found["links"].append({"path": name, "url": entities.unescape(url)})
        if name in _RAW:
            close = _RAW[name].search(html, at)
            if name == "title" and close and found["title"] is None:
                found["title"] = " ".join(entities.unescape(html[at : close.start()]).split())
            out.append(" ")
            at = close.end() if close else len(html)
        elif name in ("head", "/head", "body"):
            head = name == "head"
        if name.lstrip("/") in _BREAKS:
            out.append("\n")
    say(at, len(html))
    lines = (" ".join(x.split()) for x in "".join(out).split("\n"))
    return "\n".join(x for x in lines if x), found


_OPENERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ/!?")


def plain_text(html: str) -> str:
    return read_page(html)[0]


def response_id(uri: str, payload: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, uri + ' ' + digest(payload))}>"


def derivatives(uri: str | None, html: str | None, source_headers=SOURCE_HEADERS, record_id: str | None = None) -> Iterator[tuple]:
    """The metadata and the conversion record of a response, as tuples of SCHEMA without page_id."""
    uri, body = uri or "", html or ""
    payload = body.encode("utf-8", "replace")
    source = record_id or response_id(uri, payload)
    text, about = read_page(body)
    shared = {"WARC-Target-URI": uri, "WARC-Refers-To": source, "WARC-Payload-Digest": digest(payload)}
    envelope = {
        "Envelope": {
            "WARC-Header-Metadata": {"WARC-Type": "response", "WARC-Record-ID": source, "WARC-Target-URI": uri, "WARC-Payload-Digest": digest(payload)},
            "Payload-Metadata": {"HTTP-Response-Metadata": {"Headers": dict(source_headers), "HTML-Metadata": about, "Entity-Length": len(payload)}},
        }
    }
    for kind, mime, block in (("metadata", "application/json", json.dumps(envelope, ensure_ascii=False, sort_keys=True)), ("conversion", "text/plain", text)):
        data = block.encode("utf-8", "replace")
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, source + ' ' + kind)}>"
        headers = {"WARC-Type": kind, "WARC-Record-ID": own} | shared | {f"X-Source-{k}": v for k, v in source_headers} | {"WARC-Block-Digest": digest(data), "Content-Type": mime, "Content-Length": str(len(data))}
        yield kind, own, source, uri, mime, len(data), digest(data), headers, data.decode()


def build_derivatives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", source_headers=SOURCE_HEADERS, headers_col: str | None = None, record_col: str | None = None) -> DataFrame:
    """Two rows per page, a metadata and a conversion record: see SCHEMA.

    headers_col (a map) and record_col name columns with each response's own headers and
    record id, as read_responses() gives them; where they are null or not named, the headers
    are source_headers and the id follows from URI and payload.  Null URLs and bodies
    count as empty ones; equal responses have equal ids; null and repeated page_ids keep
    their records; other columns are ignored; an empty table gives no rows.
    """
    settled(pages.sparkSession)

    def build(batches):
        for batch in batches:
            rows = [(i, *r) for i, u, h, s, k in zip(*(c.to_pylist() for c in batch.columns), strict=True) for r in derivatives(u, h, source_headers if s is None else tuple(s), k)]
            columns = list(zip(*rows, strict=True)) or [()] * 10
            kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]
            columns[8] = [list(h.items()) for h in columns[8]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [f.strip().split(" ")[0] for f in re.split(r", (?=\w+ )", SCHEMA)])

    own = lambda c, kind: F.col(c).cast(kind) if c else F.lit(None).cast(kind)
    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"), own(headers_col, "map<string,string>").alias("_headers"), own(record_col, "string").alias("_record"))
    return rows.mapInArrow(build, SCHEMA)


def write_record(headers: dict[str, str], block: bytes, date: str) -> bytes:
    """One gzip member with a WARC/1.1 record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"WARC-Date: {date}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", mtime=0)


_MAGIC = b"\x1f\x8b\x08"


def _unpacked(source: BinaryIO, skipped: Counter, step: int = 1 << 20) -> Iterator[bytes | None]:
    """The bytes of a plain or gzip file, member by member, in parts of bounded size.  A member that is damaged ends with None, and what is no member is passed over up to the next one."""
    data = source.read(step)
    if data[:2] != _MAGIC[:2]:
        while data:
            yield data
            data = source.read(step)
        return
    while data:
        member = zlib.decompressobj(31)
        while data and not member.eof:
            try:
                part = member.decompress(data, step)
            except zlib.error:
                skipped["damaged member"] += 1
                yield None
                data = data[1:]
                break
            if part:
                yield part
            data = member.unused_data if member.eof else member.unconsumed_tail or source.read(step)
        else:
            if not member.eof:
                skipped["damaged member"] += 1
                yield None
        data = data.lstrip(b"\0") or source.read(step).lstrip(b"\0")
        if data and not data.startswith(_MAGIC):
            skipped["bytes between members"] += 1
            while data and (at := data.find(_MAGIC)) < 0:
                more = source.read(step)
                data = data[-2:] + more if more else b""
            data = data[at:] if data else data


_LENGTH = re.compile(r"\d{1,18}", re.A)


def read_records(source: bytes | BinaryIO, skipped: Counter | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a WARC file, gzip members or plain, one record in memory at a time.

    Header names keep their spelling but for Content-Length, which is found in any; blanks
    around a value are optional, a line that begins with one goes on with the value before,
    lines without a colon are skipped.  A record that the file or a member breaks off in is left out, and
    so is what does not begin as a record or has no length in digits: reading goes on at
    the next line that begins a record.  skipped counts what was left out, by reason.
    """
    skipped = Counter() if skipped is None else skipped
    parts, held = _unpacked(io.BytesIO(source) if isinstance(source, bytes) else source, skipped), bytearray()
    broken = False  # a member broke off and what it gave is in held

    def filled(until) -> bool:
        nonlocal broken
        while not until():
            more = next(parts, b"")
            broken = more is None
            if not more:
                return False
            held.extend(more)
        return True

    def found(mark: bytes):
        seen = 0

        def look() -> bool:
            nonlocal seen
            at = held.find(mark, max(0, seen - len(mark) + 1))
            seen = len(held) if at < 0 else at
            return at >= 0

        return (lambda: seen) if filled(look) else None

    def passed_over(reason: str) -> bool:
        """Drops bytes up to the next line that begins a record; False at the end of the file."""
        skipped[reason] += 1
        while not held.startswith(b"WARC/"):
            if (at := found(b"\nWARC/")) is None:
                if not broken:
                    return False
                held.clear()
                return True
            del held[: at() + 1]
        return True

    while True:
        while held[:1] in (b"\r", b"\n"):  # blank lines between records
            del held[:1]
        if not held and not filled(lambda: bool(held)):
            if broken:
                continue
            return
        if held[:1] in (b"\r", b"\n"):
            continue
        if not filled(lambda: len(held) >= 5) and broken:
            skipped["cut off"] += 1
            held.clear()
            continue
        if not held.startswith(b"WARC/"):
            if not passed_over("no record"):
                return
            continue
        if (at := found(b"\r\n\r\n")) is None:
            skipped["cut off"] += 1
            if not broken:
                return
            held.clear()
            continue
        headers: dict[str, str] = {}
        name = None
        for line in held[: at()].decode("utf-8", "replace").split("\r\n")[1:]:
            if line[:1] in (" ", "\t") and name:
                headers[name] += " " + line.strip()
            elif ":" in line:
                name, value = (x.strip() for x in line.split(":", 1))
                headers[name] = value
        del held[: at() + 4]
        size = next((v for k, v in headers.items() if k.lower() == "content-length"), "0")
        if not _LENGTH.fullmatch(size):
            if not passed_over("no length"):
                return
            continue
        if not filled(lambda: len(held) >= int(size)):
            skipped["cut off"] += 1
            if not broken:
                return
            held.clear()
            continue
        block = bytes(held[: int(size)])
        del held[: int(size)]
        yield headers, block


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of an HTTP response; a block without a status line is all body."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return {}, block
    lines = (x.split(":", 1) for x in head.decode("latin-1").split("\r\n")[1:] if ":" in x)
    return {k.strip(): v.strip() for k, v in lines}, body


def responses_of(files: DataFrame, content_col: str = "content") -> DataFrame:
    """(record_id, url, headers, html) of the response records in rows of WARC bytes; a row is read by one task."""

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                for headers, block in read_records(pa.BufferReader(content.as_buffer())) if content.is_valid else ():
                    low = {k.lower(): v for k, v in headers.items()}
                    if low.get("warc-type") == "response":
                        own, body = http_parts(block)
                        values = ([low.get("warc-record-id")], [low.get("warc-target-uri")], [list(own.items())], [body.decode("utf-8", "replace")])
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()), strict=True)], ["record_id", "url", "headers", "html"])

    return files.select(content_col).mapInArrow(read, "record_id string, url string, headers map<string,string>, html string")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_id, url, headers, html) of the response records of WARC files; a task reads whole files, so give many of moderate size.  page_id follows from the record's id."""
    return responses_of(spark.read.format("binaryFile").load(path)).select(F.xxhash64("record_id").alias("page_id"), "record_id", "url", "headers", "html")


def skipped_in(files: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """(path, reason, n): what read_records() leaves out of each file of (path, content)."""

    def count(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                skipped: Counter = Counter()
                for _ in read_records(pa.BufferReader(content.as_buffer()), skipped) if content.is_valid else ():
                    pass
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(skipped), pa.string()), pa.array(list(skipped), pa.string()), pa.array(list(skipped.values()), pa.int64())], ["path", "reason", "n"])

    return files.select(F.col(path_col).cast("string").alias("path"), content_col).mapInArrow(count, "path string, reason string, n long")


def response_records(pages: DataFrame, record_id, url_col: str = "url", html_col: str = "html", headers=None) -> DataFrame:
    """Records (record_type, headers, block) for write_files(): an HTTP response for each page, with the given column as its id and a map of HTTP headers.  Null URLs and bodies count as empty ones."""
    url, body = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (url_col, html_col))
    http = headers if headers is not None else F.create_map(*[F.lit(x) for kv in SOURCE_HEADERS for x in kv])
    lines = F.array_join(F.transform(F.map_entries(http), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\r\n"))), "")
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), lines, F.lit("\r\n"), body)
    own = F.create_map(
        F.lit("WARC-Type"), F.lit("response"), F.lit("WARC-Record-ID"), record_id, F.lit("WARC-Target-URI"), url, F.lit("Content-Type"), F.lit("application/http; msgtype=response"), F.lit("Content-Length"), F.octet_length(block).cast("string"),
    )
    return pages.select(F.lit("response").alias("record_type"), own.alias("headers"), block.alias("block"))


def write_files(records: DataFrame, path: str, date: str, each: int = 64 << 20) -> DataFrame:
    """Writes records to the shared folder as rows (record_type, n, data) of gzip members that concatenate to WARC files, some each bytes a row; returns what was written."""

    def encode(batches):
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def row(kind: str) -> pa.RecordBatch:
            members, sizes[kind] = held.pop(kind), 0
            return pa.RecordBatch.from_pydict({"record_type": pa.array([kind], pa.string()), "n": pa.array([len(members)], pa.int64()), "data": pa.array([b"".join(members)], pa.binary())})

        for batch in batches:
            for kind, headers, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                member = write_record(dict(headers), block.encode(), date)
                held.setdefault(kind, []).append(member)
                sizes[kind] = sizes.get(kind, 0) + len(member)
                if sizes[kind] >= each:
                    yield row(kind)
        for kind in list(held):
            yield row(kind)

    records.select("record_type", "headers", "block").mapInArrow(encode, "record_type string, n long, data binary").write.partitionBy("record_type").parquet(path)
    return records.sparkSession.read.parquet(path)


#: Ids, links and lengths of the records of op8_warc_records in DuckDB SQL, over pages.
RECORDS_SQL = """
SELECT page_id, unnest(['metadata', 'conversion']) AS record_type, '<urn:x-page:' || page_id || '>' AS refers_to, coalesce(url, '') AS target_uri, strlen(coalesce(html, '')) AS source_length, true AS whole, true AS own_id FROM pages
"""
