"""Derivative records of a web archive: metadata and plain text beside each response.

A response record holds an HTTP message. For each one, ``derivatives`` makes a
``metadata`` record (JSON: status, source headers as they were, title, links,
digests) and a ``conversion`` record (the page's text). Both name the response
in WARC-Refers-To, keep its target and date, and carry digests of the source's
block and payload and of their own block. ``write_records`` stores records as
gzip members, one file per partition; ``read_records`` reads such files.
"""

from __future__ import annotations

import gzip
import html
import json
import re
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from uuid import NAMESPACE_URL, uuid4, uuid5

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm.common import slices, store_of

_OPENER = re.compile(r"(?i)<!--|<(script|style|noscript|template|title)\b")
_CLOSERS = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "noscript", "template", "title")}
_BREAKS = re.compile(r"(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|main|aside|body|head|"
                     r"html|blockquote|pre|form|hr|dd|dt|dl|figure|option|td|th)\b[^>]*>")
_TAGS = re.compile(r"<[!/?a-zA-Z][^>]*>")
_TITLE = re.compile(r"(?i)<title\b")
_ANCHOR = re.compile(r"(?i)<a\b")
_HREF = re.compile(r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_LONG_NUMBER = re.compile(r"&#0*+([0-9]*);?")


def digest(block: bytes) -> str:
    """A labelled SHA-1 in base 32, as archives write it."""
    return f"sha1:{b32encode(sha1(block).digest()).decode()}"


def squeezed(text: str) -> str:
    """Lines without runs of white space, empty lines dropped."""
    return "\n".join(line for line in (" ".join(part.split()) for part in text.split("\n")) if line)


def without_hidden(page: str) -> str:
    """The page with a space for each comment and each hidden element; what is never closed stays.

    One pass: the end of a kind is looked for in vain at most once, so the time grows with the length.
    """
    parts, at, look, open_kinds = [], 0, 0, {"", *_CLOSERS}
    while open_kinds and (opener := _OPENER.search(page, look)):
        look, kind = opener.end(), (opener[1] or "").lower()
        if kind not in open_kinds:
            continue
        if kind:
            tag_end = page.find(">", look)
            if tag_end < 0:
                open_kinds &= {""}
                continue
            closer = _CLOSERS[kind].search(page, tag_end + 1)
            end = closer.end() if closer else -1
        else:
            end = page.find("-->", look) + 3 if page.find("-->", look) >= 0 else -1
        if end < 0:
            open_kinds.discard(kind)
            continue
        parts += page[at:opener.start()], " "
        at = look = end
    return "".join(parts) + page[at:]


def title_of(page: str) -> str | None:
    """What the first title holds; None without a closed one."""
    opener = _TITLE.search(page)
    tag_end = page.find(">", opener.end()) if opener else -1
    closer = _CLOSERS["title"].search(page, tag_end + 1) if tag_end >= 0 else None
    return page[tag_end + 1:closer.start()] if closer else None


def links_of(visible: str) -> list[str]:
    """The first target of each anchor, in order; each stretch of the page is searched once."""
    found, look, tag_end = [], 0, 0
    href = _HREF.search(visible)
    while href and (anchor := _ANCHOR.search(visible, look)):
        look = anchor.end()
        if href.start() < look:
            href = _HREF.search(visible, look)
        if 0 <= tag_end < look:
            tag_end = visible.find(">", look)
        if href and (tag_end < 0 or href.start() < tag_end):
            found.append(next(part for part in href.groups() if part is not None))
            look = href.end()
    return found


def unescaped(text: str) -> str:
    """Character references resolved; a number of any length is allowed."""
    def shortened(number: re.Match) -> str:
        return number[0] if len(number[0]) < 20 else "\ufffd" if len(number[1]) > 7 else f"&#{number[1] or 0};"

    return html.unescape(_LONG_NUMBER.sub(shortened, text))


def text_of(visible: str) -> str:
    """The text of a page without its hidden parts, a line per block; character references resolved after the tags are gone."""
    visible = visible.replace("\r", " ").replace("\n", " ")
    # Behind the last ">" no tag ends, and none is looked for.
    last = visible.rfind(">") + 1
    return squeezed(unescaped(_TAGS.sub("", _BREAKS.sub("\n", visible[:last])) + visible[last:]))


def split_message(message: bytes) -> tuple[str, list[list[str]], bytes]:
    """Status line, header fields in order and as they were, and payload of an HTTP message."""
    head, gap, payload = message.partition(b"\r\n\r\n")
    if not gap:
        return "", [], message
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    return status, [[part.strip() for part in line.split(":", 1)] for line in lines if ":" in line], payload


def record_id(source: str, kind: str) -> str:
    """The same response always gets the same derivative ids."""
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'{kind} of {source}')}>"


_FIELDS = [("source_id", pa.int64()), ("kind", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
           ("target_uri", pa.string()), ("date", pa.string()), ("source_block_digest", pa.string()),
           ("source_payload_digest", pa.string()), ("block_digest", pa.string()), ("content_type", pa.string()),
           ("content_length", pa.int64()), ("block", pa.string())]
_SQL = ", ".join(f"{name} {'long' if kind == pa.int64() else 'string'}" for name, kind in _FIELDS)


def _pair(source_id, own_id: str, target: str, date: str, message: bytes) -> Iterator[tuple]:
    status, headers, payload = split_message(message)
    page = payload.decode("utf-8", "replace")
    block_digest, payload_digest = digest(message), digest(payload)
    title, visible = title_of(page), without_hidden(page)
    metadata = json.dumps({
        "refers_to": own_id, "target_uri": target, "status": status, "headers": headers,
        "payload_length": len(payload), "block_digest": block_digest, "payload_digest": payload_digest,
        "title": squeezed(unescaped(title)) if title is not None else None,
        "links": [unescaped(link) for link in links_of(visible)]}, ensure_ascii=False)
    for kind, content, block in (("metadata", "application/json", metadata), ("conversion", "text/plain", text_of(visible))):
        raw = block.encode()
        yield (source_id, kind, record_id(own_id, kind), own_id, target, date, block_digest, payload_digest,
               digest(raw), content, len(raw), block)


def responses_of(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages (page_id, url, html): source_id, record_id, target_uri, date, message.

    A null url or page is empty. The record id depends on page id and url, so
    a repeated row gives the same record again.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    target = F.coalesce(F.col("url"), F.lit(""))
    mark = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), target))
    uuid = F.concat_ws("-", *(F.substring(mark, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(
        F.col("page_id").cast("long").alias("source_id"), F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">")).alias("record_id"),
        target.alias("target_uri"), F.lit(date).alias("date"), F.concat(head.cast("binary"), body).alias("message"))


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records, ``metadata`` and ``conversion``, for every response.

    ``responses`` has source_id, record_id, target_uri, date and message
    (binary); other columns are not looked at. A null message is empty, other
    nulls stay or are written as empty; a message without a blank line is all
    payload. Repeated responses give repeated records. No row moves between
    tasks. An empty table gives no rows.
    """
    schema = pa.schema(_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [row for values in zip(*(batch.column(c).to_pylist() for c in (
                "source_id", "record_id", "target_uri", "date", "message"))) for row in _pair(*values)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    text = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    return responses.select("source_id", text("record_id"), text("target_uri"), text("date"),
                            F.coalesce("message", F.lit(b"")).alias("message")).mapInArrow(run, _SQL)


_NAMES = {"WARC-Type": "kind", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to", "WARC-Target-URI": "target_uri",
          "WARC-Date": "date", "WARC-Source-Block-Digest": "source_block_digest",
          "WARC-Source-Payload-Digest": "source_payload_digest", "WARC-Block-Digest": "block_digest",
          "Content-Type": "content_type", "Content-Length": "content_length"}


def write_records(records: DataFrame, folder: str) -> DataFrame:
    """Write the records' files under ``folder``; one row per file: file, n_records.

    Files are written under an attempt's name and renamed when complete.
    """
    store, root = store_of(folder)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        name = f"{root}/records-{TaskContext.get().partitionId():06d}.warc.gz"
        stream, n, draft = None, 0, f"{name}.{uuid4().hex}"
        for batch in slices(batches):
            stream = stream or store.open_output_stream(draft, compression=None)
            for row in batch.to_pylist():
                block = row["block"].encode()
                head = "".join(f"{field}: {' '.join(str(row[column] or '').split())}\r\n" for field, column in _NAMES.items())
                stream.write(gzip.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n", mtime=0))
                n += 1
        if stream:
            stream.close()
            store.move(draft, name)
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([n], pa.int64())})

    return records.mapInArrow(run, "file string, n_records long")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Header fields and block of every record under ``folder``; each file is read by one task, record by record."""
    columns = list(_NAMES.values())
    schema = pa.schema([*((c, pa.string()) for c in columns), ("block", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                with gzip.open(pa.BufferReader(content)) as file:
                    while file.readline():
                        found = {}
                        while (line := file.readline().rstrip(b"\r\n")):
                            field, value = line.decode().split(": ", 1) if b": " in line else (line.decode().rstrip(":"), "")
                            found[_NAMES.get(field)] = value
                        block = file.read(int(found["content_length"])).decode()
                        file.read(4)
                        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*(found[c] for c in columns), block)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("content").mapInArrow(run, ", ".join(f"{c} string" for c in [*columns, "block"]))
