"""WARC archives: written by Spark, read back by a reader that salvages what it can."""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import materialized, small_batches

# Names and values of the format. Fixed values.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
_MEMBER = b"\x1f\x8b\x08"
_END = "\r\n\r\n"
_SHA1 = re.compile(r"[0-9a-f]{40}")
_LEAST_PIECE, _MOST_PIECE = 1 << 12, 1 << 20

_RECORD_ID = "urn:page:"
_BYTES = "X-Payload-Bytes"  # revisits carry no payload; an extension header keeps its length
_MOST_SENT = 100_000  # rows of 60 bytes or so
RECORDS = (
    "file string, start bigint, end bigint, reason string, type string, record_id string, uri string, "
    "refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def _line(name: str, value: Column) -> Column:
    """A header line, none for null."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def _id(value: Column) -> Column:
    return F.concat(F.lit(f"<{_RECORD_ID}"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))


def write_warc(pages: DataFrame, path: str, *, least: int = 1000, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 1000) -> None:
    """A record of each row of ``page_id``, ``url``, ``html`` in uncompressed WARC files under ``path``.

    The payload is the HTML in UTF-8, null as empty. Of equal payloads of ``least`` bytes or more the
    row with the largest ``page_id`` is a response and the others revisit it; if rows share that id
    all of them are responses, and a null id is less than any other. Smaller payloads are all
    responses. White space and control characters in a URL are percent-encoded; a null URL has no
    line. Other columns are ignored; an empty table gives an archive without records.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("bytes"))
    tops = rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    tops = materialized(tops.where("n > 1").select("digest", "top"), "tops")
    if tops.count() <= _MOST_SENT:  # else the pages are dealt out by digest
        tops = F.broadcast(tops)
    rows = rows.join(tops, "digest", "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_END))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    none = F.lit(None).cast("string")
    url = F.concat_ws("", F.transform(F.split("url", ""), lambda c: F.when(c.rlike(r"^[\x00-\x20\x7F]$"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.when(F.col("url").isNotNull(), url)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Refers-To", F.when(revisit, _id(F.col("top")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE)).otherwise(none)),
        _line(_BYTES, F.col("bytes").cast("string")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    writer = rows.select(F.concat(head, block).alias("value")).write
    writer.option("lineSep", _END).option("maxRecordsPerFile", records_per_file).text(path)


def parse_record(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record at ``at`` and where it ends, or what is wrong with it."""
    version = _VERSION_LINE.match(data, at)
    if not version:
        return "no version line"
    stop = data.find(b"\r\n\r\n", version.end() - 2)
    if stop < 0:
        return "header without end"
    headers, last = {}, None
    for line in data[version.end() : stop].split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and last is not None:  # a folded line goes on with the value above
            headers[last] = f"{headers[last]} {line.strip().decode('utf-8', 'replace')}".strip()
            continue
        name, colon, value = line.partition(b":")
        if line and not colon:
            return "header line without colon"
        last = name.strip().lower().decode("latin-1")
        headers[last] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no content length"
    begin = stop + 4
    end = begin + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        return "block does not end where it should"
    block = data[begin:end]
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    algorithm, _, digest = headers.get("warc-payload-digest", "").partition(":")
    digest = _as_hex(digest) if algorithm.lower() == "sha1" else digest
    revisit = headers.get("warc-type") == "revisit"
    # A digest that is no SHA-1 in either form cannot be checked, and is no reason to lose the record.
    if algorithm.lower() == "sha1" and _SHA1.fullmatch(digest) and not revisit and hashlib.sha1(payload).hexdigest() != digest:
        return "payload digest differs"
    size = headers.get(_BYTES.lower(), "")
    return {
        "type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"), "uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"), "payload_digest": digest or None,
        "payload_bytes": (int(size) if size.isdigit() else None) if revisit else len(payload), "payload": payload,
    }, end + 4


def _as_hex(digest: str) -> str:
    """A SHA-1 as lower-case hex; public crawls write it in base 32."""
    if len(digest) == 32:
        try:
            return base64.b32decode(digest.upper()).hex()
        except binascii.Error:
            return digest
    return digest.lower()


def _member(data: memoryview, at: int) -> tuple[bytes, int, bool]:
    """What the gzip member at ``at`` holds, up to where, and whether it is whole.

    It is inflated piece by piece, each file byte once. Where it is broken or cut off, what came before is kept: the
    piece with the damage is taken up again from a copy of the state, in halves.
    """
    unzip, parts, size = zlib.decompressobj(wbits=31), [], _LEAST_PIECE
    while at < len(data) and not unzip.eof:
        before, piece = unzip.copy(), data[at : at + size]
        try:
            parts.append(unzip.decompress(piece))
        except zlib.error:
            if len(piece) == 1:
                return b"".join(parts), at, False
            unzip, size = before, len(piece) // 2
            continue
        at += len(piece) - len(unzip.unused_data)
        size = min(2 * size, _MOST_PIECE) if size >= _LEAST_PIECE else size
    return b"".join(parts), at, unzip.eof


def _trusted(records: list[dict]) -> Iterator[dict]:
    """Records of a damaged stream up to the first failed check, or the first that lost what all before it had: past the
    damage, references back into the stream spell earlier bytes again, and garbled headers have no digest to fail."""
    ids = set()
    for record in records:
        checked = bool(_SHA1.fullmatch(record.get("payload_digest") or ""))
        if record["type"] is None or record["record_id"] in ids or checked != bool(_SHA1.fullmatch(records[0].get("payload_digest") or "")):
            return
        ids.add(record["record_id"])
        yield record


class _Ahead:
    """The next place of a pattern at or after a position; positions only grow, so all searches together pass the data once."""

    def __init__(self, search: Callable[[int], int]):
        self.search, self.place = search, -1

    def at(self, start: int) -> int | None:
        if self.place is not None and self.place < start:
            found = self.search(start)
            self.place = found if found >= 0 else None
        return self.place


def salvage(data: bytes) -> Iterator[dict]:
    """Every sound record of an archive, plain or in gzip members, and every gap of bytes that is left out.

    After a failed check the search goes on from the next byte for a version line or a gzip member
    that holds a sound record. What lies between is a gap, with the reason. Of a member that is damaged or cut off, the
    records before the damage are kept, with the reason; what follows the damage is a gap. Positions are those
    in the file; records of one member share its position. An empty file gives nothing.
    """
    at = gap = 0
    reason = ""
    lines = _Ahead(lambda start: found.start() if (found := _VERSION_LINE.search(data, start)) else -1)
    members = _Ahead(lambda start: data.find(_MEMBER, start))
    view = memoryview(data)
    while at < len(data):
        found, end, wrong, sound = [], at, "", True
        if data.startswith(_MEMBER, at):
            held, end, sound = _member(view, at)
            inner = list(salvage(held)) if not held.startswith(_MEMBER) else []
            found = [r for r in inner if r["type"] is not None]
            if not sound:
                found = list(_trusted(inner))
            wrong = "" if found and len(found) == len(inner) and sound else "member without a whole record" if sound else "broken gzip member"
        else:
            parsed = parse_record(data, at)
            if isinstance(parsed, str):
                wrong = parsed
            else:
                found, end = [parsed[0]], parsed[1]
        if found:
            if gap < at:
                yield {"start": gap, "end": at, "reason": reason, "type": None}
            for record in found:
                yield record | {"start": at, "end": end, "reason": wrong or None}
            gap, reason = end, ""
            if sound:
                at = end
                continue
        reason = reason or wrong
        # The next member may begin before the damage shows, so its bytes are searched too; but not for records that
        # stand in them as they are: those came out of it already.
        nexts = [p for p in (lines.at(max(at + 1, end)), members.at(at + 1)) if p is not None]
        at = min(nexts, default=len(data))
        if found and gap > at:
            gap = at
    if gap < len(data):
        yield {"start": gap, "end": len(data), "reason": reason, "type": None}


def gaps(records: DataFrame) -> DataFrame:
    """``file, start, end, reason`` of the bytes that ``read_warc`` left out, to be kept as a quarantine log."""
    return records.where("type is null").select("file", "start", "end", "reason")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records under ``path``, and the gaps: rows without a ``type``, from byte ``start`` to ``end``, and why."""
    small_batches(spark, 8)  # a row holds a file
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                found = pd.DataFrame(list(salvage(bytes(content))))
                if len(found):
                    found["file"] = file
                    found = found.reindex(columns=names)
                    yield found.astype(object).where(found.notna(), None)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(parse, RECORDS)


def page_number(record_id: str | Column, kind: str) -> Column:
    return F.regexp_extract(record_id, rf"^<{_RECORD_ID}(.*)>$", 1).cast(kind)
