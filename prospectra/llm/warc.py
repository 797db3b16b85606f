"""WARC archives: writing pages with revisits, and a reader that salvages damaged files.

Writing is Spark's text writer: a record is one string, and the blank line that ends it is
the writer's line separator, so archives land in any store that Spark writes to. Of equal
payloads from a given size on, the page with the largest id is written whole and the others
as revisits of it.

The reader takes files of plain records or gzip members. Each record's length, end and sha1
digests (hex or base32, in either case) are checked; only blocks of application/http are
split at HTTP headers. After a failed check it looks for the next version line or member that
reads well, carries on there, and logs the bytes in between as a quarantined gap. What a
damaged member gave before its damage is read too: its records carry the offset of the
member and the bytes read of it, and the member still counts as a gap. A damaged member of
one record gives nothing but the gap.

A null html is an empty payload, a null page_id a record without id; repeated rows are
written one by one, and rows that share the largest id are all written whole. Pages of any
length pass. Columns beyond id, url and html are left out; an empty table gives no records.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from prospectra.llm.common import cut

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 4096
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def planned(pages: DataFrame, least: int = REVISIT_BYTES, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, payload, bytes, digest, refers_to`` of every row; ``refers_to`` is null for whole records."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("digest"),
    )
    # Written first: its real size then decides how it is joined, and pages move only if it is large.
    shared = cut(
        rows.filter(F.col("bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("_whole"), F.count("page_id").alias("_n"))
        .filter("_n > 1").drop("_n"), "warc-shared",
    )
    refers = F.when((F.col("bytes") >= least) & (F.col("page_id") != F.col("_whole")), F.col("_whole"))
    return rows.join(shared, "digest", "left").withColumn("refers_to", refers).drop("_whole")


def record(row_date: str = "2026-01-01T00:00:00Z") -> Column:
    """The text of a planned row's record, without the blank line that ends it."""
    line = lambda name, *value: F.concat(F.lit(f"{name}: "), *value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type", F.lit("text/html; charset=utf-8")),
                    line("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))
    again = F.col("refers_to").isNotNull()
    block = F.when(again, head).otherwise(F.concat(head, "payload"))
    address = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn("page_id")), line("WARC-Date", F.lit(row_date)),
        F.coalesce(line("WARC-Target-URI", address), F.lit("")),
        F.when(again, F.concat(line("WARC-Refers-To", urn("refers_to")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.lit("sha1:"), F.col("digest")),
        line("WARC-Block-Digest", F.lit("sha1:"), F.sha1(block)),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    )


def write_warc(pages: DataFrame, path: str, least: int = REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE, **columns) -> None:
    """Writes the archives of a table of pages into a new folder."""
    planned(pages, least, **columns).select(record().alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


HEADER = re.compile(rb"WARC/1\.[01]\r\n((?:[^\r\n]+\r\n)+)\r\n")
NEXT = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


#: Compressed bytes that are unpacked at once.
CHUNK = 1 << 16


def sha1_told(value: str) -> str | None:
    """The sha1 that a header tells as lower-case hex, None if it tells none."""
    name, _, told = value.partition(":")
    if name.strip().lower() != "sha1":
        return None
    told = told.strip()
    if len(told) == 32:
        try:
            return base64.b32decode(told, casefold=True).hex()
        except binascii.Error:
            pass
    return told.lower()


def read_record(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record at a place and where it ends, or why it can't be trusted."""
    head = HEADER.match(data, at)
    if not head:
        return "no header"
    named = {}
    for line in head[1].decode("utf-8", "replace").split("\r\n")[:-1]:
        name, colon, value = line.partition(":")
        if not colon:
            return "bad header line"
        name = name.strip().lower()
        if name in named and name != "warc-concurrent-to":
            return "header line repeated"
        named[name] = value.strip()
    if not named.get("content-length", "").isdecimal():
        return "no length"
    end = head.end() + int(named["content-length"])
    block = data[head.end():end]
    if data[end:end + 4] != END.encode():
        return "wrong length"
    told = sha1_told(named.get("warc-block-digest", ""))
    if told is not None and told != hashlib.sha1(block).hexdigest():
        return "block digest differs"
    http, payload = b"", block
    if named.get("content-type", "").partition(";")[0].strip().lower() == "application/http":
        before, split, after = block.partition(END.encode())
        if split:
            http, payload = before, after
    kind = named.get("warc-type")
    told = sha1_told(named.get("warc-payload-digest", ""))
    digest = hashlib.sha1(payload).hexdigest()
    size = len(payload)
    if kind == "revisit":
        digest = named.get("warc-payload-digest", "") if told is None else told
        length = re.search(rb"(?im)^content-length:\s*([0-9]+)", http)
        size = int(length[1]) if length else None
    elif told is not None and told != digest:
        return "payload digest differs"
    return {
        "record_type": kind, "record_id": named.get("warc-record-id"), "target_uri": named.get("warc-target-uri"),
        "refers_to": named.get("warc-refers-to"), "payload_digest": digest, "payload_bytes": size, "payload": payload,
    }, end + 4


def unpacked(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at a place gives, where reading it ended, and what is wrong with it."""
    unpack, out, view = zlib.decompressobj(31), [], memoryview(data)
    while at < len(data) and not unpack.eof:
        saved, part = unpack.copy(), view[at:at + CHUNK]
        try:
            out.append(unpack.decompress(part))
        except zlib.error:
            # The part again byte by byte, to have all that it gives before the damage.
            for i in range(len(part)):
                try:
                    out.append(saved.decompress(part[i:i + 1]))
                except zlib.error:
                    return b"".join(out), at + i, "member damaged"
        at += len(part)
    return b"".join(out), at - len(unpack.unused_data), "" if unpack.eof else "member cut short"


def salvage(data: bytes) -> Iterator[dict]:
    """Records of an archive as they can be trusted, and rows with ``reason`` for the byte gaps between them."""
    at, gap, why = 0, None, ""
    # Records given from a damaged member, up to where it was read: stored blocks show them again as plain ones.
    given, reached = set(), 0
    known = lambda r: (r["record_type"], r["record_id"], r["payload_digest"])
    while at < len(data):
        found: list[dict] = []
        partial: list[dict] = []
        if data.startswith(b"\x1f\x8b", at):
            inside, end, problem = unpacked(data, at)
            rows = list(salvage(inside))
            found = [r | {"offset": at, "length": end - at} for r in rows]
            if problem:
                # A member that is a single record is lost with it, even if only its own end is damaged.
                single = len(rows) == 1 and rows[0]["length"] == len(inside)
                partial, found = [r for r in found if "reason" not in r and not single], []
        else:
            read = read_record(data, at)
            problem = read if isinstance(read, str) else ""
            if not problem:
                end = read[1]
                found = [read[0] | {"offset": at, "length": end - at}]
                if at < reached and known(read[0]) in given:
                    found = []
        if problem:
            if partial:
                if gap is not None:
                    yield {"offset": gap, "length": at - gap, "reason": why}
                yield from partial
                gap, given, reached = None, set(map(known, partial)), end
            if gap is None:
                gap, why = at, problem
            following = NEXT.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield {"offset": gap, "length": at - gap, "reason": why}
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield {"offset": gap, "length": len(data) - gap, "reason": why}


FOUND = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()),
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])
FOUND_SQL = (
    "archive string, offset long, length long, reason string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives under a path; gaps have a ``reason`` and no record columns."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for row in salvage(content.as_py()):
                    row |= {"archive": name.as_py()}
                    if not payloads:
                        row.pop("payload", None)
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if held > 4 << 20 or len(rows) >= 2048:
                        yield pa.RecordBatch.from_pylist(rows, FOUND)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, FOUND)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(read, FOUND_SQL)


def id_of(urn: Column) -> Column:
    """The page id in a record's id."""
    return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1)


#: The digest of the ``pages`` round trip in SQL.
ORACLE_SQL = f"""
WITH rows AS (SELECT page_id, COALESCE(html, '') AS payload FROM pages),
sized AS (SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM rows),
whole AS (SELECT *, CASE WHEN payload_bytes >= {REVISIT_BYTES} THEN MAX(page_id) OVER (PARTITION BY payload_digest) END AS top FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM whole
"""
