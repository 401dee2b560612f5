"""WARC archives: writing pages as records in segments, and reading archives back.

Writing: a page becomes a response record (HTTP header, body in chunked transfer framing); a page whose body another
page with a smaller id has becomes a revisit of that page. Records longer than SEGMENT bytes are cut into a first
segment and continuation records. Spark's text writer makes the files (a record a row; the blank lines between records
are the line separator), so they are in any store that Spark writes. A task's rows are one archive, up to ARCHIVE bytes.

Reading: Spark's text reader unpacks an archive (of any number of gzip members) as a stream and cuts it before each
``WARC/1.``, so a task holds records, never an archive, whatever the archive's size. Where a record's block has that text
itself, its pieces are put together by Content-Length. Segments are grouped by origin id and put in order, the total
length is verified, and the chunked framing is decoded. A body is one value of a row, as in the input.

Null html is an empty body. Of pages with equal bodies the smallest id is the response, null ids last; of rows equal in
id and body one is the response. A revisit of a response with a null id refers to null. Bodies of fewer than ``min_revisit_bytes`` bytes are all responses. An empty table
gives no record. Other columns than id, url and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.llm.common import by_value, cut, measured, text_or_empty

by_value(__name__)

SEGMENT, CHUNK, ARCHIVE = 32_768, 8_192, 1 << 30
#: How a record begins. No part of it is its own beginning, so that a reader of lines can't miss it at the end of a buffer.
BEGIN = b"WARC/1."
RECORD = "page_id long, kind string, refers_to long, digest string, length long, origin string, segment int, total long, block binary"


def digest_of(body: bytes) -> str:
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def _cuts(data: bytes, size: int) -> list[bytes]:
    """Pieces of about ``size`` bytes that end between characters."""
    out, at = [], 0
    while at < len(data) or not out:
        end = min(len(data), at + size)
        while at < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in _cuts(body, size) if x) + b"0\r\n\r\n"


def dechunked(framed: bytes) -> bytes:
    """The body of a chunked message; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        n = int(framed[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        out.append(framed[end + 2 : end + 2 + n])
        if framed[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("a chunk is not closed")
        at = end + 4 + n


def records_of(page_id, url: str, body: bytes, revisit: bool, refers_to, serial: str, segment: int = SEGMENT) -> list[str]:
    """The WARC records of a page, without the blank lines that end them; a null ``refers_to`` of a revisit is an empty id."""
    name = f"<urn:x-page:{'' if page_id is None else page_id}:{serial}>"
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name), ("WARC-Target-URI", re.sub(r"[\s\x00]+", "%20", url)), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest_of(body)}")]
    if revisit:
        head += [("WARC-Refers-To", f"<urn:x-page:{'' if refers_to is None else refers_to}:>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        blocks = [f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()]
    else:
        whole = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(body)
        blocks = _cuts(whole, segment)
    out = []
    for k, block in enumerate(blocks, 1):
        own = head if k == 1 else [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}:{serial}-{k}>"), *head[2:4], ("WARC-Segment-Origin-ID", name)]
        if len(blocks) > 1:
            own = [*own, ("WARC-Segment-Number", k)] + ([("WARC-Segment-Total-Length", sum(map(len, blocks)))] if k == len(blocks) else [])
        lines = "".join(f"{a}: {b}\r\n" for a, b in [*own, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))])
        out.append(f"WARC/1.1\r\n{lines}\r\n{block.decode()}")
    return out


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    serial, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            out: list[str] = []
            for page, url, html, again, refers in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                out += records_of(page, url or "", html.encode("utf-8", "replace"), again, refers, f"{part}-{serial}")
                serial += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, id_col: str = "page_id", html_col: str = "html") -> None:
    """Write ``pages`` as gzipped WARC files under ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col("url").cast("string").alias("url"), text_or_empty(html_col).alias("body"))
    key = [F.unhex(F.sha2("body", 256)).alias("g")]
    again = F.octet_length("body") >= min_revisit_bytes
    keyed = rows.withColumn("rid", F.monotonically_increasing_id())
    order = F.struct(F.col("id").isNull().alias("none"), "id", "rid")
    groups = keyed.filter(again).select(*key, order.alias("o")).groupBy("g").agg(F.min("o").alias("o"), F.count(F.lit(1)).alias("n"))
    groups = measured(cut(groups.filter("n > 1").select("g", F.col("o.id").alias("first"), F.col("o.rid").alias("first_rid"))))
    joined = keyed.withColumn("g", F.when(again, key[0])).join(groups, "g", "left")
    revisit = F.coalesce(F.col("rid") != F.col("first_rid"), F.lit(False))
    value = joined.select("id", "url", "body", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers")).mapInArrow(_write, "value string")
    value.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", ARCHIVE // SEGMENT).text(path)


_FIELD = re.compile(rb"([^\r\n:]+): ([^\r\n]*)\r\n")
_PAGE = re.compile(r"<urn:x-page:(-?\d*):")


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive that was cut at BEGIN; pieces go together until the Content-Length is there."""
    if next(pieces, b""):
        raise ValueError("no record where one should begin")
    for piece in pieces:
        data = bytearray(BEGIN + piece)

        def more(where: str, data: bytearray = data) -> None:
            following = next(pieces, None)
            if following is None:
                raise ValueError(f"an archive ends inside a record{where}")
            data.extend(BEGIN)
            data.extend(following)

        while (end := data.find(b"\r\n\r\n")) < 0:
            more("'s head")
        fields = {a.decode(): b.decode() for a, b in _FIELD.findall(data, 0, end + 2)}
        whole = end + 4 + int(fields["Content-Length"])
        while len(data) < whole + 4:
            more("")
        if data[whole:] != b"\r\n\r\n":
            raise ValueError("a record does not end where it says")
        yield fields, bytes(data[end + 4 : whole])


def _page(name: str):
    found = _PAGE.match(name or "")[1]
    return int(found) if found else None


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.column(0)[k].as_py(), batch.column(1)[k].as_py()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary())
    names = ["page_id", "kind", "refers_to", "digest", "length", "origin", "segment", "total", "block"]
    rows: list[tuple] = []
    # a task reads its archives one after another, each from its beginning to its end
    for _, archive in itertools.groupby(_pieces(batches), key=lambda x: x[0]):
        for f, block in parse_records(x for _, x in archive):
            kind, total = f["WARC-Type"], f.get("WARC-Segment-Total-Length")
            origin = f.get("WARC-Segment-Origin-ID") or f["WARC-Record-ID"]
            refers = _page(f["WARC-Refers-To"]) if kind == "revisit" else None
            length = int(re.search(rb"Content-Length: (\d+)", block)[1]) if kind == "revisit" else None
            rows.append((_page(origin), kind, refers, f.get("WARC-Payload-Digest", "sha1:")[5:], length, origin, int(f.get("WARC-Segment-Number", 0)), int(total) if total else None, block))
            if len(rows) == 64:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record or segment of the gzipped archives under ``path``, as RECORD says. Names end in .gz, so that no archive is split."""
    lines = spark.read.option("pathGlobFilter", "*.gz").option("lineSep", BEGIN.decode()).text(path)
    return lines.select(F.col("_metadata.file_path").alias("archive"), F.col("value").cast("binary").alias("piece")).mapInArrow(_read, RECORD)


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of segments, in order, as one block."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            origin, total, parts = (one.column(k)[0].as_py() for k in (3, 4, 5))
            block = b"".join(x["block"] for x in parts)
            if [x["segment"] for x in parts] != list(range(1, len(parts) + 1)) or len(block) != total:
                raise ValueError(f"segments are missing or of a wrong length: {origin}")
            yield pa.RecordBatch.from_arrays([*one.columns[:3], pa.array([block], pa.binary())], names=["page_id", "kind", "digest", "block"])


def reassembled(records: DataFrame) -> DataFrame:
    """Records with their segments together: page_id, kind, refers_to, digest, length, block."""
    whole = records.filter("segment = 0").select("page_id", "kind", "refers_to", "digest", "length", "block")
    parts = records.filter("segment > 0").groupBy("origin").agg(
        F.min("page_id").alias("page_id"),
        F.min_by("kind", "segment").alias("kind"),
        F.min_by("digest", "segment").alias("digest"),
        F.max("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("blocks"),
    )
    parts = parts.select("page_id", "kind", "digest", "origin", "total", "blocks").mapInArrow(_join, "page_id long, kind string, digest string, block binary")
    none = F.lit(None).cast("long")
    return whole.unionByName(parts.select("page_id", "kind", none.alias("refers_to"), "digest", none.alias("length"), "block"))


def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decode the blocks of responses and hold the digests against the payloads."""
    for batch in batches:
        lengths, digests = [], []
        for kind, said, length, block in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4, 5)), strict=True):
            if kind == "response":
                body = dechunked(block[block.index(b"\r\n\r\n") + 4 :])
                length = len(body)
                if digest_of(body) != said:
                    raise ValueError("a payload does not have its digest")
            lengths.append(length)
            digests.append(said)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(digests, pa.string()), batch.column(1), batch.column(2)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the archives under ``path``."""
    found = reassembled(read_archives(spark, path)).select("page_id", "kind", "refers_to", "digest", "length", "block")
    return found.mapInArrow(payloads, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
