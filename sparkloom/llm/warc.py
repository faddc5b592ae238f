"""Web archives with segmented records: writing, reading, and putting segments together again.

Each page is an HTTP response with a chunked body. A record whose block is longer than a segment is
written as a first segment and continuation records, which name the first one's id as their origin
and may stand in the next file. Reading groups the segments by origin, orders them by number,
verifies the total length that the last one states, and undoes the chunked framing. Pages with the
payload of another page are written as revisit records without payload.

Spark's own writer and reader store the files, so archives live wherever Spark does.
"""

from __future__ import annotations

import gzip
import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import discard, fresh_path, saved, small_batches, within

#: Bytes of a record's block in one segment, of an HTTP chunk, and of an archive file (about).
SEGMENT_BYTES, CHUNK_BYTES, FILE_BYTES = 32 << 10, 8 << 10, 16 << 20
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Rows that are broadcast at most, and copies of a row that one task numbers.
BROADCAST_ROWS, COPIES = 500_000, 10_000

_RECORD = "record_id string, record_type string, page_id long, refers_to long, digest string, payload_bytes long, segment int, origin string, total long, block binary"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """body in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The body of a chunked transfer; raises ValueError if the framing is broken or incomplete."""
    out, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        n = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        out.append(framed[at : at + n])
        if len(out[-1]) != n or framed[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        at += n + 2


def payload_of(block: bytes) -> bytes:
    """The decoded payload of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def _records(batches, segment_bytes: int):
    """The records of pages, without the two line ends that close each."""
    for batch in batches:
        for html, n, name, page, kind, refers, ref_name, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            common = [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}")]
            common += [("WARC-Target-URI", f"urn:x-page:{page}")] if page is not None else []
            if kind == "revisit":
                profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                more = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Profile", profile), ("WARC-Refers-To", f"<{ref_name}>"), ("WARC-Refers-To-Target-URI", f"urn:x-page:{refers}"), ("X-Payload-Length", str(n))]
                yield _record(more + common, _HTTP)
                continue
            block = _HTTP + chunked(html.encode())
            parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
            first = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), ("Content-Type", "application/http; msgtype=response")]
            yield _record(first + common + ([("WARC-Segment-Number", "1")] if len(parts) > 1 else []), parts[0])
            for k, part in enumerate(parts[1:], 2):
                own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{k}>"), ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", str(k)), ("WARC-Date", "1970-01-01T00:00:00Z")]
                yield _record(own + ([("WARC-Segment-Total-Length", str(len(block)))] if k == len(parts) else []), part)


def _written(batches, segment_bytes: int):
    """The records of pages as archives of about FILE_BYTES, without the two line ends that close each."""
    held, size = [], 0
    for record in _records(batches, segment_bytes):
        held.append(record)
        size += len(record)
        if size >= FILE_BYTES:
            yield _archive(held)
            held, size = [], 0
    if held:
        yield _archive(held)


def _archive(records: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(records)], pa.binary())], ["value"])


def _page_of(uri: str | None) -> int | None:
    return int(uri.rsplit(":", 1)[1]) if uri else None


def parse(archive: bytes):
    """Yields (headers, block) for each record of an archive; raises ValueError if it is damaged."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        first, *lines = archive[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        n = int(headers["content-length"])
        block = archive[end + 4 : end + 4 + n]
        if len(block) != n or archive[end + 4 + n : end + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} is cut short")
        yield headers, block
        at = end + 8 + n


def _parsed(batches):
    names = [x.split()[0] for x in _RECORD.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            rows, held = [], 0
            for h, block in parse(gzip.decompress(archive)):
                kind, name = h["warc-type"], h["warc-record-id"].strip("<>")
                length = h.get("x-payload-length")
                segment, origin = h.get("warc-segment-number"), h.get("warc-segment-origin-id")
                row = [name, kind, _page_of(h.get("warc-target-uri")), _page_of(h.get("warc-refers-to-target-uri")), h.get("warc-payload-digest", "sha1:")[5:], None if length is None else int(length)]
                row += [None if segment is None else int(segment), (origin or h["warc-record-id"]).strip("<>"), None if (total := h.get("warc-segment-total-length")) is None else int(total), block]
                rows.append(row)
                held += len(block)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, id_col: str = "page_id", html_col: str = "html") -> None:
    """Write a record for each row of pages (null html: an empty payload).

    Of rows with equal payloads of REVISIT_BYTES or more, the first with the largest id is stored
    and the others revisit it; if all their ids are null, each is stored. Repeated rows get a
    record each. Other columns are ignored.
    """
    small_batches(pages.sparkSession)
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("n"))
    slim, slim_path = saved(rows.select("page", "digest", "n"), "digests")
    groups = slim.where(F.col("n") >= REVISIT_BYTES).groupBy("digest", "n").agg(F.max("page").alias("keep"), F.count("*").alias("rows")).where("rows > 1 and keep is not null").drop("rows")
    groups, groups_path = saved(groups, "groups")
    repeats, repeats_path = saved(slim.groupBy("page", "digest").agg(F.count("*").alias("copies")).where("copies > 1"), "repeats")
    named = _numbered(rows, repeats) if repeats.limit(1).count() else rows.withColumn("nth", F.lit(1).cast("long"))
    joined = named.join(F.broadcast(groups) if within(groups, BROADCAST_ROWS) else groups, ["digest", "n"], "left")
    name = lambda page, nth: F.concat(F.lit("urn:x-record:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit("."), nth.cast("string"), F.lit("."), F.left("digest", F.lit(8)))
    kept = F.col("keep").isNull() | (F.col("page").eqNullSafe(F.col("keep")) & (F.col("nth") == 1))
    out = joined.select(
        F.when(kept, F.col("html")).alias("html"), "n", name(F.col("page"), F.col("nth")).alias("name"), "page", F.when(kept, "response").otherwise("revisit").alias("kind"),
        F.when(~kept, F.col("keep")).alias("refers"), F.when(~kept, name(F.col("keep"), F.lit(1))).alias("ref_name"), "digest",
    )
    records = out.mapInArrow(partial(_written, segment_bytes=segment_bytes), "value binary")
    # an archive a row and a row a file: files are bounded without another exchange
    records = records.select(F.col("value").cast("string").alias("value"))
    records.write.options(lineSep="\r\n\r\n", compression="gzip", maxRecordsPerFile=1).text(path)
    discard(pages.sparkSession, slim_path, groups_path, repeats_path)


def _numbered(rows: DataFrame, repeats: DataFrame) -> DataFrame:
    """Adds nth, which tells rows of one page id and digest apart.

    Repeated rows are combined before they are exchanged and dealt out again in parts, so that very
    many copies of a row aren't one task's.
    """
    marks = repeats.withColumnsRenamed({"page": "p2", "digest": "d2"})
    marks = F.broadcast(marks) if within(marks, BROADCAST_ROWS) else marks
    same = F.col("page").eqNullSafe(F.col("p2")) & (F.col("digest") == F.col("d2"))
    single = rows.join(marks, same, "left_anti").withColumn("nth", F.lit(1).cast("long"))
    several = rows.join(marks, same, "left_semi").groupBy("page", "digest", "n").agg(F.first("html").alias("html"), F.count("*").alias("copies"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}")))
    dealt = several.select("page", "html", "digest", "n", "copies", part.alias("part")).repartition("page", "digest", "part")
    nth = F.explode(F.sequence(F.col("part") * COPIES + 1, F.least((F.col("part") + 1) * COPIES, F.col("copies"))))
    return single.unionByName(dealt.select("page", "html", "digest", "n", nth.alias("nth")))


_PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds, strict=True)], list(names))


def _response(name: str, page: int | None, digest: str, block: bytes) -> tuple:
    """The row of a response with this block; raises ValueError if its payload doesn't have its digest."""
    payload = payload_of(block)
    made = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
    if made != digest:
        raise ValueError(f"the payload of {name} doesn't have its digest")
    return page, len(payload), made, "response", None


_PART = f"{_PAGE}, name string, segment int, total long, block binary"


def _read(batches):
    """A row for each record: the page of a revisit or a response in one record, otherwise a segment with its block."""
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            rows, held = [], 0
            for h, block in parse(gzip.decompress(archive)):
                page, digest, kind = _page_of(h.get("warc-target-uri")), h.get("warc-payload-digest", "sha1:")[5:], h["warc-type"]
                if kind == "revisit":
                    rows.append((page, int(h["x-payload-length"]), digest, kind, _page_of(h["warc-refers-to-target-uri"]), None, None, None, None))
                elif kind == "response" and "warc-segment-number" not in h:
                    rows.append((*_response(h["warc-record-id"], page, digest, block), None, None, None, None))
                elif kind in ("response", "continuation"):
                    origin, total = h.get("warc-segment-origin-id", h["warc-record-id"]), h.get("warc-segment-total-length")
                    rows.append((page, None, digest or None, kind, None, origin.strip("<>"), int(h["warc-segment-number"]), None if total is None else int(total), block))
                    held += len(block)
                if held > 4 << 20:
                    yield _batch(rows, _PART)
                    rows, held = [], 0
            yield _batch(rows, _PART)


def _reassembled(batches):
    """Rows of the responses in segments, from their segments in order."""
    for batch in batches:
        rows = []
        for name, page, digest, total, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            block = b"".join(p["block"] for p in parts)
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or total != len(block):
                raise ValueError(f"the segments of {name} aren't whole")
            rows.append(_response(name, page, digest, block))
        yield _batch(rows, _PAGE)


def _files(spark: SparkSession, path: str) -> DataFrame:
    small_batches(spark)
    return spark.read.format("binaryFile").load(path).select("content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder, segments apart."""
    return _files(spark, path).mapInArrow(_parsed, _RECORD)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` for each page of the archives, which are read once."""
    read, _ = saved(_files(spark, path).mapInArrow(_read, _PART), "records")
    pages = [x.split()[0] for x in _PAGE.split(", ")]
    segments = read.where("name is not null").groupBy("name")
    cut = segments.agg(F.max("page_id").alias("page_id"), F.max("payload_digest").alias("digest"), F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    return read.where("name is null").select(*pages).unionByName(cut.mapInArrow(_reassembled, _PAGE))


def archive_round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the pages to archives in the shared folder and read every page back from them."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, segment_bytes)
    return read_pages(pages.sparkSession, path)
