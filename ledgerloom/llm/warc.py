"""WARC archives of web pages: deduplicated writing, and reading with segment reassembly.

Writing: of pages with equal payloads the one with the smallest id becomes a response, the
others revisit it.  A response is an HTTP message with chunked framing; longer ones are cut
into a first record and continuation records.  Archives are written by Spark's text
writer, whose line separator is the end of a WARC record, so commits and retries are Spark's.

Reading: files are split into records by their declared lengths.  Continuations are grouped
by origin identifier, ordered by segment number, checked against the total length and
freed of the chunked framing.  Revisits are then resolved against their responses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
RECORDS_PER_FILE = 1_000
END = "\r\n\r\n"
# WARC and HTTP header lines.
VERSION = "WARC/1.1"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _pieces(data: bytes, most: int) -> Iterator[bytes]:
    """``data`` in pieces of about ``most`` bytes, never cut inside a character."""
    at = 0
    while at < len(data):
        end = min(len(data), at + most)
        while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes, most: int = CHUNK_BYTES) -> bytes:
    """``payload`` in HTTP/1.1 chunked framing."""
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in _pieces(payload, most)) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload inside chunked framing; extensions and trailers are skipped, damage raises."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError(f"chunk of {size} bytes at {at} is not closed")
        out.append(body[at : at + size])
        at += size + 2


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: dict[str, object], block: bytes) -> str:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n" + block.decode()


def page_records(name: str, url: str, payload: bytes, segment_bytes: int) -> Iterator[str]:
    """The response of a page and its continuations."""
    block = HTTP_HEAD + chunked(payload)
    pieces = list(_pieces(block, segment_bytes))
    own = {"WARC-Record-ID": f"<{name}>", "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{digest_of(payload)}"}
    if len(pieces) == 1:
        yield _record({"WARC-Type": "response", **own}, block)
        return
    yield _record({"WARC-Type": "response", **own, "WARC-Segment-Number": 1}, pieces[0])
    for i, piece in enumerate(pieces[1:], 2):
        fields = {"WARC-Type": "continuation", "WARC-Record-ID": f"<{name}:{i}>", "WARC-Segment-Origin-ID": f"<{name}>", "WARC-Segment-Number": i}
        if i == len(pieces):
            fields["WARC-Segment-Total-Length"] = len(block)
        yield _record(fields, piece)


def revisit_record(name: str, url: str, of: str, payload: bytes) -> str:
    fields = {"WARC-Type": "revisit", "WARC-Record-ID": f"<{name}>", "WARC-Target-URI": url, "WARC-Refers-To": f"<{of}>", "WARC-Profile": PROFILE}
    return _record({**fields, "WARC-Payload-Digest": f"sha1:{digest_of(payload)}"}, b"")


def _name(page: str, mark: str) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("null")), F.lit(":"), F.hex(F.col(mark)))


def page_table(pages: DataFrame) -> DataFrame:
    """``name, url, html, of``: record names, and for revisits the name of the response.

    The name holds page id and a hash of url and payload, so rows share a name only if
    all of them agree.
    """
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {"mark": F.xxhash64("url", "html"), "equal": F.sha2(F.encode("html", "utf-8"), 256)}
    )
    first = rows.groupBy(F.col("equal").alias("_equal")).agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "mark")).alias("first"))
    # The second key says nothing new.  It makes both sides be dealt out afresh: only such exchanges can be split where a payload
    # stands in very many pages, while the grouping's own partitioning would be reused as it is.
    same = (F.col("equal") == F.col("_equal")) & (F.length("equal") == F.length("_equal"))
    joined = rows.join(first, same).withColumns({"name": _name("page_id", "mark"), "of": _name("first.page_id", "first.mark")})
    same = F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return joined.select("name", "url", "html", F.when(~same, F.col("of")).alias("of"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``.

    Null html and urls count as empty, a null page id is a name of its own (last in
    order).  Rows that agree in all three columns become equal records, rows of one page id
    and payload are all responses.  Other columns are not read.  An empty table leaves
    an archive folder without records.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            held = 0
            for name, url, html, of in zip(*(batch.column(c) for c in ("name", "url", "html", "of")), strict=True):
                link, payload = " ".join(url.as_py().split()), html.as_py().encode()
                made = page_records(name.as_py(), link, payload, segment_bytes) if not of.is_valid else [revisit_record(name.as_py(), link, of.as_py(), payload)]
                for record in made:
                    out.append(record)
                    held += len(record)
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    table = page_table(pages).mapInArrow(records, "value string")
    writer = table.write.mode("overwrite").option("lineSep", END).option("maxRecordsPerFile", records_per_file)
    writer.text(path, compression="gzip")


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of a file."""
    at, end = 0, END.encode()
    while at < len(data):
        split = data.index(end, at)
        version, *lines = data[at:split].decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start = split + len(end)
        stop = start + int(fields["Content-Length"])
        if data[stop : stop + len(end)] != end:
            raise ValueError(f"record at byte {at} is not closed")
        yield fields, data[start:stop]
        at = stop + len(end)


def checked_payload(name: str, digest: str, block: bytes) -> bytes:
    """The payload of a whole HTTP message."""
    payload = dechunked(block[block.index(END.encode()) + 4 :])
    if digest != f"sha1:{digest_of(payload)}":
        raise ValueError(f"{name}: the payload does not match its digest")
    return payload


RECORD = "name string, kind string, of string, digest string, origin string, segment int, total bigint, block binary, payload binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record of the archives below ``path``; whole responses come with their payload, segments with their block."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = lambda x: x and x.strip("<>")
        number = lambda x: x and int(x)
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for f, block in parse_archive(gzip.decompress(content.as_py())):
                    name, digest = plain(f["WARC-Record-ID"]), f.get("WARC-Payload-Digest")
                    whole = f["WARC-Type"] == "response" and "WARC-Segment-Number" not in f
                    fields = (f["WARC-Type"], plain(f.get("WARC-Refers-To")), digest, plain(f.get("WARC-Segment-Origin-ID")))
                    numbers = (number(f.get("WARC-Segment-Number")), number(f.get("WARC-Segment-Total-Length")))
                    rows.append((name, *fields, *numbers, None if whole else block, checked_payload(name, digest, block) if whole else None))
                types = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                columns = zip(*rows, strict=True) if rows else [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in RECORD.split(", ")])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("content").mapInArrow(parsed, RECORD)


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads of segments put together, checked against total length and digest."""
    for batch in batches:
        kept: list[bytes] = []
        for name, digest, total, parts in zip(*(batch.column(c) for c in ("name", "digest", "total", "parts")), strict=True):
            block = b"".join(parts.as_py())
            if total.as_py() != len(block):
                raise ValueError(f"{name}: {len(block)} bytes in segments, {total} declared")
            kept.append(checked_payload(name.as_py(), digest.as_py(), block))
        yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("copies"), batch.column("digest"), pa.array(kept, pa.binary())], ["name", "copies", "digest", "payload"])


def reassembled(records: DataFrame) -> DataFrame:
    """``name, copies, digest, payload`` of every response, continuations joined to it.

    Whole responses pass straight on.  Segments meet by origin: equal ones (of rows archived
    twice) count once, their number becomes ``copies``; a missing or doubled segment number,
    a wrong total or a wrong digest fails the job.  A group is one payload, never more.
    """
    whole = records.where("kind = 'response' and segment is null").select("name", F.lit(1).cast("bigint").alias("copies"), "digest", "payload")
    part = F.struct("segment", "block", "digest", "total")
    cut = (
        records.where("kind in ('response', 'continuation') and segment is not null")
        .select(F.coalesce("origin", "name").alias("name"), part.alias("part"))
        .groupBy("name", "part")
        .agg(F.count("*").alias("copies"))
        .groupBy("name")
        .agg(F.array_sort(F.collect_list("part")).alias("parts"), F.min("copies").alias("copies"), F.max("part.total").alias("total"))
    )
    in_order = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    cut = cut.select(
        "name",
        "copies",
        F.element_at("parts", 1)["digest"].alias("digest"),
        F.when(in_order & F.col("total").isNotNull(), F.col("total")).otherwise(F.raise_error(F.concat(F.lit("segments are missing: "), "name"))).cast("bigint").alias("total"),
        F.transform("parts", lambda p: p["block"]).alias("parts"),
    )
    return whole.unionByName(cut.mapInArrow(_payloads, "name string, copies bigint, digest string, payload binary"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every archived page.

    A revisit takes its payload's size from the response it refers to; one whose response
    is absent fails the job.
    """
    records = read_records(spark, path)
    page = lambda c: F.nullif(F.split(c, ":")[2], F.lit("null")).cast("bigint")
    bare = lambda c: F.expr(f"substring({c}, 6)")
    answers = reassembled(records).select("name", "copies", "digest", F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    responses = answers.select(page(F.col("name")).alias("page_id"), "payload_bytes", bare("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to"), F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("copy")).drop("copy")
    known = answers.groupBy("name", "digest").agg(F.first("payload_bytes").alias("payload_bytes")).withColumnsRenamed({"name": "of", "digest": "of_digest"})
    # As in ``page_table``: two keys, so that the many revisits of one response can be split.
    known = known.withColumnRenamed("of", "_of")
    same = (F.col("of") == F.col("_of")) & (F.length("of") == F.length("_of"))
    revisits = records.where("kind = 'revisit'").select("name", "of", "digest").join(known, same, "left")
    found = F.when(F.col("digest") == F.col("of_digest"), F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("no response for revisit "), "name")).cast("bigint"))
    revisits = revisits.select(page(F.col("name")).alias("page_id"), found.alias("payload_bytes"), bare("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), page(F.col("of")).alias("refers_to"))
    return responses.unionByName(revisits)
