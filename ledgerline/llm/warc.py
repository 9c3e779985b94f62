"""WARC archives: writing with revisits and segments, reading with segment reassembly.

A page becomes a ``response`` record with an HTTP block in chunked transfer framing; a
block longer than a segment is cut into a first record and ``continuation`` records that
name their origin.  Of pages with equal payloads the one with the largest id is the
response and the others are ``revisit`` records.  Records are plain column expressions and
Spark's text writer lays them end to end (the blank lines that end a record are its line
separator), so archives go through Spark's commit protocol to any store it can write.

The reader parses whole archives, decodes complete records where they are, groups the
segments of a cut record by their origin, orders them by number, verifies the total length
and decodes the chunked framing of the joined block.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.stage import ensure_checkpoint_dir

CRLF = "\r\n"
#: Fixed value: the digits of base 32, in the order of conv() and of RFC 4648.
CONV32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload):
    """Upper-case base32 SHA-1 of a string column: five hex digits are four digits of base 32."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV32, BASE32)


def chunked(payload, size: int):
    """Chunked transfer framing of a string column, ``size`` characters a chunk."""
    count = F.ceil(F.length(payload) / size).cast("int")
    piece = lambda i: F.substr(payload, i * size + 1, F.lit(size))
    framed = F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(
        F.lower(F.hex(F.octet_length(piece(i - 1)).cast("bigint"))), F.lit(CRLF), piece(i - 1), F.lit(CRLF)))
    return F.concat(F.when(count > 0, F.array_join(framed, "")).otherwise(F.lit("")), F.lit("0" + CRLF + CRLF))


def records(pages: DataFrame, id_col: str, html_col: str, url_col: str | None, chunk: int, segment: int, smallest: int) -> DataFrame:
    """One row (value) per WARC record, without the blank lines that end it."""
    url = F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "[\r\n]", "") if url_col else F.lit("")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), url.alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    groups = (rows.where(F.octet_length("payload") >= smallest).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
              .where("n > 1").select("digest", "first", F.lit(True).alias("many")))
    rows = rows.join(groups, "digest", "left").withColumn("seq", F.monotonically_increasing_id())
    revisit = F.coalesce(F.col("many") & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    head = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
    block = F.when(revisit, F.lit(head + CRLF)).otherwise(F.concat(F.lit(head + "Transfer-Encoding: chunked" + CRLF + CRLF), chunked(F.col("payload"), chunk)))
    rows = rows.select("page_id", "url", "digest", "first", "seq", revisit.alias("revisit"), block.alias("block"))
    parts = F.greatest(F.lit(1), F.ceil(F.length("block") / segment).cast("int"))
    rows = rows.withColumn("parts", parts).withColumn("total", F.octet_length("block"))
    rows = rows.withColumn("number", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    body = F.when(F.col("parts") == 1, F.col("block")).otherwise(F.substr("block", (F.col("number") - 1) * segment + 1, F.lit(segment)))
    rows = rows.select("page_id", "url", "digest", "first", "seq", "revisit", "parts", "total", "number", body.alias("body"))
    name = lambda i: F.concat(F.lit("<urn:x-page:"), F.coalesce(i.cast("string"), F.lit("none")), F.lit(":"), F.col("seq").cast("string"), F.lit(">"))
    whole, later = F.col("parts") == 1, F.col("number") > 1
    line = lambda k, v, when=F.lit(True): F.when(when, F.concat(F.lit(k + ": "), v, F.lit(CRLF))).otherwise(F.lit(""))
    part = F.concat(F.lit("<urn:x-part:"), F.col("seq").cast("string"), F.lit(":"), F.col("number").cast("string"), F.lit(">"))
    return rows.select(F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(later, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.when(later, part).otherwise(name(F.col("page_id")))),
        line("WARC-Date", F.lit("2000-01-01T00:00:00Z")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), ~later),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.col("revisit")),
        line("WARC-Refers-To", F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col("first").cast("string"), F.lit("none")), F.lit(">")), F.col("revisit")),
        line("WARC-Segment-Number", F.col("number").cast("string"), ~whole),
        line("WARC-Segment-Origin-ID", name(F.col("page_id")), later),
        line("WARC-Segment-Total-Length", F.col("total").cast("string"), ~whole & (F.col("number") == F.col("parts"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("body").cast("string")),
        F.lit(CRLF), F.col("body")).alias("value"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", html_col: str = "html", url_col: str | None = "url",
                   chunk: int = 8192, segment: int = 32768, smallest: int = 0, per_file: int = 2000) -> None:
    """Write gzip archives of at most ``per_file`` records each under ``path``.

    A null payload is empty.  Payloads of at least ``smallest`` bytes that occur more than once are
    stored under their largest id; rows that repeat that id keep the payload too.  If all ids of a
    group are null, all its records are responses.  An empty table writes no records.
    """
    (records(pages, id_col, html_col, url_col, chunk, segment, smallest).write.option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of an archive."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        end = data.find(b"\r\n\r\n", at)
        if at >= len(data) or end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP message, without chunked framing."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + size])
        at = end + 4 + size


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


FOUND = ("record_id string, record_type string, refers_to string, stated_digest string, origin string, number int, "
         "total_length bigint, payload_bytes bigint, payload_digest string, problem string, block binary")
NAMES = [x.split()[0] for x in FOUND.split(", ")]
KINDS = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]


def _rows(batches, cut: bool):
    """Records of archives: those that are segments of others, or those that are complete."""
    for batch in batches:
        for content in batch.column(0):
            data = content.as_py()
            data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
            cols: list[list] = [[] for _ in NAMES]
            for h, block in parse(data):
                if ("warc-segment-number" in h) is not cut:
                    continue
                kind, ident = h.get("warc-type"), h.get("warc-record-id")
                stated = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                row = [ident, kind, h.get("warc-refers-to"), stated]
                if cut:
                    total = h.get("warc-segment-total-length")
                    row += [h.get("warc-segment-origin-id", ident), int(h["warc-segment-number"]), int(total) if total else None, None, None, None, block]
                else:
                    row += [None, None, None, *_decoded(kind, block, stated), None]
                for col, x in zip(cols, row):
                    col.append(x)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, KINDS)], names=NAMES)


def _decoded(kind: str | None, block: bytes, stated: str | None) -> tuple[int | None, str | None, str | None]:
    """(bytes, digest, problem) of the payload of a response; nothing for other records."""
    if kind != "response":
        return None, None, None
    try:
        payload = http_payload(block)
    except (ValueError, IndexError):
        return None, None, "bad chunked framing"
    digest = digest_of(payload)
    return len(payload), digest, None if stated in (None, digest) else "payload digest differs"


def _join(batches):
    """Segments sorted by (origin, number), joined and decoded; one record is held at a time."""
    held: list[dict] = []

    def whole() -> pa.RecordBatch:
        first, numbers = held[0], [r["number"] for r in held]
        block = b"".join(r["block"] for r in held)
        total = next((r["total_length"] for r in reversed(held) if r["total_length"] is not None), None)
        size, digest, problem = _decoded(first["record_type"], block, first["stated_digest"])
        if numbers != list(range(1, len(held) + 1)) or total is None:
            size, digest, problem = None, None, "segments are missing"
        elif total != len(block):
            size, digest, problem = None, None, "total length differs"
        row = [first["record_id"], first["record_type"], first["refers_to"], first["stated_digest"], first["origin"], len(held), total, size, digest, problem, None]
        return pa.record_batch([pa.array([x], k) for x, k in zip(row, KINDS)], names=NAMES)

    for batch in batches:
        for r in batch.to_pylist():
            if held and r["origin"] != held[0]["origin"]:
                yield whole()
                held = []
            held.append(r)
    if held:
        yield whole()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``, segments joined: ids, type, payload size and digest, problem.

    A record that fails a check comes back with ``problem`` and without a digest it cannot vouch for.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    complete = files.mapInArrow(lambda b: _rows(b, False), FOUND)
    segments = files.mapInArrow(lambda b: _rows(b, True), FOUND).repartition("origin").sortWithinPartitions("origin", "number")
    return complete.union(segments.mapInArrow(_join, FOUND)).drop("block")


def round_trip(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str | None = "url", **options) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per page, from archives written and read back.

    Revisits take size and digest from the response that stores their payload.  See write_archives
    for nulls and repeated rows.
    """
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, id_col, html_col, url_col, **options)
    back = read_archives(spark, path)
    stored = (back.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("stated_digest"))
              .agg(F.max("payload_bytes").alias("b"), F.max("payload_digest").alias("d")))
    page = lambda c: F.regexp_extract(c, r"<urn:x-page:(-?\d+)", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("bigint"))
    return back.join(stored, "stated_digest", "left").select(
        number("record_id").alias("page_id"), F.coalesce("payload_bytes", "b").alias("payload_bytes"),
        F.coalesce("payload_digest", "d").alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"), "problem")
