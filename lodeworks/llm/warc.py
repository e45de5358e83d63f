"""WARC archives: writing captures, reading records, assembling transactions.

A capture is three records: the request, the response (or a revisit, where an equal
payload is in the response of a smaller page) and the metadata. The latter and the
request name the response in WARC-Concurrent-To. Records are text lines that end in the
WARC record end, so Spark's text sink writes valid, compressed archives with its
committer; compressed files are read whole, from front to end, record by record, whatever
the payload holds. Reading computes length and digest of each payload in the scan; the three
records of a capture then meet by record id, without payloads unless they are asked for.

Defined cases: a NULL payload is empty; NULL page ids or urls are written as empty fields and
read as NULL, and a NULL page id is the largest; rows that repeat page id and payload are
all of the same record type, and a row is never a revisit of its own page id; an empty table
gives an empty table. Payloads under `min_bytes` bytes are never revisits.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import scratch_path, small, table

END = "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURED = "2026-01-01T00:00:00Z"
RECORD_BYTES_HINT = 1 << 21

RECORDS = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
    "header_digest string, payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
)


def base32(hexadecimal: Column) -> Column:
    """A 40-digit hexadecimal string as 32 base32 characters: five digits make four."""
    def letter(i: Column) -> Column:
        group = F.conv(F.substring(hexadecimal, (F.floor(i / 4) * 5 + 1).cast("int"), F.lit(5)), 16, 10).cast("int")
        bits = F.call_function("shiftright", group, (15 - 5 * F.pmod(i, F.lit(4))).cast("int")).bitwiseAND(F.lit(31))
        return F.substring(F.lit(ALPHABET), bits + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), "")


def _urn(kind: str, page: Column, url: Column, sha: Column) -> Column:
    whole = F.md5(F.concat_ws("|", F.lit(kind), page, url, sha))
    dashed = F.concat_ws("-", *[F.substring(whole, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1")]
    lines += [F.concat(F.lit(f"{name}: "), F.lit(v) if isinstance(v, str) else v) for name, v in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def _line(text: Column) -> Column:
    """A header value: no line ends."""
    return F.regexp_replace(text, r"[\r\n]", " ")


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Archive `page_id, url, html` under `path`, three records a row."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    plain = pages.select(
        F.col("page_id"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page"),
        _line(F.coalesce(F.col("url"), F.lit(""))).alias("url"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha"),
    )
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "page", "url")
    same = (
        plain.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha")
        .agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("sha", "first")
    )
    rows = plain.join(small(same), "sha", "left")
    rows = rows.withColumn("again", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id")))
    page, url, sha, again = F.col("page"), F.col("url"), F.col("sha"), F.col("again")
    response = _urn("response", page, url, sha)
    first = _urn("response", F.col("first.page"), F.col("first.url"), sha)
    digest = F.concat(F.lit("sha1:"), base32(sha))
    length = F.octet_length("payload").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit(END)
    )
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    about = [("WARC-Target-URI", url), ("WARC-Date", CAPTURED)]
    request = _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", page, url, sha)), ("WARC-Concurrent-To", response), *about,
         ("Content-Type", "application/http;msgtype=request")],
        F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)),
    )
    answer = [("WARC-Record-ID", response), *about, ("WARC-Payload-Digest", digest)]
    kind = [("Content-Type", "application/http;msgtype=response")]
    fresh = _record([("WARC-Type", "response"), *answer, *kind], F.concat(http, F.col("payload")))
    seen = _record(
        [("WARC-Type", "revisit"), *answer, ("WARC-Refers-To", first),
         ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), *kind],
        http,
    )
    notes = _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", page, url, sha)), ("WARC-Concurrent-To", response), *about,
         ("Content-Type", "application/warc-fields")],
        F.concat(F.lit("pageId: "), page, F.lit("\r\npayloadLength: "), length, F.lit("\r\n")),
    )
    value = F.explode(F.array(request, F.when(again, seen).otherwise(fresh), notes)).alias("value")
    rows.select(value).write.option("lineSep", END).option("compression", "gzip").text(path)


_HEADER = re.compile(rb"\r\n([^:\r\n]+): ?([^\r\n]*)")


def _blank(held: bytearray) -> int:
    """The number of line-end bytes in front."""
    return len(held) - len(held.lstrip(b"\r\n"))


def _records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of archives one after another, from pieces of their bytes."""
    end = END.encode()
    held = bytearray()

    def more() -> bool:
        piece = next(stream, None)
        if piece is None:
            return False
        held.extend(piece)
        return True

    while True:
        # A block that ends in line ends leaves some over where its file ends.
        while (at := held.find(end, _blank(held))) < 0:
            if not more():
                if held.strip():
                    raise ValueError("an archive ends within a record")
                return
        head = {k.decode(): v.decode("utf-8", "replace") for k, v in _HEADER.findall(bytes(held[:at]))}
        start = at + len(end)
        stop = start + int(head["Content-Length"])
        while len(held) < stop + len(end):
            if not more():
                raise ValueError("an archive ends within a record")
        block = bytes(held[start:stop])
        del held[: stop + len(end)]
        yield head, block


def _row(head: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, end = head["WARC-Type"], END.encode()
    fields = payload = size = digest = None
    if kind == "metadata":
        fields = dict(line.split(": ", 1) for line in block.decode("utf-8", "replace").split("\r\n") if ": " in line)
    elif kind == "response":
        payload = block[block.find(end) + len(end) :]
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    stated = head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
    return (
        kind, head["WARC-Record-ID"], head.get("WARC-Concurrent-To"), head.get("WARC-Refers-To"),
        head.get("WARC-Target-URI"), stated, size, digest, fields, payload if with_payload else None,
    )


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives under `path`."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream() -> Iterator[bytes]:
            for batch in batches:
                for piece in batch["value"]:
                    yield piece.as_buffer().to_pybytes() + END.encode()

        types = pa.schema(
            [pa.field(n, pa.string()) for n in ("type", "record_id", "concurrent_to", "refers_to", "target_uri", "header_digest")]
            + [pa.field("payload_bytes", pa.int64()), pa.field("payload_digest", pa.string())]
            + [pa.field("fields", pa.map_(pa.string(), pa.string())), pa.field("payload", pa.binary())]
        )

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            columns[8] = [None if f is None else list(f.items()) for f in columns[8]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

        rows, held = [], 0
        for head, block in _records(stream()):
            rows.append(_row(head, block, with_payload))
            held += 500 + len(block) * with_payload
            if held > RECORD_BYTES_HINT:
                yield packed(rows)
                rows, held = [], 0
        if rows:
            yield packed(rows)

    lines = spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(scan, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: `capture_id` and structs `request`, `response`, `metadata`.

    Copies of a capture have the same record ids; each copy's response gives a row.
    """
    answers = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"),
        F.struct("type", "record_id", "refers_to", "target_uri", "header_digest", "payload_bytes", "payload_digest", "payload").alias("response"),
    )

    def beside(kind: str, *columns: str) -> DataFrame:
        own = records.where(F.col("type") == kind).groupBy(F.col("concurrent_to").alias("capture_id"))
        return own.agg(F.first(F.struct(*columns)).alias(kind))

    return answers.join(beside("request", "record_id", "target_uri"), "capture_id", "left").join(
        beside("metadata", "record_id", "fields"), "capture_id", "left"
    )


def digests(captures: DataFrame) -> DataFrame:
    """What an index keeps of each capture."""
    page = F.expr("nullif(metadata.fields['pageId'], '')").cast("bigint")
    rows = captures.select(
        "capture_id",
        page.alias("page_id"),
        F.coalesce("response.payload_bytes", F.col("metadata.fields")["payloadLength"].cast("bigint")).alias("payload_bytes"),
        F.coalesce("response.payload_digest", "response.header_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        # A response refers to nothing: a name of its own that is not found keeps it from a common NULL key.
        F.coalesce("response.refers_to", F.concat(F.lit("none "), "capture_id")).alias("_to"),
    )
    known = rows.where(F.col("record_type") == "response").groupBy(F.col("capture_id").alias("_to")).agg(
        F.first("page_id").alias("refers_to")
    )
    return rows.join(known, "_to", "left").drop("_to", "capture_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return digests(assemble(read(spark, path)))


OP9_SQL = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT h, min(page_id) AS first FROM p GROUP BY h
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, (i // 4)::INT * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""
