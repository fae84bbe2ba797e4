"""WARC archives: writing captures, reading records back and putting the records of a capture together."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.parts import with_small
from tallyfold.runtime import new_stage_path, stage

# Captures in one archive file; a task reads a file as a whole, compressed, and holds one inflated record at a time.
FILE_RECORDS = 4_000
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_EOL = "\r\n"
RECORDS = (
    "record_id string, type string, concurrent_to string, refers_to string, uri string, page string, payload_digest string,"
    " payload_bytes long, stored_bytes long, body binary"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of bytes: five hex digits at a time make four letters."""
    digest = F.sha1(payload)
    letters = []
    for k in range(8):
        bits = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def roles(pages: DataFrame, id_col: str, payload: Column, least: int) -> DataFrame:
    """(page_id, digest, n_bytes, refers_to): for a repeated payload, the largest page_id among its pages; else null.

    Only ids and digests are exchanged. A payload that fills a third of the table is one row per task before the exchange.
    """
    seen = pages.select(F.col(id_col).alias("_page"), base32_sha1(payload).alias("_digest"), F.octet_length(payload).alias("_bytes"))
    groups = seen.where(F.col("_bytes") >= least).groupBy("_digest").agg(F.max("_page").alias("_first"), F.count("*").alias("_n"))
    return groups.where("_n > 1 AND _first IS NOT NULL").select("_digest", "_first")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> None:
    """Write every row as a capture: a request, a response (or revisit) and a metadata record, in gzipped WARC files.

    Payload is the text in UTF-8, null as no bytes. Among captures with equal payloads of ``least`` bytes or more, the
    one with the largest page id is the response; the others revisit it and store no payload. Rows that share that
    largest id are all responses; a null id is smaller than any. Equal rows are each written.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    repeated = stage(roles(pages, id_col, payload, least), "warc")
    rows = pages.select(
        F.col(id_col).cast("string").alias("_id"), F.col(id_col).alias("_page"), F.coalesce(url_col, F.lit("about:blank")).alias("_url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("_html"), base32_sha1(payload).alias("_digest"),
        F.octet_length(payload).cast("long").alias("_bytes"), F.expr("uuid()").alias("_uuid"),
    )
    rows = with_small(rows, repeated, ["_digest"], "left")
    # Null ids are smaller than the largest one, so they revisit it as well.
    revisit = F.col("_first").isNotNull() & ~F.col("_page").eqNullSafe(F.col("_first"))
    rows = rows.withColumn("_revisit", revisit)
    uid = lambda kind: F.concat(F.lit(f"<urn:tallyfold:{kind}:"), F.col("_uuid"), F.lit(">"))
    page = F.coalesce(F.concat(F.lit(f"{_EOL}WARC-Page-ID: "), F.col("_id")), F.lit(""))
    uri = F.regexp_replace("_url", r"[\x00-\x20\x7f]", "%20")
    date = "2024-01-01T00:00:00Z"

    def record(kind: Column | str, own: Column, headers: Column, body: Column) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        head = F.concat(
            F.lit(f"WARC/1.1{_EOL}WARC-Type: "), kind, F.lit(f"{_EOL}WARC-Record-ID: "), own, F.lit(f"{_EOL}WARC-Date: {date}{_EOL}WARC-Target-URI: "),
            uri, page, headers, F.lit(f"{_EOL}Content-Length: "), F.octet_length(body.cast("binary")).cast("string"), F.lit(_EOL * 2),
        )
        return F.concat(head, body)

    near = F.concat(F.lit(f"{_EOL}WARC-Concurrent-To: "), uid("capture"))
    digest = F.concat(F.lit(f"{_EOL}WARC-Payload-Digest: sha1:"), F.col("_digest"))
    http = F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL * 2}")
    request = record("request", uid("request"), near, F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{_EOL * 2}")))
    refers = F.when(F.col("_revisit"), F.concat(F.lit(f"{_EOL}WARC-Refers-To-Page: "), F.col("_first").cast("string"))).otherwise("")
    main = record(
        F.when(F.col("_revisit"), "revisit").otherwise("response"), uid("capture"), F.concat(digest, refers),
        F.when(F.col("_revisit"), http).otherwise(F.concat(http, F.col("_html"))),
    )
    meta = record("metadata", uid("metadata"), near, F.concat(F.lit("payload-bytes: "), F.col("_bytes").cast("string"), F.lit(_EOL)))
    text = rows.select(F.concat_ws(_EOL * 2, request, main, meta).alias("value"))
    # Each record is followed by two line ends; the writer puts those of a row's last record.
    text.write.option("lineSep", _EOL * 2).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def _inflate(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, a piece at a time."""
    while content:
        stream = zlib.decompressobj(47)
        rest = content
        while not stream.eof and rest:
            yield stream.decompress(rest, step)
            rest = stream.unconsumed_tail
        content = stream.unused_data


def _parse(pieces: Iterator[bytes]) -> Iterator[tuple[str, dict[str, str], bytes]]:
    """(type, headers, block) of each record; a block's length is what its header says, whatever it holds."""
    data, more = bytearray(), True

    def fill(size: int) -> None:
        nonlocal more
        while more and len(data) < size:
            piece = next(pieces, None)
            more = piece is not None
            data.extend(piece or b"")

    while True:
        end = -1
        while end < 0:
            while data[:2] == b"\r\n":  # line ends between records
                del data[:2]
            end = data.find(b"\r\n\r\n")
            if end < 0:
                if not more:
                    if data.strip():
                        raise ValueError("an archive ends inside a record's header")
                    return
                fill(len(data) + 1)
        lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(headers["content-length"])
        fill(end + 4 + size)
        block = bytes(data[end + 4 : end + 4 + size])
        if len(block) != size:
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off: {len(block)} of {size} bytes")
        yield headers["warc-type"], headers, block
        del data[: end + 4 + size]
        fill(4)


def read_records(spark: SparkSession, folder: str, bodies: bool = False) -> DataFrame:
    """All records of the archives in a folder. ``bodies``: with the payloads; digest and size are always those of what is stored.

    For request and metadata records payload_bytes is null, but for the metadata field payload-bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict] = []
                held = 0
                for kind, h, block in _parse(_inflate(content.as_py())):
                    row = {
                        "record_id": h["warc-record-id"], "type": kind, "concurrent_to": h.get("warc-concurrent-to"),
                        "refers_to": h.get("warc-refers-to-page"), "uri": h.get("warc-target-uri"), "page": h.get("warc-page-id"),
                        "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None, "payload_bytes": None,
                        "stored_bytes": len(block), "body": None,
                    }
                    if kind in ("response", "revisit"):
                        payload = block.partition(b"\r\n\r\n")[2]
                        if kind == "response":
                            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if row["payload_digest"] not in (None, found):
                                raise ValueError(f"payload of {row['record_id']} does not have its digest")
                            row |= {"payload_digest": found, "payload_bytes": len(payload)}
                        row["body"] = payload if bodies else None
                    elif kind == "metadata":
                        fields = dict(x.split(": ", 1) for x in block.decode("utf-8", "replace").split("\r\n") if ": " in x)
                        row["payload_bytes"] = int(fields["payload-bytes"]) if "payload-bytes" in fields else None
                    rows.append(row)
                    held += len(row["body"] or b"") + 300
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    text = ("record_id", "type", "concurrent_to", "refers_to", "uri", "page", "payload_digest")
    schema = pa.schema([*((n, pa.string()) for n in text), ("payload_bytes", pa.int64()), ("stored_bytes", pa.int64()), ("body", pa.binary())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: (capture_id, page, uri, request, response, metadata), the last three nested.

    Request and metadata records name their capture in WARC-Concurrent-To; they are joined with it by that identifier,
    all three at once in one exchange. Captures without a response or revisit record are left out; of several request or
    metadata records of one capture, the one with the largest record id is taken.
    """
    capture = F.when(F.col("type").isin("response", "revisit"), F.col("record_id")).otherwise(F.col("concurrent_to"))
    as_struct = F.struct("record_id", "type", "refers_to", "uri", "page", "payload_digest", "payload_bytes", "stored_bytes", "body")
    pick = lambda *kinds: F.max_by(F.when(F.col("type").isin(*kinds), as_struct), F.when(F.col("type").isin(*kinds), F.col("record_id")))
    joined = records.where(capture.isNotNull()).groupBy(capture.alias("capture_id")).agg(
        pick("request").alias("request"), pick("response", "revisit").alias("response"), pick("metadata").alias("metadata")
    )
    return joined.where("response IS NOT NULL").select(
        "capture_id", F.col("response.page").alias("page"), F.col("response.uri").alias("uri"), "request", "response", "metadata"
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """Write pages as archives below the shared folder, read them back and assemble the captures."""
    spark = pages.sparkSession
    folder = new_stage_path(spark, "warc-files")
    write_archives(pages, folder, id_col, url_col, html_col, least)
    return assemble(read_records(spark, folder))
