"""Legacy ARC archives, their conversion to WARC, and WARC archives, read and written by Spark.

An ARC file opens with a version block: a header line, a line with the version, and the names of the
fields. Version 1 records have five fields in their header line, version 2 records ten; the last one is
the declared length of what follows. Conversion keeps the payload and makes up what WARC asks for:
an identifier (a UUID of the record's own data, so that a rerun gives the same), the time in ISO form, a
type, and SHA-1 digests of block and payload.

Archives are packed inside tasks up to a size, and written by Spark's text writer, one archive a file;
they are read as binary files. Nothing passes through the driver.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dragoman.functions.plan import shared_folder
from dragoman.llm.common import bound_batches

#: Uncompressed bytes of an archive, about; a larger record has an archive of its own.
ARCHIVE_BYTES = 16 << 20
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # that of URLs
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, record_type string, target_uri string, date string, ip string, content_type string, payload binary, "
          "payload_bytes long, payload_digest string, block_digest string, refers_to_id string, refers_to_order string, http_headers string, problem string")
NAMES = [f.split()[0] for f in RECORD.split(", ")]
_ARROW = pa.schema([(n, {"binary": pa.binary(), "long": pa.int64()}.get(f.split()[1], pa.string())) for n, f in zip(NAMES, RECORD.split(", "))])


def _batches(rows: Iterator[dict], schema: pa.Schema, size: Callable[[dict], int]) -> Iterator[pa.RecordBatch]:
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += size(row)
        if held_bytes >= 4 << 20 or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _packed(batches: Iterator[pa.RecordBatch], head: bytes, tail: int, pack: Callable[[dict], bytes]) -> Iterator[pa.RecordBatch]:
    """Archives of ``head`` and packed rows; the writer adds the last ``tail`` bytes back as its line end."""
    def archive(parts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-tail]], pa.binary())], ["archive"])

    parts, size = [head], 0
    for batch in batches:
        for row in batch.to_pylist():
            part = pack(row)
            if size and size + len(part) > ARCHIVE_BYTES:
                yield archive(parts)
                parts, size = [head], 0
            parts.append(part)
            size += len(part)
    if size:
        yield archive(parts)


def _write(archives: DataFrame, folder: str, end: str) -> None:
    # a binary value cast to a string keeps its bytes, and the text writer copies them
    writer = archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", end)
    writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(folder)


# ---- ARC

def arc_head(version: int) -> bytes:
    """Version block of an archive."""
    body = f"{version} 0 -\n{FIELDS[version]}\n\n".encode()
    rest = f"{len(body)}" if version == 1 else f"200 - - 0 - {len(body)}"
    return f"filedesc://packed.arc 0.0.0.0 19960101000000 text/plain {rest}\n".encode() + body + b"\n"


def arc_record(row: dict, version: int) -> bytes:
    """Header line, network document and line feed of a row (url, ip, date, content_type, document)."""
    document = row["document"] or b""
    word = lambda name, default: re.sub(r"\s", "%20", row.get(name) or default)
    fields = [word("url", "-"), word("ip", "0.0.0.0"), word("date", "19700101000000"), word("content_type", "no-type")]
    if version == 2:
        fields += ["200", "-", "-", "0", "-"]
    return " ".join([*fields, str(len(document))]).encode() + b"\n" + document + b"\n"


def write_arc(rows: DataFrame, folder: str, version: int = 1) -> None:
    """Write rows (url, ip, date, content_type, document binary) as ARC archives into ``folder``."""
    bound_batches(rows.sparkSession)
    head = arc_head(version)
    _write(rows.mapInArrow(lambda b: _packed(b, head, 1, lambda r: arc_record(r, version)), "archive binary"), folder, "\n")


def http_response(payload: Column, content_type: str = "text/html; charset=utf-8", extra: Column | None = None) -> Column:
    """An HTTP response with ``payload`` as its body; ``extra`` holds further header lines, each with its line end."""
    head = F.concat(F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\n"), extra if extra is not None else F.lit(""),
                    F.lit("Content-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), payload)


def parse_arc(stream) -> Iterator[dict]:
    """Records of an ARC stream: {url, ip, date, content_type, document, problem}.

    A line that is no header line is passed over until one is found, as one record with a problem; a document that
    ends early is a record with a problem and what there is of it.
    """
    n_fields, skipped = 5, 0
    while line := stream.readline():
        if line.strip(b"\r\n") == b"":
            continue
        fields = line.rstrip(b"\r\n").decode("utf-8", "replace").split(" ")
        if fields[0].startswith("filedesc://"):
            size = int(fields[-1]) if fields[-1].isdigit() else 0
            body = stream.read(size).decode("utf-8", "replace")
            n_fields = 10 if body[:1] == "2" else 5
            continue
        # addresses of old crawls may hold spaces, so the fields are counted from the end
        if len(fields) < n_fields or not fields[-1].isdigit() or not re.fullmatch(r"\d{8,17}", fields[2 - n_fields]):
            skipped += 1
            if skipped == 1:
                yield {"url": None, "ip": None, "date": None, "content_type": None, "document": b"", "problem": "no header line"}
            continue
        skipped, size = 0, int(fields[-1])
        document = stream.read(size)
        yield {"url": " ".join(fields[:1 - n_fields]), "ip": fields[1 - n_fields], "date": fields[2 - n_fields], "content_type": fields[3 - n_fields],
               "document": document, "problem": None if len(document) == size else "ends early"}


def iso_date(date: str | None) -> str | None:
    """YYYYMMDD[hh[mm[ss]]] as ISO 8601; null if it is no date."""
    if not date or not re.fullmatch(r"\d{8,17}", date):
        return None
    d = date[:14].ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def sha1(data: bytes) -> str:
    return hashlib.sha1(data).hexdigest()


def split_http(document: bytes) -> tuple[bytes, bytes]:
    """Head of an HTTP response with its empty line, and payload; no head if there is none."""
    if not document.startswith(b"HTTP/"):
        return b"", document
    ends = [m for m in (re.search(rb"\r\n\r\n", document), re.search(rb"\n\n", document)) if m]
    cut = min((m.end() for m in ends), default=len(document))
    return document[:cut], document[cut:]


def converted(record: dict) -> dict:
    """The WARC record equivalent to an ARC record."""
    head, payload = split_http(record["document"])
    kind = "response" if head or (record["url"] or "").startswith("dns:") else "resource"
    block = sha1(record["document"])
    name = "\n".join([record["url"] or "", record["date"] or "", block])
    content = "application/http; msgtype=response" if head else record["content_type"]
    return {"record_id": f"urn:uuid:{uuid.uuid5(NAMESPACE, name)}", "record_type": kind, "target_uri": record["url"], "date": iso_date(record["date"]),
            "ip": record["ip"], "content_type": content, "payload": payload, "payload_bytes": len(payload), "payload_digest": sha1(payload),
            "block_digest": block, "refers_to_id": None, "refers_to_order": None, "http_headers": head.decode("latin-1") if head else None, "problem": record["problem"]}


def _read(spark: SparkSession, folder: str, parse: Callable[[io.BufferedReader], Iterator[dict]]) -> DataFrame:
    bound_batches(spark)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for content in batch.column(0):
                    raw = content.as_buffer()
                    stream = io.BufferedReader(pa.BufferReader(raw)) if raw[:2].to_pybytes() != b"\x1f\x8b" else gzip.GzipFile(fileobj=pa.BufferReader(raw))
                    yield from parse(stream)
        yield from _batches(rows(), _ARROW, lambda r: len(r["payload"] or b"") + 400)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*[!_]").load(folder)
    return files.filter("length > 0").select("content").mapInArrow(records, RECORD)


def convert_arc(spark: SparkSession, folder: str) -> DataFrame:
    """The ARC archives below ``folder`` as WARC records (columns of ``RECORD``), digests in lower-case hex.

    Plain and gzip archives of version 1 and 2 are read, each by one task. An empty folder gives no rows.
    """
    return _read(spark, folder, lambda stream: map(converted, parse_arc(stream)))


# ---- WARC

def _base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def warc_record(row: dict) -> bytes:
    """A record's bytes: a response carries head and payload, a revisit its head alone."""
    head = (row["http_headers"] or "").encode("latin-1")
    block = head + (b"" if row["record_type"] == "revisit" else row["payload"] or b"")
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", row["date"]),
              ("WARC-Target-URI", row["target_uri"]), ("WARC-IP-Address", row["ip"]), ("Content-Type", row["content_type"]),
              ("WARC-Payload-Digest", _base32(row["payload_digest"])), ("WARC-Block-Digest", _base32(sha1(block)))]
    if row["record_type"] == "revisit":
        fields += [("WARC-Refers-To", f"<{row['refers_to_id']}>"), ("X-Refers-To-Order", row["refers_to_order"]), ("WARC-Profile", REVISIT_PROFILE),
                   ("X-Payload-Length", str(row["payload_bytes"]))]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_warc(records: DataFrame, folder: str) -> None:
    """Write records (columns of ``RECORD``) as WARC archives into ``folder``."""
    bound_batches(records.sparkSession)
    info = b"software: dragoman\r\nformat: WARC File Format 1.1\r\n"
    head = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMESPACE, 'warcinfo')}>\r\nWARC-Date: 1996-01-01T00:00:00Z\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n").encode() + info + b"\r\n\r\n"
    _write(records.select(*NAMES).mapInArrow(lambda b: _packed(b, head, 4, warc_record), "archive binary"), folder, "\r\n\r\n")


def parse_warc(stream) -> Iterator[dict]:
    """Records of a WARC stream but for warcinfo; digests are checked where the payload is there."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields.get("content-length", "0"))
        block = stream.read(size)
        if fields.get("warc-type") == "warcinfo":
            continue
        head, payload = split_http(block) if "application/http" in fields.get("content-type", "") else (b"", block)
        declared = fields.get("warc-payload-digest", "").partition(":")[2]
        digest = base64.b32decode(declared).hex() if declared else sha1(payload)
        revisit, problem = fields.get("warc-type") == "revisit", None
        if len(block) < size:
            problem = "ends early"
        elif not revisit and digest != sha1(payload):
            problem = "digest differs"
        yield {"record_id": fields.get("warc-record-id", "").strip("<>"), "record_type": fields.get("warc-type"), "target_uri": fields.get("warc-target-uri"),
               "date": fields.get("warc-date"), "ip": fields.get("warc-ip-address"), "content_type": fields.get("content-type"),
               "payload": None if revisit else payload, "payload_bytes": int(fields.get("x-payload-length", len(payload))), "payload_digest": digest,
               "block_digest": sha1(block), "refers_to_id": fields.get("warc-refers-to", "").strip("<>") or None,
               "refers_to_order": fields.get("x-refers-to-order"), "http_headers": head.decode("latin-1") if head else None, "problem": problem}


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the WARC archives below ``folder``; revisits have a null payload and their referent's size and digest."""
    return _read(spark, folder, parse_warc)


def with_revisits(records: DataFrame, order: Column, min_bytes: int = 1000) -> DataFrame:
    """Turn records into revisits of the record with the same payload and the largest ``order``, which they name.

    Payloads below ``min_bytes`` always stay. Ties on the order go to the largest record identifier. The digests are
    grouped with partial sums; the records themselves are joined to one row for each repeated digest, and
    AQE splits a payload that a large part of them shares.
    """
    large = F.col("payload_bytes") >= min_bytes
    rank = F.struct(order.alias("rank"), F.col("record_id").alias("id"))
    repeated = records.filter(large).groupBy("payload_digest").agg(F.max(rank).alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeated = repeated.select(F.col("payload_digest").alias("_key"), F.col("first.id").alias("_first"), F.col("first.rank").cast("string").alias("_order"))
    key = F.when(large, F.col("payload_digest")).otherwise(F.col("record_id"))
    joined = records.join(repeated.hint("shuffle_hash"), key == F.col("_key"), "left")
    revisit = large & (F.col("_first") != F.col("record_id"))
    values = {"record_type": F.when(revisit, "revisit").otherwise(F.col("record_type")),
              "refers_to_id": F.when(revisit, F.col("_first")), "refers_to_order": F.when(revisit, F.col("_order")), "payload": F.when(~F.coalesce(revisit, F.lit(False)), F.col("payload"))}
    return joined.select(*[values.get(n, F.col(n)).alias(n) for n in NAMES])


def header_value(http_headers: Column, name: str) -> Column:
    """Value of a header line; null where it is missing."""
    return F.nullif(F.regexp_extract(http_headers, rf"(?im)^{re.escape(name)}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def page_documents(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows for ``write_arc`` from pages: an HTTP response around the html in UTF-8 (null: empty), the id in a header line."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    mark = F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col(id_col).cast("string"), F.lit("\r\n")), F.lit(""))
    return pages.select(F.col(url_col).alias("url"), F.lit("0.0.0.0").alias("ip"), F.lit("20240101000000").alias("date"),
                        F.lit("text/html").alias("content_type"), http_response(payload, extra=mark).alias("document"))


def archived(spark: SparkSession, pages: DataFrame, version: int = 1, **columns: str) -> DataFrame:
    """Pages through ARC archives, the converter, and WARC archives: one WARC record for each row of ``pages``.

    Rows without an id keep a null X-Page-Id; rows that repeat an id are records of their own. Both sets of archives
    lie in the shared checkpoint folder. An empty table gives no rows.
    """
    arc, warc = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    write_arc(page_documents(pages, **columns), arc, version)
    records = convert_arc(spark, arc)
    order = header_value(F.col("http_headers"), "X-Page-Id").cast("long")
    write_warc(with_revisits(records, order), warc)
    return read_warc(spark, warc)
