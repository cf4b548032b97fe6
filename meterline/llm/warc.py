"""Legacy ARC archives to WARC: parsing by version and declared length, and conversion.

Archives are written with Spark's text writer, whose line separator is the
blank that ends a record, and read as whole files that a task decompresses and
parses as a stream, one record in memory at a time.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.llm.common import scratch

#: Header fields of ARC version 1 and 2, in the order of the format (fixed values).
ARC_FIELDS = {
    "1": ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    "2": ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
          "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 1000
#: Usual size of an archive, before compression.
ARCHIVE_BYTES = 100_000_000
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_EPOCH = datetime(2020, 1, 1, tzinfo=timezone.utc)


class Stream:
    """Lines and blocks of the possibly compressed bytes of one file, in bounded memory."""

    def __init__(self, data: bytes, chunk: int = 1 << 18):
        self.data, self.chunk, self.at, self.buffer, self.offset = data, chunk, 0, bytearray(), 0
        self.unzip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.unzip is None:
            part = self.data[self.at:self.at + self.chunk]
            self.at += len(part)
        else:
            if self.unzip.eof:
                rest = self.unzip.unused_data
                if not rest and self.at >= len(self.data):
                    return False
                self.unzip = zlib.decompressobj(31)
                part = self.unzip.decompress(rest) if rest else b""
            else:
                part = b""
            if not part:
                raw = self.data[self.at:self.at + self.chunk]
                self.at += len(raw)
                if not raw:
                    return False
                part = self.unzip.decompress(raw)
                self.buffer += part
                return True
        self.buffer += part
        return bool(part)

    def line(self) -> bytes | None:
        """The next line without its newline; None at the end."""
        start = 0
        while (end := self.buffer.find(b"\n", start)) < 0:
            start = len(self.buffer)
            if not self._more():
                if not self.buffer:
                    return None
                end = len(self.buffer)
                break
        out = bytes(self.buffer[:end])
        del self.buffer[:end + 1]
        self.offset += end + 1
        return out

    def block(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._more():
                raise ValueError(f"record of {size} bytes is cut off at offset {self.offset}")
        out = bytes(self.buffer[:size])
        del self.buffer[:size]
        self.offset += size
        return out


def arc_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of every record; the first tells the version."""
    stream, version = Stream(data), None
    while True:
        offset, line = stream.offset, stream.line()
        if line is None:
            return
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").rstrip("\r").split(" ")
        if version is None:
            if not values[0].startswith("filedesc://"):
                raise ValueError("an archive begins with its filedesc record")
            block = stream.block(int(values[-1]))
            version = block.split(b" ", 1)[0].decode("ascii", "replace")
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown archive version {version!r}")
        else:
            block = None
        names = ARC_FIELDS[version]
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"no header of version {version} at offset {offset}: {line[:200]!r}")
        yield offset, dict(zip(names, values)), stream.block(int(values[-1])) if block is None else block


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record, by its Content-Length."""
    stream = Stream(data)
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no record at offset {stream.offset}: {line[:80]!r}")
        fields = {}
        while (line := stream.line()) is not None and line.strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.block(int(fields["content-length"]))


def warc_date(stamp: str) -> str:
    """ISO form of an archive date of 14 digits, or fewer from the left; the epoch if it is none."""
    digits = re.sub(r"\D", "", stamp)[:14]
    for size, form in ((14, "%Y%m%d%H%M%S"), (12, "%Y%m%d%H%M"), (10, "%Y%m%d%H"), (8, "%Y%m%d")):
        if len(digits) >= size:
            try:
                return datetime.strptime(digits[:size], form).strftime("%Y-%m-%dT%H:%M:%SZ")
            except ValueError:
                continue
    return "1970-01-01T00:00:00Z"


def _head(fields: list[tuple[str, str]]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(head with its blank line, payload) of a block with an HTTP head, else (empty, block)."""
    if block.startswith(b"HTTP/"):
        head, mark, body = block.partition(b"\r\n\r\n")
        return head + mark, body
    return b"", block


def _http_field(head: bytes, name: str) -> str | None:
    m = re.search(rf"(?im)^{name}:[ \t]*(.*?)\r?$", head.decode("utf-8", "replace"))
    return m.group(1) if m else None


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _hex(digest: str) -> str:
    return base64.b32decode(digest.removeprefix("sha1:")).hex()


def _arc_rows(per_page):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, first = TaskContext.get().partitionId(), True
        version = "12"[part % 2]
        names, name = ARC_FIELDS[version], f"part-{part:05d}.arc"
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if first:
                    about = f"{version} 0 meterline\n{' '.join(names)}\n"
                    out.append(_arc_head(names, f"filedesc://{name}", "0.0.0.0", _EPOCH, "text/plain",
                                         len(about), name) + "\n" + about)
                    first = False
                url, ip, when, kind, block = per_page(*row)
                out.append(_arc_head(names, url, ip, when, kind, len(block.encode("utf-8", "surrogatepass")), name)
                           + "\n" + block)
                if sum(map(len, out[-50:])) > 4_000_000 or len(out) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
    return run


def _arc_head(names, url: str, ip: str, when: datetime, kind: str, size: int, archive: str) -> str:
    known = {"URL": _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url) or "urn:none", "IP-address": ip,
             "Archive-date": when.strftime("%Y%m%d%H%M%S"), "Content-type": kind, "Archive-length": str(size),
             "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": archive}
    return " ".join(known[n] for n in names)


def _page(page_id, url, html):
    html = html or ""
    size = len(html.encode("utf-8", "surrogatepass"))
    mark = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {size}\r\n\r\n{html}")
    return url or "", "0.0.0.0", _EPOCH + timedelta(seconds=(page_id or 0) % 10**8), "text/html", block


def archive_count(pages: DataFrame) -> int:
    """Files of about ARCHIVE_BYTES for the html of `pages`, at least one per core of the cluster."""
    size = pages.agg(F.coalesce(F.sum(F.octet_length(F.col("html").cast("string"))), F.lit(0))).first()[0]
    return max(pages.sparkSession.sparkContext.defaultParallelism, -(-size // ARCHIVE_BYTES))


def _written_text(rows: DataFrame, path: str, separator: str, files: int | None) -> None:
    """Text rows, each ended by `separator`, as gzip files; fast compression, since they are read once or twice."""
    (rows.coalesce(files) if files else rows).write.option("lineSep", separator).option(
        "compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_arc(pages: DataFrame, path: str, files: int | None = None) -> None:
    """One record per row of `pages` (page_id, url, html); files are of version 1 or 2 by turns.

    A file per partition, or `files` at most.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    base = base.coalesce(files) if files else base
    _written_text(base.mapInArrow(_arc_rows(_page), "value string"), path, "\n", None)


_CONVERTED = ("record_id string, type string, fields array<struct<name:string,value:string>>, head binary, "
              "payload binary, payload_digest string, payload_bytes long, page_id long")


def _convert(narrow: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                name = path.rsplit("/", 1)[-1]
                for offset, arc, block in arc_records(content.as_buffer().to_pybytes()):
                    rows.append(_record(name, offset, arc, block, narrow))
                    size += len(block)
                    if size > 4_000_000 or len(rows) >= 500:
                        yield _converted_batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _converted_batch(rows)
    return run


def _record(name: str, offset: int, arc: dict[str, str], block: bytes, narrow: bool) -> dict:
    head, payload = split_http(block)
    url, mime = arc["URL"], arc["Content-type"]
    if url.startswith("filedesc://"):
        kind, mime, head, payload = "warcinfo", "application/warc-fields", b"", (
            f"software: meterline\r\nformat: WARC File Format 1.1\r\ndescription: converted from {name}\r\n").encode()
    elif head:
        kind, mime = "response", "application/http; msgtype=response"
    else:
        kind = "resource"
    fields = [("WARC-Date", warc_date(arc["Archive-date"])), ("Content-Type", mime)]
    if kind != "warcinfo":
        fields += [("WARC-Target-URI", url), ("WARC-IP-Address", arc["IP-address"])]
    page = _http_field(head, "X-Page-Id")
    return {
        "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>", "type": kind,
        "fields": [{"name": k, "value": v} for k, v in fields], "head": None if narrow else head,
        "payload": None if narrow else payload, "payload_digest": _sha1(payload), "payload_bytes": len(payload),
        "page_id": int(page) if page else None}


def _converted_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("record_id", pa.string()), ("type", pa.string()),
        ("fields", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
        ("head", pa.binary()), ("payload", pa.binary()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("page_id", pa.int64())]))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _warc_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            kind = "revisit" if r["refers"] else r["type"]
            block = r["head"] if r["refers"] else r["head"] + r["payload"]
            fields = [("WARC-Type", kind), ("WARC-Record-ID", r["record_id"])]
            fields += [(f["name"], f["value"]) for f in r["fields"]]
            if kind != "warcinfo":
                fields.append(("WARC-Payload-Digest", r["payload_digest"]))
            if r["refers"]:
                fields += [("WARC-Refers-To", r["refers"]), ("WARC-Profile", REVISIT_PROFILE)]
            fields += [("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
            out.append(_head(fields) + block.decode("utf-8"))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, revisit_bytes: int = REVISIT_BYTES,
            files: int | None = None) -> None:
    """WARC files at `warc_path` with an equivalent record for each record of the ARC files at `arc_path`.

    Identifiers are derived from file and offset, dates from the archive's,
    types from the content (filedesc: warcinfo, an HTTP head: response, else
    resource), digests are SHA-1. Of responses with equal payloads of at least
    `revisit_bytes` bytes, the one with the largest page id (then record id)
    stays a response and the others become revisits that keep their HTTP head.
    Only digests are grouped; payloads move once, to meet their verdict. Blocks
    must be UTF-8, as Spark's writer takes text.
    """
    archives = _files(spark, arc_path)
    keys = archives.mapInArrow(_convert(True), _CONVERTED).where(
        (F.col("type") == "response") & (F.col("payload_bytes") >= revisit_bytes))
    originals = keys.groupBy("payload_digest").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("page_id"), "record_id")).alias("o"),
        F.count("*").alias("n")).where("n > 1").select(
        F.col("payload_digest").alias("_digest"), F.col("o.record_id").alias("original"))
    full = archives.mapInArrow(_convert(False), _CONVERTED)
    marked = full.join(originals, (F.col("payload_digest") == F.col("_digest")) & (F.col("type") == "response"), "left")
    marked = marked.select("record_id", "type", "fields", "head", "payload", "payload_digest", F.when(
        F.col("original") != F.col("record_id"), F.col("original")).alias("refers"))
    _written_text(marked.mapInArrow(_warc_text, "value string"), warc_path, "\r\n\r\n", files)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers", pa.string())])
    for batch in batches:
        rows = []
        for content in batch.column(1):
            for fields, block in warc_records(content.as_buffer().to_pybytes()):
                kind = fields["warc-type"]
                if kind == "warcinfo":
                    continue
                if _sha1(block) != fields["warc-block-digest"]:
                    raise ValueError(f"{fields['warc-record-id']}: the block does not have its digest")
                head, payload = split_http(block)
                page = _http_field(head, "X-Page-Id")
                size = len(payload)
                if kind == "revisit":
                    size = int(_http_field(head, "Content-Length") or 0)
                elif _sha1(payload) != fields["warc-payload-digest"]:
                    raise ValueError(f"{fields['warc-record-id']}: the payload does not have its digest")
                rows.append({"record_id": fields["warc-record-id"], "record_type": kind,
                             "page_id": int(page) if page else None, "payload_bytes": size,
                             "payload_digest": _hex(fields["warc-payload-digest"]),
                             "refers": fields.get("warc-refers-to")})
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, page_id, payload_bytes, payload_digest, refers) of all but warcinfo records.

    Digests are those of the full payload, in lower-case hex; blocks and
    payloads are checked against them. `refers` is the record a revisit names.
    """
    return _files(spark, path).mapInArrow(
        _parsed, "record_id string, record_type string, page_id long, payload_bytes long, payload_digest string, "
                 "refers string")


def page_archives(pages: DataFrame) -> DataFrame:
    """Writes `pages` as ARC, converts that to WARC, and reports each page as read back.

    Rows: page_id, payload_bytes, payload_digest, record_type, refers_to. A null
    html is an empty payload, a null url `urn:none`; a row without page_id
    comes back without one, and no refers_to can name it; of rows that repeat
    page_id and html one is the response; other columns are ignored; an empty
    table gives no rows.
    """
    spark = pages.sparkSession
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    files = archive_count(pages)
    write_arc(pages, arc, files)
    if _files(spark, arc).isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, "
                                         "record_type string, refers_to long")
    convert(spark, arc, warc, files=files)
    records = read_warc(spark, warc)
    plain = records.where("refers is null").drop("refers", "record_id").withColumn(
        "refers_to", F.lit(None).cast("long"))
    named = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"))
    return plain.unionByName(records.where("refers is not null").drop("record_id").join(named, "refers", "left").drop(
        "refers")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
