"""Legacy web archives (ARC) and their conversion to WARC.

An ARC file is a version block and then records: a header line whose fields depend on the version, the document
of the length it declares, a line end. The converter reads them and synthesises what WARC asks for: record
identifiers, timestamps, types, payload digests. Of records with equal payloads one is the response, the
others become revisits that refer to it.

Files are written by Spark's text writer, whose line separator is what ends a record, and read whole, one file
at a time, by its binary reader: no file is opened by path, so any storage that Spark knows will do. Files
are compressed as they are written. Only identifiers, digests and lengths are shuffled to find equal payloads; the
outcome travels to the archives, not the payloads to it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinfold.llm.common import staged
from coinfold.session import shared_dir

#: Payloads of fewer bytes are always stored.
LEAST_REVISIT = 1000
DATE = "20200101000000"
#: Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_FLUSH = 8_000_000


@dataclass(frozen=True)
class ArcRecord:
    url: str
    ip: str
    date: str
    kind: str
    block: bytes
    version: int


# ---- ARC ---------------------------------------------------------------------------------


def arc_url(url: str | None) -> str:
    """A URL fit for a header line: blanks and control characters as percent codes, ``-`` for none."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "") or "-"


def arc_start(name: str, version: int) -> bytes:
    """The version block of a file, without the line end after it."""
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n".encode()
    length = len(body)
    middle = "" if version == 1 else f"200 - - 0 {name} "
    return f"filedesc://{name} 0.0.0.0 {DATE} text/plain {middle}{length}\n".encode() + body


def arc_record(record: ArcRecord, name: str, offset: int) -> bytes:
    """One record without the line end after it."""
    middle = "" if record.version == 1 else f"200 - - {offset} {name} "
    line = f"{record.url} {record.ip} {record.date} {record.kind} {middle}{len(record.block)}\n"
    return line.encode("utf-8", "surrogatepass") + record.block


def read_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records of a file, compressed or not, without its version block. Damage raises ValueError."""
    packed = content[:2] == b"\x1f\x8b"
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if packed else io.BytesIO(content)
    version = None
    while line := stream.readline():
        if line in (b"\n", b"\r\n"):
            continue
        text = line.decode("utf-8", "surrogateescape").rstrip("\r\n")
        if version is None:
            if not text.startswith("filedesc://"):
                raise ValueError(f"an archive begins with its version block, not {text[:80]!r}")
            block = _exactly(stream, text.rsplit(" ", 1)[-1])
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown archive version {version}")
            continue
        fields = text.rsplit(" ", ARC_FIELDS[version].count(" "))  # old crawlers left blanks in URLs
        if len(fields) <= ARC_FIELDS[version].count(" "):
            raise ValueError(f"not a header line of version {version}: {text[:80]!r}")
        yield ArcRecord(*fields[:4], _exactly(stream, fields[-1]), version)


def _exactly(stream, length: str) -> bytes:
    wanted = int(length)
    block = stream.read(wanted)
    if len(block) != wanted:
        raise ValueError(f"the archive ends within a record of {wanted} bytes")
    return block


# ---- HTTP and WARC -----------------------------------------------------------------------


def http_block(page_id: int | None, payload: bytes) -> bytes:
    """A response as a crawler stores it."""
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    lines += [] if page_id is None else [f"X-Page-Id: {page_id}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """The head with its blank line, its fields in small letters, and the payload. Lines may end in bare line feeds; a
    block without a head is all payload, and one without a blank line all head."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    blank = re.search(rb"\r?\n\r?\n", block)
    head, payload = (block, b"") if blank is None else (block[: blank.end()], block[blank.end() :])
    lines = re.split(r"\r?\n", head.decode("latin-1"))[1:]
    return head, dict(x.lower().split(": ", 1) for x in lines if ": " in x), payload


def record_kind(record: ArcRecord) -> tuple[str, str]:
    """WARC type and content type of what the record holds: an answer over HTTP, of a name server, or a file as such."""
    if record.block.startswith(b"HTTP/"):
        return "response", "application/http; msgtype=response"
    if record.url.lower().startswith("dns:"):
        return "response", "text/dns"
    kind = record.kind if re.fullmatch(r"[\w.+-]+/[\w.+-]+", record.kind) else "application/octet-stream"
    return "resource", kind


def sha1_text(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(archive: str, nth: int) -> str:
    """An identifier that depends on a record's place alone: the number in the file's name, and its own."""
    part = re.search(r"part-(\d+)", archive)
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{part.group(1) if part else archive}/{nth}')}"


def warc_date(date: str) -> str:
    """14 digits, or the 12 or 8 of older files, as a timestamp."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    """One record without the two line ends after it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in {**fields, "Content-Length": str(len(block))}.items())
    return b"WARC/1.0\r\n" + head.encode("utf-8", "surrogateescape") + b"\r\n" + block


def converted(record: ArcRecord, archive: str, nth: int, refers: dict | None) -> bytes:
    """The WARC record of an ARC record; ``refers`` has id, url and date of the response it repeats."""
    head, _, payload = http_parts(record.block)
    kind, content = record_kind(record)
    block = head if refers else record.block
    fields = {
        "WARC-Type": "revisit" if refers else kind,
        "WARC-Record-ID": f"<{record_id(archive, nth)}>",
        "WARC-Date": warc_date(record.date),
        "WARC-Target-URI": record.url,
        "WARC-IP-Address": record.ip,
        "WARC-Payload-Digest": sha1_text(payload),
        "WARC-Block-Digest": sha1_text(block),
        "Content-Type": content,
    }
    if refers:
        fields |= {
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": f"<{refers['id']}>",
            "WARC-Refers-To-Target-URI": refers["url"],
            "WARC-Refers-To-Date": warc_date(refers["date"]),
        }
    return warc_record(fields, block)


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields, in small letters, and block of each record of a file, compressed or not."""
    packed = content[:2] == b"\x1f\x8b"
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if packed else io.BytesIO(content)
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:80]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogateescape").rstrip("\r\n").partition(": ")
            fields[name.lower()] = value
        yield fields, _exactly(stream, fields["content-length"])


# ---- Spark -------------------------------------------------------------------------------


def _flushed(rows: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row)
        if size >= _FLUSH:
            yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.binary())})
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.binary())})


def _write(records: DataFrame, path: str, between: str) -> None:
    text = records.select(F.col("value").cast("string").alias("value"))  # bytes stay as they are
    text.write.option("lineSep", between).option("compression", "gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").load(path).select(name.alias("archive"), "content")


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages (page_id, url, html) as ARC files, one a task, of version 1 and 2 by turns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        version, name = 1 + task % 2, f"pages-{task:05d}.arc"

        def rows():
            yield (start := arc_start(name, version))
            offset = len(start) + 1
            for batch in batches:
                for page_id, url, html in zip(*(batch.column(k) for k in range(3)), strict=True):
                    block = http_block(page_id.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass"))
                    record = ArcRecord(arc_url(url.as_py()), "0.0.0.0", DATE, "text/html", block, version)
                    yield (made := arc_record(record, name, offset))
                    offset += len(made) + 1

        yield from _flushed(rows())

    source = pages.select("page_id", *(F.col(c).cast("string").alias(c) for c in ("url", "html")))
    _write(source.mapInArrow(work, "value binary"), path, "\n")


def arc_index(spark: SparkSession, path: str) -> DataFrame:
    """archive, nth, page_id, url, date, payload_bytes, digest and id of each record of the files."""
    kinds = {"archive": pa.string(), "nth": pa.int64(), "page_id": pa.int64(), "url": pa.string(), "date": pa.string(), "payload_bytes": pa.int64(), "digest": pa.string(), "id": pa.string()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for nth, record in enumerate(read_arc(content.as_py())):
                    _, fields, payload = http_parts(record.block)
                    page = fields.get("x-page-id")
                    url = record.url.encode("utf-8", "replace").decode()
                    rows.append((archive.as_py(), nth, None if page is None else int(page), url, record.date, len(payload), hashlib.sha1(payload).hexdigest(), record_id(archive.as_py(), nth)))
                columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    shape = "archive string, nth long, page_id long, url string, date string, payload_bytes long, digest string, id string"
    return _files(spark, path).mapInArrow(work, shape)


def revisits(index: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """archive and its revisits, as array<struct<nth, id, url, date>> naming the response each repeats.

    Of the records with equal payloads of at least ``least`` bytes the one with the largest page_id is the
    response; of records that share that id, the last one.
    """
    known = index.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    best = known.groupBy("digest", "payload_bytes").agg(
        F.max(F.struct("page_id", "archive", "nth", "id", "url", "date")).alias("best"), F.count("*").alias("n")
    )
    again = known.select("archive", "nth", "digest", "payload_bytes").join(best.where("n > 1").drop("n"), ["digest", "payload_bytes"])
    again = again.where((F.col("archive") != F.col("best.archive")) | (F.col("nth") != F.col("best.nth")))
    # at most the records of one file
    return again.groupBy("archive").agg(F.collect_list(F.struct("nth", "best.id", "best.url", "best.date")).alias("revisits"))


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST_REVISIT) -> None:
    """ARC files to WARC files, one each."""
    found = staged(revisits(staged(arc_index(spark, arc_path), "arc-index"), least), "revisits")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for archive, content, listed in zip(*(batch.column(k) for k in range(3)), strict=True):
                    name = archive.as_py()
                    refers = {x["nth"]: x for x in listed.as_py() or ()}
                    yield warc_record(
                        {
                            "WARC-Type": "warcinfo", "WARC-Record-ID": f"<{record_id(name, -1)}>", "WARC-Date": warc_date(DATE),
                            "WARC-Filename": name.replace(".txt.gz", ".warc.gz"), "Content-Type": "application/warc-fields",
                        },
                        b"software: archive converter\r\nformat: WARC File Format 1.0\r\n",
                    )
                    for nth, record in enumerate(read_arc(content.as_py())):
                        yield converted(record, name, nth, refers.get(nth))

        yield from _flushed(rows())

    _write(_files(spark, arc_path).join(found, "archive", "left").mapInArrow(work, "value binary"), warc_path, "\r\n\r\n")


def warc_index(spark: SparkSession, path: str) -> DataFrame:
    """id, page_id, payload_bytes, payload_digest, record_type, refers_id of each response, resource and revisit of the files.

    Length and digest are those of the full payload: counted and computed anew for a response, which must agree with
    what the record states, as stated for a revisit.
    """
    kinds = {"id": pa.string(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_id": pa.string()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for fields, block in read_warc(content.as_py()):
                    kind = fields["warc-type"]
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    _, http, payload = http_parts(block)
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    size = len(payload) if kind != "revisit" else int(http["content-length"])
                    stated = fields.get("warc-block-digest", sha1_text(block)) == sha1_text(block)
                    if not stated or (kind != "revisit" and digest != hashlib.sha1(payload).hexdigest()):
                        raise ValueError(f"{fields['warc-record-id']}: the payload is not what the record states")
                    page = http.get("x-page-id")
                    refers = fields.get("warc-refers-to")
                    rows.append((fields["warc-record-id"].strip("<>"), None if page is None else int(page), size, digest, kind, refers and refers.strip("<>")))
                columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    shape = "id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_id string"
    return _files(spark, path).mapInArrow(work, shape)


def archived(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: pages written as ARC, converted, read back.

    One row for every row of ``pages`` (page_id, url, html). Defined cases: a null page is an empty payload; a null or
    unprintable URL is written as ``arc_url`` says; rows that repeat an id are records of their own, of which one
    is the response if their payloads are equal; a record without id is always a response; an empty table gives no
    rows. Other columns are ignored. The digest is the SHA-1 of the full payload in lower-case hex.
    """
    spark = pages.sparkSession
    arc, warc = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    write_arc(pages, arc)
    convert_arc(spark, arc, warc)
    found = staged(warc_index(spark, warc), "warc-index")
    named = found.where("record_type = 'response'").select(F.col("id").alias("of"), F.col("page_id").alias("refers_to"))
    revisit = found.where("record_type = 'revisit'")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        found.where("record_type = 'response'")
        .withColumn("refers_to", F.lit(None).cast("long"))
        .select(*columns)
        .unionByName(revisit.join(named, revisit["refers_id"] == named["of"], "left").select(*columns))
    )


ARCHIVE_SQL = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
best AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS most FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id < most THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id < most THEN most END AS refers_to
FROM best"""
