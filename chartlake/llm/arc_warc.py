"""Legacy archive converter: ARC archives in, WARC archives out.

``pages_to_arc`` packs pages into ARC archives (version 1 or 2), one bounded
binary value each; ``read_arc`` parses archives by their version block and the
declared lengths of their records, from such values or from files read with
``spark.read.format("binaryFile")``; ``to_warc`` synthesises the equivalent
WARC/1.1 identifiers, dates, types and digests; ``write_warc`` and
``read_warc`` go through gzip files in a shared folder, a gzip member a record,
again by declared lengths (payloads may hold any line break or header-like text).

Payloads and HTTP heads are bytes from end to end, so pages of any encoding keep
theirs.  A block without an HTTP head (``dns:`` and the like) is all payload and
becomes a ``resource`` record of its own content type.  Header lines that are not
UTF-8 are read with the replacement character.

Of HTTP records with equal payloads of at least ``min_bytes`` bytes, the one with
the largest page id is the response; the others are revisit records without a
body that name its record id (ties on the id: all are responses; a null id is
smallest).  The HTTP header keeps the payload's length, so a revisit still
tells it (null if that header has none).  Archives are cut by their bytes, so a
file holds ``ARCHIVE_BYTES`` and a record at most, whatever the order of sizes.

Defined results: null html is an empty payload; null urls become an empty
field; repeated rows give one record each, with the same record id; an empty
table gives no archives.  Page ids are integers, or texts that spell one; any other text id raises (ANSI casts).
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.llm.common import col, shared_folder
from chartlake.session import cut_lineage

#: Bytes of one archive value or file, before it is zipped.
ARCHIVE_BYTES = 4 << 20
#: The date of pages that come without one.
ARC_DATE = "20260101000000"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
RECORD = ("page_id long, url string, ip string, arc_date string, content_type string, status int, head binary, "
          "payload binary, payload_bytes long, payload_digest string")
READ = ("record_id string, record_type string, refers_to_id string, page_id long, url string, warc_date string, "
        "payload_bytes long, payload_digest string, body_bytes long, body_digest string")
# the field lines that the version blocks of ARC files declare (fixed values of the format)
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(text: str) -> str:
    """An ARC field holds no blanks and is never empty."""
    return "".join(f"%{ord(c):02X}" if c in " \t\n\r\x0b\x0c%" else c for c in text) or "-"


def _plain(text: str) -> str:
    if text == "-":
        return ""
    out, i = [], 0
    while i < len(text):
        if text[i] == "%" and i + 2 < len(text) + 0 and text[i + 1:i + 3] in ("20", "09", "0A", "0D", "0B", "0C", "25"):
            out.append(chr(int(text[i + 1:i + 3], 16)))
            i += 3
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def _version_block(version: int) -> bytes:
    body = f"{version} 0 converter\n{ARC_FIELDS[version]}\n".encode()
    last = f"{len(body)}" if version == 1 else f"200 - - 0 pages {len(body)}"
    return f"filedesc://pages.arc 0.0.0.0 {ARC_DATE} text/plain {last}\n".encode() + body + b"\n"


def _arc_record(version: int, page_id: int | None, url: str | None, payload: bytes, date: str = ARC_DATE) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    middle = "" if version == 1 else "200 - - 0 pages "
    return f"{_field(url or '')} 0.0.0.0 {date} text/html {middle}{len(block)}\n".encode("utf-8", "surrogatepass") + block + b"\n"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def archive(made: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(made)], pa.binary())], names=["content"])

    version, made, size = 1, [], 0
    for batch in batches:
        for page_id, url, html, date in zip(*batch.columns, strict=True):
            if not made:
                made, size = [_version_block(version)], 0
            made.append(_arc_record(version, page_id.as_py(), url.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass"), date.as_py()))
            size += len(made[-1])
            if size >= ARCHIVE_BYTES:
                yield archive(made)
                version, made = 3 - version, []
    if made:
        yield archive(made)


def _chosen(pages: DataFrame, id_col: str, url_col: str, html_col: str, date_col: str | None) -> DataFrame:
    date = F.lit(ARC_DATE) if date_col is None else F.coalesce(F.date_format(col(date_col).cast("timestamp"), "yyyyMMddHHmmss"), F.lit(ARC_DATE))
    return pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url"), col(html_col).cast("string").alias("html"), date.alias("date"))


def pages_to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date_col: str | None = None) -> DataFrame:
    """(content binary): archives of about ``ARCHIVE_BYTES``, of both versions in turn.  Ids are whole numbers."""
    return _chosen(pages, id_col, url_col, html_col, date_col).mapInArrow(_pack, "content binary")


_HEAD_END = re.compile(rb"\r?\n\r?\n")


def _parts(block: bytes) -> tuple[bytes, bytes]:
    """(HTTP head with the empty line behind it, payload); the head is empty if there is none."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = _HEAD_END.search(block)
    return (block[:end.end()], block[end.end():]) if end else (block, b"")


def _http(head: bytes) -> dict[str, str]:
    """Header lines of an HTTP head by lower-case name."""
    lines = head.decode("utf-8", "replace").splitlines()[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,18}", text) else None


def parse_arc(data: bytes) -> Iterator[dict]:
    """The records of one archive; the version block says how header lines are to be read."""
    names, at = None, 0
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):  # a separator between records
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        fields = line.split(" ")
        length = int(fields[-1])
        start, at = end + 1, end + 1 + length
        if at > len(data):
            raise ValueError(f"an ARC record declares {length} bytes, {len(data) - start} are left")
        block = data[start:at]
        if fields[0].startswith("filedesc://"):
            version = int(block.split(b"\n")[0].split(b" ")[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            names = ARC_FIELDS[version].split(" ")
            continue
        if names is None:
            raise ValueError("an ARC file starts with its version block")
        if len(fields) != len(names):
            raise ValueError(f"an ARC header line needs {len(names)} fields: {line[:200]!r}")
        record = dict(zip(names, fields, strict=True))
        head, payload = _parts(block)
        status = re.match(rb"HTTP/\S+ +([0-9]{3})", head)
        yield {"page_id": _number(_http(head).get("x-page-id")), "url": _plain(record["URL"]), "ip": record["IP-address"],
               "arc_date": record["Archive-date"], "content_type": record["Content-type"],
               "status": int(status[1]) if status else None,
               "head": head, "payload": payload, "payload_bytes": len(payload), "payload_digest": digest_of(payload)}


_RECORD = pa.schema([(a, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}.get(b, pa.string())) for a, b in (x.split() for x in RECORD.split(", "))])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0):
            data = value.as_py() or b""
            if data[:2] == b"\x1f\x8b":
                data = gunzip(data)
            rows, size = [], 0
            for record in parse_arc(data):
                rows.append(record)
                size += record["payload_bytes"]
                if size > ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)


def read_arc(archives: DataFrame, content_col: str = "content") -> DataFrame:
    """The records of ARC archives given as binary values, gzipped or not."""
    return archives.select(col(content_col)).mapInArrow(_unpack, RECORD)


def records_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date_col: str | None = None) -> DataFrame:
    """``read_arc(pages_to_arc(pages))`` in one Python worker a task: the
    archives are written and parsed there and never leave it."""
    return _chosen(pages, id_col, url_col, html_col, date_col).mapInArrow(lambda batches: _unpack(_pack(batches)), RECORD)


def gunzip(data: bytes) -> bytes:
    """All members of a gzip file, in time proportional to its size."""
    out, member = [], zlib.decompressobj(31)
    for at in range(0, len(data), 1 << 16):
        piece = data[at:at + (1 << 16)]
        while piece:
            out.append(member.decompress(piece))
            piece = member.unused_data
            if member.eof:
                member = zlib.decompressobj(31)
    return b"".join(out)


def _gzip(data: bytes) -> bytes:
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(data) + member.flush()


def _record_id(page_id, digest):
    """A name-based identifier (version 5 layout) from page id and payload digest."""
    h = F.sha1(F.concat_ws(":", F.lit(str(NAMESPACE)), F.coalesce(page_id.cast("string"), F.lit("")), digest))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"),
                    variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def to_warc(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, warc binary): one WARC record per ARC record, without the
    two line ends behind it.  Winners per digest are combined on the map side;
    those of repeated digests are written before the records meet them, so that
    the skew join may split a payload that many pages share."""
    http = F.octet_length("head") > 0
    big = http & (F.col("payload_bytes") >= min_bytes)
    best = cut_lineage(records.where(big).groupBy(F.col("payload_digest").alias("d"))
                       .agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").select("d", "best"))
    joined = records.join(best, (F.col("payload_digest") == F.col("d")) & big, "left")
    revisit = F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    date = F.regexp_replace("arc_date", r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    body = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    own = _record_id(F.col("page_id"), F.col("payload_digest"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).when(http, F.lit("response")).otherwise(F.lit("resource"))),
        F.concat(F.lit("WARC-Record-ID: "), own),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", "%0A")),
        F.concat(F.lit("WARC-IP-Address: "), F.col("ip")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("best"), F.col("payload_digest")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("Content-Type: "), F.when(http, F.lit("application/http; msgtype=response")).otherwise(F.col("content_type"))),
        F.concat(F.lit("Content-Length: "), F.octet_length("body").cast("string")),
    ]
    head = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n")).cast("binary")
    return joined.withColumn("body", body).select("page_id", F.concat(head, F.col("body")).alias("warc"))


def _archives(archive_bytes: int):
    """(warc) -> (archive): gzip members, a record each, joined up to ``archive_bytes`` and one record of plain bytes"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for batch in batches:
            for record in batch.column(0):
                data = record.as_py()
                made.append(_gzip(data + b"\r\n\r\n"))
                size += len(data)
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(made)], pa.binary())], names=["archive"])
                    made, size = [], 0
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(made)], pa.binary())], names=["archive"])

    return run


def write_warc(warc: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Gzip archives, a file each, as the partitions come, cut by bytes.

    A file is one row of Spark's text writer, which writes the bytes of a string
    as they are; what it puts behind a row, here behind all of a file, is an empty
    gzip member."""
    warc.select("warc").mapInArrow(_archives(archive_bytes), "archive binary").select(F.col("archive").cast("string").alias("archive")) \
        .write.option("encoding", "ISO-8859-1").option("lineSep", _gzip(b"").decode("ISO-8859-1")).option("maxRecordsPerFile", 1).text(folder)


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *rest = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/1."):
            raise ValueError(f"not a WARC record: {first[:80]!r}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in rest)
        start, length = end + 4, int(headers["Content-Length"])
        at = start + length
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"a WARC record does not end where it declares: {headers.get('WARC-Record-ID')}")
        yield headers, data[start:at]
        at += 4


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder``; the body's own length
    and digest are computed anew, and a response whose headers tell others fails."""
    schema = pa.schema([(a, pa.int64() if b == "long" else pa.string()) for a, b in (x.split() for x in READ.split(", "))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                rows = []
                for headers, block in parse_warc(gunzip(value.as_py())):
                    head, payload = _parts(block)
                    http = _http(head)
                    digest, body = headers["WARC-Payload-Digest"].removeprefix("sha1:"), digest_of(payload)
                    own = headers["WARC-Type"] != "revisit"  # a revisit has no body of its own
                    told = _number(http.get("content-length"))
                    ours = "x-page-id" in http and told != len(payload)  # other archives may tell the length of what was sent
                    if own and (body != digest or ours):
                        raise ValueError(f"the body of a WARC record is not the one its headers tell of: {headers['WARC-Record-ID']}")
                    size = len(payload) if own else told
                    rows.append({
                        "record_id": headers["WARC-Record-ID"], "record_type": headers["WARC-Type"], "refers_to_id": headers.get("WARC-Refers-To"),
                        "page_id": _number(http.get("x-page-id")), "url": headers["WARC-Target-URI"], "warc_date": headers["WARC-Date"],
                        "payload_bytes": size, "payload_digest": digest, "body_bytes": len(payload), "body_digest": body})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(parse, READ)


def with_referents(records: DataFrame) -> DataFrame:
    """Records as ``read_warc`` gives them, with refers_to: the page id of the
    response that a revisit names (null for responses).

    Only revisits are joined, as the responses' missing names would all meet in
    one task; the named responses are written first, so that the revisits of one
    response can be split."""
    held = cut_lineage(records)  # the archives are parsed once
    revisits = held.where(F.col("refers_to_id").isNotNull())
    named = cut_lineage(held.where(F.col("record_type") == "response").select("record_id", "page_id")
                        .join(revisits.select(F.col("refers_to_id").alias("record_id")).distinct(), "record_id", "left_semi")
                        .groupBy(F.col("record_id").alias("refers_to_id")).agg(F.max("page_id").alias("refers_to")))
    responses = held.where(F.col("refers_to_id").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    return revisits.join(named, "refers_to_id", "left").unionByName(responses)


def convert(pages: DataFrame, min_bytes: int = 0, date_col: str | None = None) -> tuple[DataFrame, str]:
    """Pages through ARC archives into WARC archives and back: (records read back, folder)."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_warc(to_warc(records_of(pages, date_col=date_col), min_bytes), folder)
    return read_warc(spark, folder), folder
