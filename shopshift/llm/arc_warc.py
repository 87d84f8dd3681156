"""Legacy ARC archives to WARC: write, convert, read.

``write_arc`` packs pages into ARC files of both header versions, ``arc_to_warc``
parses the version's header line and declared lengths and synthesises WARC
records (identifiers, dates, types, digests; equal payloads become revisits),
``read_warc`` reads the archives back.

Files are written by tasks under a temporary name and moved to a name that
depends on the partition alone, so a task that runs twice leaves one file.  They
are read by Spark's binaryFile source; a file is rolled at ``roll_bytes``, which
bounds what a task holds.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopshift.llm.common import stage, work_dir

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

ROLL_BYTES = 16 << 20
FEED_BYTES = 8 << 10
ITEM_HEADER = "X-Item-Id"
RECORD_SCHEMA = (
    "arc_file string, record_no long, version int, url string, ip string, archive_date string, mime string, "
    "is_http boolean, item_id long, payload_bytes long, payload_digest string"
)
WARC_SCHEMA = (
    "record_id string, record_type string, url string, warc_date string, item_id long, payload_bytes long, "
    "payload_digest string, digest_ok boolean, refers_to_id string, payload binary"
)


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _gzip(data: bytes) -> bytes:
    """One gzip member with no time stamp, so that equal input gives equal files."""
    return zlib.compress(data, 1, 31)


def _gunzip(data: bytes) -> bytes:
    """All gzip members of ``data`` (data that is not compressed is returned as it is)."""
    if data[:2] != b"\x1f\x8b":
        return data
    out, at, whole = [], 0, memoryview(data)
    while at < len(data):
        z = zlib.decompressobj(31)
        while not z.eof and at < len(data):  # a member at a time; what follows it isn't copied
            fed = whole[at : at + FEED_BYTES]
            out.append(z.decompress(fed))
            at += len(fed) - len(z.unused_data)
    return b"".join(out)


class _Roller:
    """Writes records to files of at most ``roll`` bytes before compression, each moved into place when complete."""

    def __init__(self, folder: str, part: int, attempt: int, suffix: str, roll: int, head) -> None:
        self.fs, self.folder = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder) if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        self.part, self.attempt, self.suffix, self.roll, self.head = part, attempt, suffix, roll, head
        self.file_no, self.size, self.sink = 0, 0, None

    def name(self) -> str:
        return f"part-{self.part:06d}-{self.file_no:05d}{self.suffix}"

    def add(self, make) -> int:
        """``make(file_no, offset)`` gives the record's bytes."""
        if self.sink is None:
            self.sink, self.size = io.BytesIO(), 0
            self.add_bytes(self.head(self.name(), self.file_no))
        data = make(self.file_no, self.size)
        self.add_bytes(data)
        if self.size >= self.roll:
            self.close()
        return len(data)

    def add_bytes(self, data: bytes) -> None:
        self.size += len(data)
        self.sink.write(_gzip(data))

    def close(self) -> None:
        if self.sink is None:
            return
        self.fs.create_dir(self.folder, recursive=True)
        temporary = f"{self.folder}/.{self.name()}.{self.attempt}"
        with self.fs.open_output_stream(temporary) as out:
            out.write(self.sink.getvalue())
        self.fs.move(temporary, f"{self.folder}/{self.name()}")
        self.sink, self.file_no = None, self.file_no + 1


def _roller(folder: str, suffix: str, roll: int, head) -> _Roller:
    task = TaskContext.get()
    return _Roller(folder, task.partitionId(), task.taskAttemptId(), suffix, roll, head)


def _field(value: str | None, empty: str) -> str:
    """A value without spaces or control characters, as the header line's fields must be."""
    return quote(value or "", safe="!#$%&'()*+,/:;=?@[]-._~") or empty


def _version(file_no: int) -> int:
    return 1 + file_no % 2


def _arc_head(date: str):
    def head(name: str, file_no: int) -> bytes:
        v = _version(file_no)
        body = f"{v} 0 {'reserved ' * (v == 2)}archive\n{ARC_FIELDS[v]}\n\n".encode()
        fields = f"filedesc://{name} 0.0.0.0 {date} text/plain" + (f" 200 - - 0 {name}" if v == 2 else "")
        return f"{fields} {len(body)}\n".encode() + body + b"\n"

    return head


def write_arc(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    date: str = "20240101000000", roll_bytes: int = ROLL_BYTES,
) -> int:
    """Write one ARC record per page (null body: empty) into ``folder``; returns the number of records.

    Files alternate between header versions 1 and 2.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = None, 0
        for batch in batches:
            for item, url, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                out = out or _roller(folder, ".arc.gz", roll_bytes, _arc_head(date))
                payload = body or b""
                own = "" if item is None else f"{ITEM_HEADER}: {item}\r\n"
                content = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{own}\r\n".encode() + payload
                start = f"{_field(url, 'about:blank')} 0.0.0.0 {date} text/html"

                def record(file_no: int, offset: int, start=start, content=content) -> bytes:
                    more = f" 200 - - {offset} {out.name()}" if _version(file_no) == 2 else ""
                    return f"{start}{more} {len(content)}\n".encode() + content + b"\n"

                out.add(record)
                n += 1
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(body_col).cast("binary")).mapInArrow(run, "n long")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(version, header fields, content) of every record of an uncompressed ARC file, the file description included.

    A record's length is the last field of its header line in either version.
    Raises ValueError where a header line or a declared length does not fit.
    """
    at, version = 0, 1
    while at < len(data):
        if data[at : at + 1] == b"\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"unfinished header line at byte {at}")
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        length = int(values[-1]) if values[-1].isdigit() else -1
        content = data[end + 1 : end + 1 + length] if length >= 0 else b""
        if values[0].startswith("filedesc:") and content[:1].isdigit():
            version = int(content.split(b" ", 1)[0])
        names = ARC_FIELDS.get(version, "").split(" ")
        if length < 0 or len(content) != length or len(values) != len(names):
            raise ValueError(f"header line at byte {at} does not fit version {version}")
        yield version, dict(zip(names, values, strict=True)), content
        at = end + 1 + length


def _split_http(content: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """(header block with its blank line, payload, header fields) of an HTTP message; no header block: all is payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content, {}
    end = content.find(b"\r\n\r\n")
    cut = end + 4 if end >= 0 else len(content)
    lines = content[:cut].decode("latin-1").split("\r\n")[1:]
    return content[:cut], content[cut:], {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if ":" in x)}


def _item(headers: dict[str, str]) -> int | None:
    value = headers.get(ITEM_HEADER.lower(), "")
    return int(value) if re.fullmatch(r"-?\d+", value) else None


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_INDEX = pa.schema([
    ("arc_file", pa.string()), ("record_no", pa.int64()), ("version", pa.int32()), ("url", pa.string()), ("ip", pa.string()),
    ("archive_date", pa.string()), ("mime", pa.string()), ("is_http", pa.bool_()), ("item_id", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
])
_WARC = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("warc_date", pa.string()),
    ("item_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()),
    ("refers_to_id", pa.string()), ("payload", pa.binary()),
])


def _files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    return reader.load(folder).select("path", "content")


def _arc_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for no, (version, head, body) in enumerate(parse_arc(_gunzip(content.as_py()))):
                    if no:
                        http, payload, fields = _split_http(body)
                        yield (
                            path, no, version, head["URL"], head["IP-address"], head["Archive-date"], head["Content-type"],
                            bool(http), _item(fields), len(payload), digest(payload),
                        )

    return _batches(rows(), _INDEX, 4096)


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ARC record, without its content (``RECORD_SCHEMA``)."""
    return _files(spark, folder, ".arc.gz").mapInArrow(_arc_index, RECORD_SCHEMA)


def record_id(url: str, date: str, payload_digest: str, item: int | None, place: str) -> str:
    """An identifier that is the same whenever the same record is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {payload_digest} {item} {place}')}>"


def _warc_date(date: str) -> str:
    d = (date + "00000000000000")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{WARC_VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _place(path: str, no: int) -> str:
    return f"{path.rsplit('/', 1)[-1]}#{no}"


def _warc_head(name: str, file_no: int) -> bytes:
    block = b"software: shopshift\r\nformat: WARC file version 1.0\r\n"
    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
    return _warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", own), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)


def arc_to_warc(spark: SparkSession, arc_folder: str, warc_folder: str, *, min_revisit_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> int:
    """Convert every ARC record of ``arc_folder`` to a WARC record in ``warc_folder``; returns their number.

    Of records with the same payload of at least ``min_revisit_bytes`` bytes,
    the one with the smallest item id (then file and place; null ids last) is
    written in full and the others as revisits of it.  Records without an HTTP
    header become type resource, and never revisits.
    """
    index = stage(read_arc(spark, arc_folder), "arc_index")
    rank = F.struct(F.col("item_id").isNull(), "item_id", "arc_file", "record_no", "url", "archive_date")
    first = (
        index.filter((F.col("payload_bytes") >= min_revisit_bytes) & F.col("is_http"))
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min(rank).alias("f"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", "payload_bytes", "f")
    )
    revisits = (
        index.filter("is_http")
        .select("arc_file", "record_no", "payload_digest", "payload_bytes")
        .join(first, ["payload_digest", "payload_bytes"])
        .filter(~((F.col("f.arc_file") == F.col("arc_file")) & (F.col("f.record_no") == F.col("record_no"))))
        # the records of one file: as many as fit into roll_bytes
        .groupBy(F.col("arc_file").alias("path"))
        .agg(F.collect_list(F.struct("record_no", F.col("f.item_id"), F.col("f.arc_file"), F.col("f.record_no").alias("first_no"), F.col("f.url"), F.col("f.archive_date"))).alias("revisits"))
    )

    revisits = stage(revisits, "revisits")  # with its size known, the archives needn't be shuffled for a few revisits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = None, 0
        for batch in batches:
            for path, content, again in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                earlier = {r["record_no"]: r for r in again or ()}
                out = out or _roller(warc_folder, ".warc.gz", roll_bytes, _warc_head)
                for no, (_, head, body) in enumerate(parse_arc(_gunzip(content.as_py()))):
                    if not no:
                        continue
                    http, payload, fields = _split_http(body)
                    sha, date, item = digest(payload), head["Archive-date"], _item(fields)
                    seen = earlier.get(no)
                    kind = "revisit" if seen else "response" if http else "resource"
                    block = http if seen else body
                    said = [
                        ("WARC-Type", kind), ("WARC-Record-ID", record_id(head["URL"], date, sha, item, _place(path, no))),
                        ("WARC-Date", _warc_date(date)), ("WARC-Target-URI", head["URL"]), ("WARC-IP-Address", head["IP-address"]),
                        ("WARC-Payload-Digest", f"sha1:{sha}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
                        ("Content-Type", "application/http; msgtype=response" if http else head["Content-type"]),
                    ]
                    if seen:
                        target = record_id(seen["url"], seen["archive_date"], sha, seen["item_id"], _place(seen["arc_file"], seen["first_no"]))
                        said += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", target), ("WARC-Refers-To-Target-URI", seen["url"]), ("WARC-Refers-To-Date", _warc_date(seen["archive_date"]))]
                    data = _warc_record(said, block)
                    out.add(lambda *_, data=data: data)
                    n += 1
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    files = _files(spark, arc_folder, ".arc.gz").join(revisits, "path", "left").select("path", "content", "revisits")
    return files.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record of an uncompressed WARC file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(head["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) != length or data[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is shorter than its declared length")
        yield head, block
        at = end + 8 + length


def read_warc(spark: SparkSession, folder: str, *, payloads: bool = False) -> DataFrame:
    """One row per record of the archives but warcinfo (``WARC_SCHEMA``).

    ``payload_bytes`` and ``payload_digest`` describe the full payload, also for
    a revisit (its length stands in the HTTP header that it keeps);
    ``digest_ok`` tells whether a stored payload has the digest its header
    declares.  ``payload`` is null for revisits and unless ``payloads``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for content in batch.column(0):
                    for head, block in parse_warc(_gunzip(content.as_py())):
                        kind = head["warc-type"]
                        if kind == "warcinfo":
                            continue
                        _, payload, fields = _split_http(block)
                        sha = head.get("warc-payload-digest", "").removeprefix("sha1:")
                        whole = kind != "revisit"
                        size = len(payload) if whole else int(fields.get("content-length", 0))
                        yield (
                            head["warc-record-id"], kind, head.get("warc-target-uri"), head.get("warc-date"), _item(fields), size, sha,
                            digest(payload) == sha if whole else None, head.get("warc-refers-to"), payload if whole and payloads else None,
                        )

        return _batches(rows(), _WARC)

    return _files(spark, folder, ".warc.gz").select("content").mapInArrow(run, WARC_SCHEMA)


def pages_through_warc(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as ARC, convert the archives to WARC and read those back.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to
    (the page_id of the response that a revisit points to), one row per page.
    A null html is an empty payload, a null url becomes about:blank; a null
    page_id stays null and comes after all others when the response of equal
    payloads is chosen.  Repeated rows are records of their own.
    """
    spark = pages.sparkSession
    arc, warc = work_dir(spark, "arc"), work_dir(spark, "warc")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    written = write_arc(pages, arc)
    if not written:
        return spark.createDataFrame([], schema)
    converted = arc_to_warc(spark, arc, warc)
    if converted != written:
        raise RuntimeError(f"{written} ARC records, but {converted} WARC records")
    records = read_warc(spark, warc)
    whole = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("item_id").alias("refers_to"))
    named = records.filter("record_type = 'revisit'").join(whole, "refers_to_id", "left")
    columns = [F.col("item_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        records.filter("record_type != 'revisit'")
        .withColumn("refers_to", F.lit(None).cast("long"))
        .select(*columns)
        .unionByName(named.select(*columns))
    )
