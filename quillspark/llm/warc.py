"""WARC archives as a PySpark data source (operator 5).

``format("warc")`` writes one gzip member per record. Each member's header
carries the skip lengths of the WARC standard's annex, so a reader that needs
no more than the record's headers jumps over the rest. Reading plans one task
per group of files; predicates on the record type and on header columns are
pushed into the reader, which parses headers first and decodes the payload of
no record that they reject.

Files are opened through pyarrow, so any file system it knows will do; tasks
write under names of their own and only committed files are kept.

Defined cases: null html is an empty payload; a null url or page id leaves its
header out; rows that repeat an id make a record each; of several rows with
the largest id among equal payloads all are responses; an empty table makes no
archive and reads as no rows. A payload is held in memory one record at a
time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from quillspark.llm.common import shared_dir

SCHEMA = ("record_type string, record_id string, target_uri string, page_id long, refers_to long, "
          "payload_digest string, payload_length long, payload binary")
#: Columns that come from headers.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "page_id": "X-Page-Id",
           "refers_to": "X-Refers-To-Page-Id", "payload_digest": "WARC-Payload-Digest", "payload_length": "X-Payload-Length"}
NUMBERS = ("page_id", "refers_to", "payload_length")
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES, TASK_BYTES, BATCH_BYTES = 64 << 20, 128 << 20, 4 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _clean(value: str) -> str:
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value)


def make_record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One record as a gzip member with skip lengths."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block += b"\r\n" if revisit else b"Content-Length: %d\r\n\r\n%s" % (len(payload), payload)
    lines = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        lines.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        lines.append(("X-Page-Id", str(page_id)))
    if revisit:
        lines += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-Id", str(refers_to))]
    lines += [("WARC-Payload-Digest", "sha1:" + digest_of(payload)), ("X-Payload-Length", str(len(payload))),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)
    extra = b"sl" + struct.pack("<HII", 8, (24 + len(body) + len(tail)) & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


class _Member:
    """The gzip member at a place of a file, decoded as far as asked for."""

    STEP = 1 << 16

    def __init__(self, file, at: int):
        self.file, self.at, self.skip = file, at, None
        file.seek(at)
        head = file.read(12)
        self.ok = len(head) >= 10 and head[:3] == b"\x1f\x8b\x08"
        if not self.ok:
            return
        if head[3] & 4:
            extra = file.read(struct.unpack("<H", head[10:12])[0])
            while len(extra) >= 4:
                n = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and n == 8:
                    self.skip = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + n:]
        file.seek(at)
        self.inflate, self.text, self.read = zlib.decompressobj(31), bytearray(), 0

    def ended(self) -> bool:
        return self.inflate.eof

    def need(self, n: int) -> bytearray:
        while len(self.text) < n and not self.inflate.eof:
            piece = self.inflate.unconsumed_tail or self.file.read(self.STEP)
            if not piece:
                raise EOFError("archive ends within a record")
            self.read += 0 if self.inflate.unconsumed_tail else len(piece)
            self.text += self.inflate.decompress(piece, max(self.STEP, n - len(self.text)))
        return self.text

    def headers(self) -> tuple[dict[str, str], int]:
        n = 1024
        while (end := self.need(n).find(b"\r\n\r\n")) < 0:
            if self.ended():
                raise ValueError(f"record at byte {self.at} has no end of headers")
            n *= 2
        lines = bytes(self.text[:end]).decode("utf-8", "replace").split("\r\n")
        return dict(x.split(": ", 1) for x in lines[1:] if ": " in x), end + 4

    def next_place(self) -> int:
        if self.skip:
            return self.at + self.skip
        while not self.inflate.eof:  # archives of other writers: decode to the member's end
            self.need(len(self.text) + self.STEP)
        return self.at + self.read - len(self.inflate.unused_data)


class _Plain(_Member):
    """The uncompressed record at a place of a file, read as far as asked for."""

    def __init__(self, file, at: int):
        self.file, self.at, self.text, self.over = file, at, bytearray(), False
        self.ok = bytes(self.need(5)[:5]) == b"WARC/"

    def ended(self) -> bool:
        return self.over

    def need(self, n: int) -> bytearray:
        while len(self.text) < n and not self.over:
            self.file.seek(self.at + len(self.text))
            piece = self.file.read(max(self.STEP, n - len(self.text)))
            self.over = not piece
            self.text += piece
        return self.text

    def next_place(self) -> int:
        head, start = self.headers()
        return self.at + start + int(head["Content-Length"]) + 4


def records(file, wanted, payloads: bool):
    """Header dictionaries and payloads (None unless asked for) of the wanted
    records of an open archive, gzip members or plain records. Bytes that are
    neither are an error."""
    at = 0
    while True:
        file.seek(at)
        if not file.read(1):
            return
        m = _Member(file, at)
        if not m.ok:
            m = _Plain(file, at)
        if not m.ok:
            raise ValueError(f"no record at byte {at}")
        head, start = m.headers()
        if wanted(head):
            payload = None
            if payloads and head.get("WARC-Type") == "response":
                block = bytes(m.need(start + int(head["Content-Length"]))[start:start + int(head["Content-Length"])])
                payload = block[block.find(b"\r\n\r\n") + 4:] if block.startswith(b"HTTP/") else block
                want = head.get("WARC-Payload-Digest", "")
                if want.startswith("sha1:") and want[5:] != digest_of(payload):
                    raise ValueError(f"payload of {head.get('WARC-Record-ID')} doesn't match its digest")
            yield head, payload
        at = m.next_place()


def _value(head: dict[str, str], column: str):
    v = head.get(HEADERS[column])
    if v is None:
        return None
    if column == "payload_digest":
        return v.removeprefix("sha1:")
    return int(v) if column in NUMBERS else v


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark gives it, so that executors don't take
    a path of the cluster's file system for one of their own disks."""
    if "://" in path or path.startswith("file:"):
        return path
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = hadoop.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def _file_system(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    return FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payloads, self.tests = options["path"], options.get("payload", "true") == "true", []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.tests.append((column, (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append((column, tuple(f.value)))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((column, None))
            else:
                yield f

    def wanted(self, head: dict[str, str]) -> bool:
        return all((v := _value(head, c)) is not None and (of is None or v in of) for c, of in self.tests)

    def partitions(self):
        from pyarrow.fs import FileSelector

        fs, root = _file_system(self.path)
        found = sorted((f.path, f.size) for f in fs.get_file_info(FileSelector(root, recursive=True)) if f.path.endswith((".warc.gz", ".warc")))
        groups, room = [], 0
        for path, size in found:
            if room < size or not groups:
                groups.append([])
                room = TASK_BYTES
            groups[-1].append(path)
            room -= size
        return [Files(g) for g in groups] or [Files([])]

    def read(self, partition):
        fs, _ = _file_system(self.path)
        rows, held = [], 0
        for path in partition.value:
            with fs.open_input_file(path) as file:
                for head, payload in records(file, self.wanted, self.payloads):
                    rows.append((*[_value(head, c) for c in HEADERS], payload))
                    held += len(payload or b"") + 200
                    if held > BATCH_BYTES:
                        yield self.batch(rows)
                        rows, held = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows):
        kinds = [pa.int64() if c in NUMBERS else pa.string() for c in HEADERS] + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*HEADERS, "payload"])


class Written(WriterCommitMessage):
    def __init__(self, paths):
        self.paths = paths


class WarcWriter(DataSourceArrowWriter):
    """Rows (page_id, url, html, refers_to) as records."""

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        task, paths, out, room = uuid.uuid4().hex, [], None, 0
        try:
            for b in iterator:
                cols = {n.lower(): b.column(k) for k, n in enumerate(b.schema.names)}
                for k in range(b.num_rows):
                    html = cols["html"][k].as_py()
                    r = make_record(cols["page_id"][k].as_py(), cols["url"][k].as_py(), (html or "").encode(), cols["refers_to"][k].as_py())
                    if out is None or room < len(r):
                        if out:
                            out.close()
                        paths.append(f"{root}/{task}-{len(paths):05d}.warc.gz.open")
                        out, room = fs.open_output_stream(paths[-1], compression=None), FILE_BYTES
                    out.write(r)
                    room -= len(r)
        finally:
            if out:
                out.close()
        return Written(paths)

    def commit(self, messages):
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        for m in messages:
            for p in m.paths if m else ():
                fs.move(p, p.removesuffix(".open"))

    def abort(self, messages):
        fs, _ = _file_system(self.path)
        for m in messages:
            for p in m.paths if m else ():
                fs.delete_file(p)


class Warc(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of all archives below ``path``; ``payload=False`` decodes none."""
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(qualified(spark, path))


def write_warc(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> None:
    """A record per row; rows whose payload equals that of a row with a larger
    id become revisits of it, from ``least_bytes`` bytes on."""
    spark = pages.sparkSession
    spark.dataSource.register(Warc)
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"),
                     F.sha1(body).alias("key"), F.octet_length(body).alias("bytes"))
    # the html isn't part of this branch; only keys that come up twice go on
    last = (p.where(F.col("bytes") >= least_bytes).groupBy("key").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
            .where("n > 1").select("key", "last"))
    rows = p.join(last, "key", "left").select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))
    rows.write.format("warc").mode("append").save(qualified(spark, path))


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back:
    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path, **columns)
    full = read_warc(spark, path).where("record_type = 'response'").withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    again = read_warc(spark, path, payload=False).where("record_type = 'revisit'").withColumn("payload_bytes", F.col("payload_length"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return full.select(cols).union(again.select(cols))
