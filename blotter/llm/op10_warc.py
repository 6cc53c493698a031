"""WARC archives as a PySpark Python data source (format name ``warc``).

Reading: partitions are planned from the archive list by size (files are bounded
when written). Predicates on record type and header columns are pushed down: a
record's headers are parsed first, from the first compressed bytes alone, and
where they fail -- or where no column needs the payload -- the rest of the record
is neither inflated nor read: each gzip member carries its length in the ``sl``
extra field of its header, so the reader seeks to the next one. Archives without
that field, and plain ``.warc`` files, are read as well.

Writing: a task writes files under names of its own; the names become visible in
a manifest when the job commits, so lost or repeated tasks leave no records
behind. Payloads equal in length and SHA-1 are written once, as ``response``; the
others are ``revisit`` records that refer to it.

Defined cases: null html is an empty payload; a null page_id is written and read
as null (it counts as least); a null url is left out; urls with control
characters or outer blanks are kept in an escaped header of their own; among
rows with the same page_id and payload the greatest url is the response, and of
rows equal in all three one; an empty table gives an empty archive; further
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from . import common as C

SCHEMA = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
          "payload binary")
MANIFEST = "_manifest.json"
FILE_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20
HEAD_BYTES = 1024
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# --- records ---------------------------------------------------------------

def page_urn(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def record_bytes(row: dict, date: str) -> bytes:
    """One WARC/1.1 record for a row with page_id, url, record_type, refers_to, payload_digest and payload."""
    payload, response = row["payload"], row["record_type"] == "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if response else http
    rid = page_urn(row["page_id"]) if row["page_id"] is not None else f"<urn:uuid:{uuid.uuid4()}>"
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {rid}", f"WARC-Date: {date}"]
    url = row["url"]
    if url is not None:
        plain = url == url.strip() and url.isprintable()
        lines.append(f"WARC-Target-URI: {url}" if plain else f"X-Target-Text: {json.dumps(url)}")
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    lines += [f"WARC-Payload-Digest: sha1:{row['payload_digest']}", f"X-Payload-Length: {len(payload)}"]
    if not response:
        lines.append(f"WARC-Profile: {REVISIT}")
        if row["refers_to"] is not None:
            lines.append(f"WARC-Refers-To: {page_urn(row['refers_to'])}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int) -> bytes:
    """A gzip member whose header tells its own length (extra field ``sl``)."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(raw) + z.flush()
    size = 12 + 20 + len(body) + 8
    extra = b"sl" + struct.pack("<HQQ", 16, size, len(raw))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(src, size: int, zipped: bool, wanted: Callable[[dict], bool]) -> Iterator[tuple[dict, bytes | None]]:
    """(headers, block) of every record; block is None, and not read, where ``wanted(headers)`` is false."""
    at = 0
    while at < size:
        if not zipped:
            head = b""
            while (end := head.find(b"\r\n\r\n")) < 0:
                more = src.read_at(min(HEAD_BYTES, size - at - len(head)), at + len(head))
                if not more:
                    raise ValueError("archive ends inside a record's headers")
                head += more
            h = parse_headers(head[:end])
            n = int(h["content-length"])
            yield h, (src.read_at(n, at + end + 4) if wanted(h) else None)
            at += end + 4 + n + 4
            continue
        first = src.read_at(min(HEAD_BYTES, size - at), at)
        known = struct.unpack_from("<Q", first, 16)[0] if len(first) >= 32 and first[3] & 4 and first[12:14] == b"sl" else None
        z, out, read = zlib.decompressobj(31), b"", len(first)
        out = z.decompress(first)
        while (end := out.find(b"\r\n\r\n")) < 0 and not z.eof:
            more = src.read_at(min(HEAD_BYTES, size - at - read), at + read)
            if not more:
                raise ValueError("archive ends inside a record's headers")
            read += len(more)
            out += z.decompress(more)
        h = parse_headers(out[:end])
        n, take = int(h["content-length"]), wanted(h)
        parts = [out]
        if take or known is None:
            stop = size if known is None else min(size, at + known)
            while not z.eof and at + read < stop:
                more = src.read_at(min(1 << 16, stop - at - read), at + read)
                read += len(more)
                piece = z.decompress(more)
                if take:
                    parts.append(piece)
        yield h, (b"".join(parts)[end + 4:end + 4 + n] if take else None)
        at += known if known is not None else read - len(z.unused_data)


# --- data source -----------------------------------------------------------

class Files(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").save(folder)``.

    Options: ``verify`` (default true: digests and lengths of responses are
    computed from their payloads; false: taken from the headers, payloads are
    then skipped unless asked for), ``date``, ``level`` (of compression).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options, schema.fieldNames())

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


TESTS: dict[type, Callable] = {
    EqualTo: lambda x, v: x is not None and x == v, EqualNullSafe: lambda x, v: x == v, In: lambda x, v: x is not None and x in v,
    GreaterThan: lambda x, v: x is not None and x > v, GreaterThanOrEqual: lambda x, v: x is not None and x >= v,
    LessThan: lambda x, v: x is not None and x < v, LessThanOrEqual: lambda x, v: x is not None and x <= v,
    StringStartsWith: lambda x, v: x is not None and x.startswith(v), StringEndsWith: lambda x, v: x is not None and x.endswith(v),
    StringContains: lambda x, v: x is not None and v in x,
    IsNull: lambda x, v: x is None, IsNotNull: lambda x, v: x is not None,
}


class WarcReader(DataSourceReader):
    HEADER_COLUMNS = ("page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to")

    def __init__(self, options, columns: list[str]):
        self.folder, self.columns = options["path"], columns
        self.verify = str(options.get("verify", "true")).lower() == "true"
        self.tests: list[tuple[Callable, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            test, path = TESTS.get(type(f)), getattr(f, "attribute", ())
            if test is not None and len(path) == 1 and path[0] in self.HEADER_COLUMNS:
                self.tests.append((type(f), path[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs as pafs
        fs, root = C.open_fs(self.folder)
        info = fs.get_file_info([f"{root}/{MANIFEST}"])[0]
        if info.type == pafs.FileType.File:
            with fs.open_input_stream(info.path) as src:
                files = [tuple(x) for x in json.loads(src.read())]
        else:
            found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
            files = sorted((x.path[len(root) + 1:], x.size) for x in found if x.path.endswith((".warc", ".warc.gz")))
        out, names, total = [], [], 0
        for name, size in files:
            if names and total + size > PARTITION_BYTES:
                out.append(Files(names))
                names, total = [], 0
            names.append(name)
            total += size
        return [*out, Files(names)]

    @staticmethod
    def header_row(h: dict[str, str]) -> dict:
        refers = h.get("warc-refers-to", "")
        return {
            "page_id": int(h["x-page-id"]) if "x-page-id" in h else None,
            "url": json.loads(h["x-target-text"]) if "x-target-text" in h else h.get("warc-target-uri"),
            "record_type": h.get("warc-type"),
            "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "payload_bytes": int(h["x-payload-length"]) if "x-payload-length" in h else None,
            "refers_to": int(refers[len("<urn:page:"):-1]) if refers.startswith("<urn:page:") else None,
        }

    def read(self, partition: Files):
        fs, root = C.open_fs(self.folder)
        schema = {f.name: f.type for f in pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                                                     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                                                     ("refers_to", pa.int64()), ("payload", pa.binary())])}
        checked = self.verify and {"payload_digest", "payload_bytes"} & set(self.columns)
        use_payload = "payload" in self.columns or checked
        tests = [(TESTS[kind], c, v) for kind, c, v in self.tests]

        def passes(h: dict) -> bool:
            row = self.header_row(h)
            return all(test(row[c], v) for test, c, v in tests)

        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], schema[c]) for c in self.columns], names=self.columns)

        for name in partition.names:
            with fs.open_input_file(f"{root}/{name}") as src:
                want = lambda h: use_payload and h.get("warc-type") == "response" and passes(h)
                for h, block in records(src, src.size(), name.endswith(".gz"), want):
                    if block is None and not passes(h):
                        continue
                    row = self.header_row(h) | {"payload": None}
                    if block is not None:
                        row["payload"] = block[block.find(b"\r\n\r\n") + 4:]
                        if checked:
                            digest = base64.b32encode(hashlib.sha1(row["payload"]).digest()).decode()
                            if (digest, len(row["payload"])) != (row["payload_digest"] or digest, row["payload_bytes"] or len(row["payload"])):
                                raise ValueError(f"record {row['page_id']}: payload and headers disagree")
                            row["payload_digest"], row["payload_bytes"] = digest, len(row["payload"])
                    rows.append(row)
                    held += len(row["payload"] or b"") + 100
                    if held > 8 << 20:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


class WarcWriter(DataSourceArrowWriter):
    """Rows with page_id, url, record_type, refers_to, payload_digest (hex or base32) and payload."""

    def __init__(self, options):
        self.folder = options["path"]
        self.date, self.level = options.get("date", "2000-01-01T00:00:00Z"), int(options.get("level", 4))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = C.open_fs(self.folder)
        fs.create_dir(root, recursive=True)
        stem = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        files, out, size = [], None, 0
        for b in iterator:
            for row in b.to_pylist():
                if out is None:
                    name, size = f"{stem}-{len(files):04d}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                payload = row["payload"] or b""
                row["payload"] = payload.encode() if isinstance(payload, str) else payload
                if len(row["payload_digest"]) == 40:
                    row["payload_digest"] = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
                member = gzip_member(record_bytes(row, self.date), self.level)
                out.write(member)
                size += len(member)
                if size >= FILE_BYTES:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(files)

    def commit(self, messages) -> None:
        fs, root = C.open_fs(self.folder)
        fs.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        fs, root = C.open_fs(self.folder)
        for m in messages:
            for name, _ in m.files if m is not None else ():
                fs.delete_file(f"{root}/{name}")


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages to archive and back ----------------------------------------------

def with_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows to write: of equal payloads of at least ``min_bytes`` the one with the largest page_id is the response."""
    payload = C.text_or_empty("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1(F.col("payload").cast("binary"))).withColumn("size", F.octet_length("payload"))
    rank = F.struct(F.col("page_id"), F.xxhash64("url").alias("url_hash"))  # of fixed width, as it may be broadcast
    same = (rows.where(F.col("size") >= min_bytes).select("payload_digest", "size", rank.alias("rank"))
            .groupBy("payload_digest", "size").agg(F.count("*").alias("n"), F.max("rank").alias("first")).where("n > 1"))
    same = C.materialize(same.select(F.col("payload_digest").alias("digest"), F.col("size").alias("length"), "first"), "copies")
    joined = rows.join(C.small_side(same), (F.col("payload_digest") == F.col("digest")) & (F.col("size") == F.col("length")), "left")
    lead = F.col("first").isNull() | rank.eqNullSafe(F.col("first"))
    # rows equal in page_id, url and payload: only one of them leads
    ties = C.materialize(joined.where(F.col("first").isNotNull() & lead).select("digest", "length", F.monotonically_increasing_id().alias("row")), "leads")
    if not ties.groupBy("digest", "length").count().where("count > 1").isEmpty():
        joined = C.materialize(joined.withColumn("row", F.monotonically_increasing_id()), "ranked")
        one = joined.where(F.col("first").isNotNull() & lead).groupBy(F.col("digest").alias("d"), F.col("length").alias("l")).agg(F.min("row").alias("lead_row"))
        joined = joined.join(one, (F.col("digest") == F.col("d")) & (F.col("length") == F.col("l")), "left").drop("d", "l")
        lead = F.col("first").isNull() | (F.col("row") == F.col("lead_row"))
    return joined.select("page_id", "url", F.when(lead, "response").otherwise("revisit").alias("record_type"),
                         F.when(~lead, F.col("first.page_id")).alias("refers_to"), "payload_digest", "payload")


def write_and_read(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive all pages and read page_id, payload_bytes, payload_digest, record_type, refers_to back."""
    spark = pages.sparkSession
    C.bound_batches(spark)
    register(spark)
    folder = C.work_dir(spark, "warc")
    with_records(pages, min_bytes).write.format("warc").mode("append").save(folder)
    return (spark.read.format("warc")
            .schema("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long").load(folder))
