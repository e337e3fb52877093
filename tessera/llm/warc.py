"""WARC archives as a Spark data source, and web pages written to and read from them.

Format ``warc`` reads and writes ``.warc`` and ``.warc.gz`` files under one folder
of any store that ``pyarrow.fs`` knows.

Reading: the driver plans partitions of about ``partition_bytes`` from file sizes; a file
written here carries offsets of record starts in its commit file, at which it is split.
Predicates on record type and all other columns but the payload are pushed
down: a record's headers are parsed first, and the block of a record that
they refuse is not decoded: a plain file is read on behind it, a gzip member is left
behind by the length in its ``sl`` extra field, where there is one, and inflated unread
where not.  The same holds for all records if the schema asked for has no payload.
Files that break the format raise an error that names file and offset.

Writing: each task writes files of its own, each record a gzip member, a new file every
``file_bytes``.  The driver then writes one commit file that lists them; readers of a
folder with commit files take listed files alone, so what lost or repeated tasks
left is never read.

``archive_pages`` writes pages with revisit records: of the rows with equal payloads of at least
``min_bytes`` bytes the one with the largest id (ties: url) is a response, the
others are revisits without payload.  Payloads are hashed where they are scanned and
stay there; only the table of payloads held twice or more is joined to them, and
revisits are made from counts.

Defined cases: a null html is an empty payload; null ids come first and come back as null;
of rows equal in id, url and payload one is the response; other columns are not read;
no rows give an archive without records, and it reads as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import broadcast_if_small, materialise

FILE_BYTES, SPLIT_BYTES, PARTITION_BYTES = 256 << 20, 16 << 20, 32 << 20
BATCH_BYTES = 16 << 20
COMMIT = "_warc_commit"
CHUNK = 1 << 16
SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, content_type string, payload_digest string, "
          "content_length long, payload_length long, headers map<string,string>, payload binary")
# The named fields behind the columns.
FIELDS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
          "refers_to": "warc-refers-to", "content_type": "content-type", "payload_digest": "warc-payload-digest"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named as Spark names it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- records -----------------------------------------------------------------

def member(record: bytes) -> bytes:
    """``record`` as one gzip member whose ``sl`` extra field holds its compressed and full length."""
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    size = 12 + 12 + len(body) + 8
    # lengths of 4 GB and more do not fit; such a record goes without the field
    extra = b"sl" + struct.pack("<HII", 8, size, len(record)) if max(size, len(record)) < 1 << 32 else b""
    head = struct.pack("<4BIBBH", 0x1F, 0x8B, 8, 4, 0, 0, 255, len(extra))
    return head + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def member_length(head: bytes) -> int | None:
    """Compressed length of the gzip member that begins with ``head``, if it says so."""
    if len(head) < 24 or not head[3] & 4:
        return None
    at, end = 12, min(12 + struct.unpack_from("<H", head, 10)[0], len(head))
    while at + 4 <= end:
        n = struct.unpack_from("<H", head, at + 2)[0]
        if head[at: at + 2] == b"sl" and n == 8 and at + 12 <= end:
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + n
    return None


class Inflated(io.RawIOBase):
    """The inflated bytes of the gzip members of a file from ``offset`` on, as a stream."""

    def __init__(self, file, offset: int):
        self.file, self.z = file, None
        file.seek(offset)

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while True:
            if self.z is None or self.z.eof:
                more = (self.z.unused_data if self.z is not None else b"") or self.file.read(CHUNK)
                if not more:
                    return 0
                self.z = zlib.decompressobj(31)
            else:
                more = self.z.unconsumed_tail or self.file.read(CHUNK)
            data = self.z.decompress(more, len(out))
            if not (data or more or self.z.eof):
                raise EOFError("a gzip member ends early")
            if data:
                out[: len(data)] = data
                return len(data)


def parse_fields(lines: list[bytes]) -> dict[str, str]:
    """Named fields by lower-case name; folded lines belong to the one before, of equal names the first counts."""
    unfolded: list[bytes] = []
    for x in lines:
        if x[:1] in (b" ", b"\t") and unfolded:
            unfolded[-1] += b" " + x.strip()
        else:
            unfolded.append(x)
    out: dict[str, str] = {}
    for x in unfolded:
        name, colon, value = x.partition(b":")
        if colon:
            out.setdefault(name.strip().decode("utf-8", "replace").lower(), value.strip().decode("utf-8", "replace"))
    return out


def read_head(stream, where: str) -> dict[str, str] | None:
    """The headers of the next record of ``stream``; None at its end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"{where}: no WARC record here, but {line[:40]!r}")
    lines = []
    while True:
        x = stream.readline()
        if not x:
            raise EOFError(f"{where}: the headers of a record end early")
        x = x.rstrip(b"\r\n")
        if not x:
            break
        lines.append(x)
    head = parse_fields(lines)
    if not head.get("content-length", "").isdigit():
        raise ValueError(f"{where}: a record without Content-Length")
    return head


class Record:
    """One record: headers, and its block, read only when asked for."""

    def __init__(self, head: dict[str, str], stream, where: str):
        self.head, self.stream, self.where = head, stream, where
        self.content_length = self.left = int(head["content-length"])
        self._http: dict[str, str] | None = None

    def _read(self, n: int) -> bytes:
        data = self.stream.read(n)
        if len(data) < n:
            raise EOFError(f"{self.where}: the block of a record ends early")
        self.left -= n
        return data

    def http(self) -> dict[str, str]:
        """The HTTP headers that the block begins with; none where it isn't HTTP."""
        if self._http is None:
            lines = []
            while self.left and self.head.get("content-type", "").lower().startswith("application/http"):
                x = self.stream.readline(self.left)
                if not x:
                    raise EOFError(f"{self.where}: the block of a record ends early")
                self.left -= len(x)
                x = x.rstrip(b"\r\n")
                if not x:
                    break
                lines.append(x)
            self._http = parse_fields(lines[1:])
        return self._http

    def payload_length(self) -> int:
        """Bytes of the full payload: of a revisit, as its HTTP headers say."""
        told = self.http().get("content-length", "")
        return int(told) if self.head.get("warc-type") == "revisit" and told.isdigit() else self.left

    def payload(self) -> bytes:
        self.http()
        return self._read(self.left)

    def skip(self) -> None:
        while self.left:
            self._read(min(self.left, CHUNK))


def records(file, lo: int, hi: int, zipped: bool, where: str, wanted) -> Iterator[Record]:
    """Records that begin in bytes lo..hi of ``file`` and whose headers ``wanted`` accepts."""
    if not zipped:
        file.seek(lo)
        while True:
            at = file.tell()
            if at >= hi or (head := read_head(file, f"{where}:{at}")) is None:
                return
            r, after = Record(head, file, f"{where}:{at}"), file.tell() + int(head["content-length"])
            if wanted(head):
                yield r
            file.seek(after)
    at = lo
    while at < hi:
        file.seek(at)
        length = member_length(file.read(64))
        if length is None:
            yield from _members(file, at, hi, where, wanted)
            return
        stream = io.BufferedReader(Inflated(file, at), CHUNK)
        head = read_head(stream, f"{where}:{at}")
        if head is not None and wanted(head):
            yield Record(head, stream, f"{where}:{at}")
        at += length


def _members(file, lo: int, hi: int, where: str, wanted) -> Iterator[Record]:
    """Records of gzip members that don't tell their length, read through; these files are read as a whole."""
    stream = io.BufferedReader(Inflated(file, lo), CHUNK)
    while True:
        at = f"{where}:{lo}+"
        head = read_head(stream, at)
        if head is None:
            return
        r = Record(head, stream, at)
        if wanted(head):
            yield r
        r.skip()


# --- predicates on headers ---------------------------------------------------

PUSHED = {
    ds.EqualTo: lambda a, b: a == b, ds.EqualNullSafe: lambda a, b: a == b, ds.In: lambda a, b: a in b,
    ds.GreaterThan: lambda a, b: a > b, ds.GreaterThanOrEqual: lambda a, b: a >= b,
    ds.LessThan: lambda a, b: a < b, ds.LessThanOrEqual: lambda a, b: a <= b,
    ds.StringStartsWith: lambda a, b: a.startswith(b), ds.StringEndsWith: lambda a, b: a.endswith(b), ds.StringContains: lambda a, b: b in a,
}
HEAD_COLUMNS = (*FIELDS, "content_length")


def takes(f: ds.Filter) -> bool:
    """Whether headers alone decide the filter."""
    if isinstance(f, ds.Not):
        return takes(f.child)
    if not isinstance(f, (*PUSHED, ds.IsNull, ds.IsNotNull)) or len(f.attribute) != 1 or f.attribute[0] not in HEAD_COLUMNS:
        return False
    return isinstance(f, ds.EqualNullSafe) or getattr(f, "value", "") is not None


def holds(f: ds.Filter, head: dict[str, str]) -> bool | None:
    """SQL truth of the filter on a record's headers."""
    if isinstance(f, ds.Not):
        inner = holds(f.child, head)
        return None if inner is None else not inner
    value = head_value(head, f.attribute[0])
    if isinstance(f, ds.IsNull):
        return value is None
    if isinstance(f, ds.IsNotNull):
        return value is not None
    if isinstance(f, ds.EqualNullSafe):
        return value == f.value
    return None if value is None else PUSHED[type(f)](value, f.value)


def head_value(head: dict[str, str], column: str):
    if column == "content_length":
        return int(head["content-length"])
    value = head.get(FIELDS[column])
    return value.removeprefix("sha1:") if column == "payload_digest" and value else value


# --- the data source ---------------------------------------------------------

@dataclass
class Part(ds.InputPartition):
    ranges: list[tuple[str, int, int]]   # file, first byte, end


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[dict]


class WarcDataSource(ds.DataSource):
    """Options: ``path``; reading: ``partition_bytes``, ``verify`` (check the SHA-1 of
    each payload read); writing: ``file_bytes``, ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> ds.DataSourceWriter:
        return WarcWriter(dict(self.options), schema, overwrite)


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        known = {x.split()[0] for x in SCHEMA.split(", ")}
        if unknown := [c for c in schema.names if c not in known]:
            raise ValueError(f"no such column of a WARC record: {unknown}")
        self.path = options["path"]
        self.size = int(options.get("partition_bytes", PARTITION_BYTES))
        self.verify = options.get("verify", "false").lower() == "true"
        self.names = schema.names
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if takes(f):
                self.filters.append(f)
            else:
                yield f

    def files(self) -> list[dict]:
        fs, base = store(self.path)
        found = sorted(fs.get_file_info(pafs.FileSelector(base)), key=lambda x: x.path)
        commits = [x.path for x in found if x.base_name.startswith(COMMIT)]
        if not commits:
            return [{"name": x.base_name, "bytes": x.size, "cuts": []} for x in found if x.base_name.endswith((".warc", ".warc.gz"))]
        out = []
        for c in commits:
            with fs.open_input_stream(c) as f:
                out += json.loads(f.read())
        return out

    def partitions(self):
        """Files in name order, cut where records begin, gathered to about ``partition_bytes`` each."""
        out, ranges, held = [], [], 0
        for f in self.files():
            at = 0
            for cut in [c for c in f["cuts"] if 0 < c < f["bytes"]] + [f["bytes"]]:
                if ranges and held + cut - at > self.size:
                    out.append(Part(ranges))
                    ranges, held = [], 0
                ranges.append((f["name"], at, cut))
                held, at = held + cut - at, cut
        return [*out, Part(ranges)]

    def _wanted(self, head: dict[str, str]) -> bool:
        return all(holds(f, head) for f in self.filters)

    def _row(self, r: Record) -> list:
        out = []
        for c in self.names:
            if c == "headers":
                out.append(list(r.head.items()))
            elif c == "payload_length":
                out.append(r.payload_length())
            elif c != "payload":
                out.append(head_value(r.head, c))
            else:
                out.append(None)
        if "payload" in self.names and r.head.get("warc-type") != "revisit":
            data = r.payload()
            told = head_value(r.head, "payload_digest")
            if self.verify and told and told != base32_sha1(data):
                raise ValueError(f"{r.where}: payload and digest differ")
            out[self.names.index("payload")] = data
        return out

    def read(self, partition: Part):
        types = {"content_length": pa.int64(), "payload_length": pa.int64(), "headers": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}
        spec = pa.schema([(c, types.get(c, pa.string())) for c in self.names])
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), spec.types, strict=True)], schema=spec)

        fs, base = store(self.path)
        for name, lo, hi in partition.ranges:
            with fs.open_input_file(f"{base}/{name}") as raw:
                file = raw if name.endswith(".gz") else io.BufferedReader(raw, CHUNK)
                for r in records(file, lo, hi, name.endswith(".gz"), f"{self.path}/{name}", self._wanted):
                    rows.append(self._row(r))
                    size += 200 + len(rows[-1][self.names.index("payload")] or b"" if "payload" in self.names else b"")
                    if size >= BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        if missing := {"record_id", "record_type", "payload"} - set(schema.names):
            raise ValueError(f"records to write need the columns {sorted(missing)}")
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))

    def write(self, iterator):
        """Files of this task; their names are new at each attempt."""
        fs, base = store(self.path)
        fs.create_dir(base, recursive=True)
        files, out, now = [], None, datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        try:
            for b in iterator:
                for k in range(b.num_rows):
                    if out is None:
                        files.append({"name": f"part-{uuid.uuid4().hex}.warc.gz", "bytes": 0, "cuts": []})
                        out = fs.open_output_stream(f"{base}/{files[-1]['name']}", compression=None)
                    f = files[-1]
                    if f["bytes"] - (f["cuts"][-1] if f["cuts"] else 0) >= self.split_bytes:
                        f["cuts"].append(f["bytes"])
                    data = member(serialise({c: b.column(c)[k].as_py() for c in b.schema.names}, now))
                    out.write(data)
                    f["bytes"] += len(data)
                    if f["bytes"] >= self.file_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages) -> None:
        fs, base = store(self.path)
        fs.create_dir(base, recursive=True)
        old = [x.path for x in fs.get_file_info(pafs.FileSelector(base)) if x.base_name.startswith(COMMIT)] if self.overwrite else []
        files = sorted((f for m in messages if m is not None for f in m.files), key=lambda f: f["name"])
        with fs.open_output_stream(f"{base}/{COMMIT}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())
        for p in old:
            fs.delete_file(p)

    def abort(self, messages) -> None:
        fs, base = store(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                fs.delete_file(f"{base}/{f['name']}")


def serialise(row: dict, now: str) -> bytes:
    """A row as a record: an HTTP response with its payload, of a revisit only the HTTP headers."""
    payload = row["payload"] or b""
    size = row.get("payload_length")
    size = len(payload) if size is None else size
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    digest = row.get("payload_digest") or base32_sha1(payload)
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row.get("date") or now),
              ("WARC-Target-URI", row.get("target_uri")), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", row.get("refers_to")),
              ("WARC-Profile", PROFILE if revisit else None), ("Content-Type", HTTP), ("Content-Length", str(len(block)))]
    head = "".join(f"{n}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for n, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, **options) -> DataFrame:
    """The records under ``path``; with ``columns``, those alone are parsed for."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    r = spark.read.format("warc").options(**{k: str(v) for k, v in options.items()})
    if columns is not None:
        r = r.schema(", ".join(x for x in SCHEMA.split(", ") if x.split()[0] in columns))
    return r.load(path)


def write_warc(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    df.sparkSession.dataSource.register(WarcDataSource)
    df.write.format("warc").mode(mode).options(**{k: str(v) for k, v in options.items()}).save(path)


# --- pages -------------------------------------------------------------------

COPIES = 10_000     # revisits of one row made by one task


def _b32(hex_digest):
    """Bare base 32 of a hex SHA-1: 40 hex digits are 32 digits of 5 bits."""
    bits = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.lpad(F.conv(F.substring(hex_digest, 10 * i + 1, 10), 16, 32), 8, "0")), "")
    return F.translate(bits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(id_, digest, copy):
    """A name for the record that holds the page's id; null ids have none in it."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(id_.cast("string")), F.lit("")), F.lit(":"), digest, F.lit(":"), copy.cast("string"), F.lit(">"))


def page_id(record_id, to: str = "long"):
    """The page's id in a record's name."""
    got = F.regexp_extract(record_id, "^<urn:page:(.*):[A-Z2-7]{32}:[0-9]+>$", 1)
    return F.url_decode(F.nullif(got, F.lit(""))).cast(to)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """(responses, revisits) of the rows of ``pages``, as rows for ``write_warc``."""
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    p = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), html.alias("payload"))
    p = p.select("*", F.sha1("payload").alias("hex"), F.octet_length("payload").cast("long").alias("payload_length"))
    rows = materialise(p.groupBy("hex", "id", "url").agg(F.count("*").alias("n"), F.first("payload_length").alias("payload_length")), "pages")
    held = (rows.where(F.col("payload_length") >= min_bytes).groupBy("hex")
            .agg(F.sum("n").alias("held"), F.max(F.struct("id", "url")).alias("k"), F.max_by("n", F.struct("id", "url")).alias("same")).where("held > 1"))
    held = broadcast_if_small(materialise(held.select(F.col("hex").alias("h"), "k", "same"), "held"))
    digest = _b32(F.col("hex"))

    def written(d: DataFrame, kind: str, refers_to, payload) -> DataFrame:
        return d.select(_record_id(F.col("id"), digest, F.col("copy")).alias("record_id"), F.lit(kind).alias("record_type"), F.col("url").alias("target_uri"),
                        refers_to.alias("refers_to"), digest.alias("payload_digest"), "payload_length", payload.alias("payload"))

    is_kept = F.col("id").eqNullSafe(F.col("k.id")) & F.col("url").eqNullSafe(F.col("k.url"))
    d = p.join(held, F.col("hex") == F.col("h"), "left").where(F.col("h").isNull() | is_kept)
    # rows equal in all three: one of them, taken before the shuffle as well
    tied = d.where("same > 1").groupBy("hex").agg(*[F.first(c).alias(c) for c in ("id", "url", "payload", "payload_length")])
    names = ["id", "url", "payload", "hex", "payload_length"]
    first = d.where("same IS NULL OR same = 1").select(*names).unionByName(tied.select(*names)).withColumn("copy", F.lit(0))
    again = (rows.join(held, F.col("hex") == F.col("h")).withColumn("n", F.col("n") - is_kept.cast("long")).where("n > 0")
             .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})"))).repartition("hex", "id", "chunk")
             .withColumn("copy", F.explode(F.expr(f"sequence(chunk * {COPIES} + 1, least(chunk * {COPIES} + {COPIES}, n))"))))
    return (written(first, "response", F.lit(None).cast("string"), F.col("payload")),
            written(again, "revisit", _record_id(F.col("k.id"), digest, F.lit(0)), F.lit(None).cast("binary")))


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, min_bytes: int = 0, **options) -> None:
    """Write one record per row of ``pages`` under ``path``."""
    responses, revisits = page_records(pages, id_col, url_col, html_col, min_bytes=min_bytes)
    write_warc(responses, path, **options)
    write_warc(revisits, path, **options)


def page_digest(spark: SparkSession, path: str, id_type: str = "long", id_col: str = "page_id") -> DataFrame:
    """One row per record of an archive of pages, read from the archive: payloads of
    responses are decoded and checked, those of revisits are not there."""
    columns = ["record_id", "record_type", "refers_to", "payload_digest", "payload_length"]
    responses = read_warc(spark, path, [*columns, "payload"], verify=True).where("record_type = 'response'")
    revisits = read_warc(spark, path, columns).where("record_type = 'revisit'")
    size = {"response": F.octet_length("payload").cast("long"), "revisit": F.col("payload_length")}
    out = [d.select(page_id(F.col("record_id"), id_type).alias(id_col), size[kind].alias("payload_bytes"), "payload_digest", "record_type",
                    page_id(F.col("refers_to"), id_type).alias("refers_to"))
           for kind, d in (("response", responses), ("revisit", revisits))]
    return out[0].unionByName(out[1])


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), k AS (
  SELECT hex, max(page_id) AS keep FROM p GROUP BY hex
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       list_reduce(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(hex, CAST(i // 8 * 10 + 1 AS INTEGER), 10))::BIGINT >> CAST(35 - i % 8 * 5 AS INTEGER)) & 31)::INTEGER, 1)),
           lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM p JOIN k USING (hex)
"""
