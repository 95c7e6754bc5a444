"""WARC archives as a Spark data source: a writer with revisit records, and a reader that salvages damaged archives.

``spark.write.format("warc")`` writes archives of one gzip member a record, one set of files a task, listed in a manifest when
all tasks have ended, so files of lost or repeated attempts are never read. ``spark.read.format("warc")`` gives a task to each
archive. What fails a check (compression, version line, header, length, end of record, block digest) is left, the next member
or version line that starts a valid record is searched for, and the bytes between are a row of their own: kind ``gap``.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import blank, cut, shared_folder

#: Marks of a gzip member and of a record, and what ends headers and records.
GZIP, VERSION, END = b"\x1f\x8b\x08", b"WARC/", b"\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
STEP = 1 << 20
#: A header that has not ended by then is none.
HEADER = 16 << 20
MANIFEST = "_archives.json"
FOUND = "file string, kind string, start long, end long, reason string, headers map<string,string>, payload binary"
FOUND_SCHEMA = pa.schema([("file", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    """A record's bytes; control characters in values are percent-encoded."""
    held = {**headers, "WARC-Block-Digest": f"sha1:{sha1(block)}", "Content-Length": str(len(block))}
    lines = [f"{k}: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}' if m[0] != ' ' else ' ', v)}" for k, v in held.items() if v is not None]
    return b"".join([VERSION, b"1.1\r\n", "\r\n".join(lines).encode(), END, block, END])


class Broken(Exception):
    """What stands at a place is no valid record; the argument says why."""


class Bytes:
    """Random access to a file or to bytes, a step at a time."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def read(self, start: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``start``."""
        if not (self.at <= start and start + n <= self.at + len(self.held)):
            self.file.seek(start)
            self.at, self.held = start, self.file.read(max(n, STEP))
        return self.held[start - self.at : start - self.at + n]

    def next_start(self, start: int) -> int:
        """Place of the next member or version line from ``start`` on; the size if there is none."""
        while start < self.size:
            if found := START.search(self.read(start, STEP)):
                return start + found.start()
            start += max(1, STEP - 16)
        return self.size


@dataclass
class Record:
    start: int
    end: int | None
    headers: dict[str, str]
    payload: bytes


def plain_record(data: Bytes, start: int) -> Record:
    """The record whose version line stands at ``start``."""
    size = 1 << 13
    while (stop := (head := data.read(start, size)).find(END)) < 0:
        if size >= HEADER or start + size >= data.size:
            raise Broken("header does not end")
        size *= 4
    lines = re.sub(r"\r\n[ \t]+", " ", head[:stop].decode("utf-8", "replace")).split("\r\n")
    if not re.fullmatch(r"WARC/\d\.\d", lines[0]):
        raise Broken("no version line")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Broken("no length")
    first = start + stop + len(END)
    last = first + int(length)
    if last + len(END) > data.size or data.read(last, len(END)) != END:
        raise Broken("length does not fit")
    block = data.read(first, last - first)
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind.lower() == "sha1" and digest.upper() != sha1(block):
        raise Broken("digest differs")
    if headers.get("content-type", "").startswith("application/http"):
        block = block.partition(END)[2]
    return Record(start, last + len(END), headers, block)


def member(data: Bytes, start: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``start`` holds, its end, and what is wrong with it (the bytes up to there are given)."""
    unpack, out, at = zlib.decompressobj(31), [], start
    while at < data.size:
        chunk = data.read(at, 1 << 16)
        at += len(chunk)
        try:
            out.append(unpack.decompress(chunk))
        except zlib.error:
            return b"".join(out) + before_damage(data, start, at - len(chunk), chunk), at, "member is damaged"
        if unpack.eof:
            return b"".join(out), at - len(unpack.unused_data), None
    return b"".join(out), at, "member is cut short"


def before_damage(data: Bytes, start: int, at: int, chunk: bytes) -> bytes:
    """What a chunk at ``at``, of a member from ``start`` on, gives up to the byte at which it is found damaged."""
    unpack, held = zlib.decompressobj(31), []
    for place in range(start, at, 1 << 16):
        unpack.decompress(data.read(place, min(1 << 16, at - place)))
    try:
        for k in range(len(chunk)):
            held.append(unpack.decompress(chunk[k : k + 1]))
    except zlib.error:
        pass
    return b"".join(held)


def salvage(data: Bytes) -> Iterator[Record | tuple[int, int, str]]:
    """All valid records in their order, and between them (start, end, reason) of what is none.

    A member usually is one record; one of several is held whole, and its records have the member's place. Of a damaged
    member, records that were unpacked before the damage count if their digest agrees. An empty archive gives nothing.
    """
    at, gap, why = 0, None, ""
    while at < data.size:
        rows: list[Record] = []
        wrong, end = None, at
        try:
            if data.read(at, 3) == GZIP:
                held, end, wrong = member(data, at)
                inside = list(salvage(Bytes(io.BytesIO(held), len(held)))) if wrong is None or b"arc-block-digest" in held.lower() else []
                rows = [Record(at, end if wrong is None else None, x.headers, x.payload) for x in inside if isinstance(x, Record) and (wrong is None or "warc-block-digest" in x.headers)]
                lost = [x for x in inside if not isinstance(x, Record)]
                if wrong is None and not rows and held:
                    wrong = "no record in member"
                elif wrong is None and lost:
                    yield from rows
                    yield from ((at, end, f"bytes {a} to {b} of member: {reason}") for a, b, reason in lost)
                    rows = []
            elif data.read(at, 5) == VERSION:
                rows = [plain_record(data, at)]
                end = rows[0].end
            else:
                wrong = "no member or version line"
        except Broken as e:
            wrong = str(e)
        if wrong is None:
            if gap is not None:
                yield gap, at, why
                gap = None
            yield from rows
            at = end
        else:
            yield from rows
            if gap is None:
                gap, why = at, wrong
            at = data.next_start(at + 1)
    if gap is not None:
        yield gap, data.size, why


@dataclass
class Archive(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcReader(DataSourceReader):
    """One task an archive: those of the manifest, or all of the folder if it has none."""

    def __init__(self, options):
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        system, folder = fs.FileSystem.from_uri(self.path)
        manifest = f"{folder}/{MANIFEST}"
        if system.get_file_info(manifest).type == fs.FileType.File:
            with system.open_input_stream(manifest) as file:
                names = json.loads(file.read())
        else:
            names = [x.base_name for x in system.get_file_info(fs.FileSelector(folder)) if re.search(r"\.warc(\.gz)?$", x.base_name)]
        return [Archive(name) for name in sorted(names)]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a folder without archives
            return
        system, folder = fs.FileSystem.from_uri(self.path)
        path = f"{folder}/{partition.path}"
        rows, size = [], 0
        with system.open_input_file(path) as file:
            for x in salvage(Bytes(file, file.size())):
                if isinstance(x, Record):
                    rows.append((partition.path, "record", x.start, x.end, None, list(x.headers.items()), x.payload))
                    size += len(x.payload)
                else:
                    rows.append((partition.path, "gap", *x, None, None))
                if size > 8 * STEP or len(rows) >= 5000:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), FOUND_SCHEMA.types, strict=True)], schema=FOUND_SCHEMA)


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of record_id, type, uri, page_id, digest, refers_to, date, payload."""

    def __init__(self, options):
        self.path, self.most = options["path"], int(options.get("maxBytes", 1 << 30))
        self.packed = options.get("compression", "gzip") == "gzip"

    def packing(self, data: bytes) -> bytes:
        if not self.packed:
            return data
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        return pack.compress(data) + pack.flush()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = fs.FileSystem.from_uri(self.path)
        system.create_dir(folder, recursive=True)
        names: list[str] = []
        out = None
        for rows in iterator:
            for row in rows.to_pylist():
                if out is None or out.tell() >= self.most:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}")
                    out = system.open_output_stream(f"{folder}/{names[-1]}", compression=None)
                    out.write(self.packing(record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": row["date"], "WARC-Filename": names[-1], "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")))
                out.write(self.packing(page_record(row)))
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages) -> None:
        system, folder = fs.FileSystem.from_uri(self.path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{MANIFEST}") as file:
            file.write(json.dumps(sorted(n for m in messages if m is not None for n in m.names)).encode())

    def abort(self, messages) -> None:
        system, folder = fs.FileSystem.from_uri(self.path)
        for name in (n for m in messages if m is not None for n in m.names):
            system.delete_file(f"{folder}/{name}")


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return FOUND

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def page_record(row: dict) -> bytes:
    """The record of a page: an HTTP response with its payload, or a revisit that names the response and holds no payload."""
    payload = row["payload"] or b""
    answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    again = row["type"] == "revisit"
    headers = {
        "WARC-Type": row["type"], "WARC-Record-ID": f"<urn:uuid:{row['record_id']}>", "WARC-Date": row["date"], "WARC-Target-URI": row["uri"], "WARC-Payload-Digest": f"sha1:{row['digest']}", "Content-Type": "application/http; msgtype=response",
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if again else None, "WARC-Refers-To": f"<urn:uuid:{row['refers_to']}>" if again else None, "X-Page-ID": None if row["page_id"] is None else str(row["page_id"]),
    }
    return record(headers, answer if again else answer + payload)


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: 160 bits are 32 letters, eight for each ten hexadecimal digits."""
    hexed, parts = F.sha1(data), []
    for k in range(4):
        forty = F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 10).cast("long")
        parts += [F.substring(F.lit(BASE32), F.shiftright(forty, 35 - 5 * j).bitwiseAND(31).cast("int") + 1, F.lit(1)) for j in range(8)]
    return F.concat(*parts)


def uuid_of(*parts: Column) -> Column:
    """A record's id by what the record is, so a repeated task writes the same one."""
    h = F.md5(F.to_json(F.struct(*[p.alias(f"p{k}") for k, p in enumerate(parts)])))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def page_records(pages: DataFrame, *, id_col: str, url_col: str, html_col: str, least: int, date: str) -> DataFrame:
    """Rows for the writer. Payloads are only shuffled if the table of payloads that occur again is too large to broadcast,
    which Spark reads off its files, or if whole rows are repeated."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("uri"), blank(html_col).cast("binary").alias("payload"))
    key = F.sha2("payload", 256)
    same = rows.select(key.alias("key"), F.length("payload").alias("n"), "page_id", "uri").groupBy("key", "n", "page_id", "uri").count()
    order = F.struct(F.col("page_id").isNull(), F.col("page_id").alias("page_id"), F.col("uri").isNull(), F.col("uri").alias("uri"))
    again = same.groupBy("key", "n").agg(F.sum("count").alias("total"), F.max("count").alias("most"), F.min(order).alias("first")).filter("total > 1")
    path = f"{shared_folder(spark)}/warc-again-{uuid.uuid4().hex}"
    again.select("key", "n", "most", F.col("first.page_id").alias("first_id"), F.col("first.uri").alias("first_uri")).write.parquet(path)
    again = spark.read.parquet(path)
    rows = rows.withColumn("copy", F.lit(0).cast("long"))
    if not again.filter("most > 1").isEmpty():  # whole rows are repeated: only the first of them can be the response
        counted = rows.groupBy("page_id", "uri", "payload").count()
        rows = counted.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1))).drop("count")
    rows = rows.withColumn("key", key).join(again.filter(F.col("n") >= least).select("key", "first_id", "first_uri", F.lit(True).alias("again")), "key", "left")
    other = F.coalesce("again", F.lit(False)) & ~(F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("uri").eqNullSafe(F.col("first_uri")) & (F.col("copy") == 0))
    return rows.select(
        uuid_of(F.col("page_id"), F.col("uri"), F.col("key"), F.col("copy")).alias("record_id"),
        F.when(other, "revisit").otherwise("response").alias("type"),
        "uri", "page_id", base32_sha1(F.col("payload")).alias("digest"),
        F.when(other, uuid_of(F.col("first_id"), F.col("first_uri"), F.col("key"), F.lit(0).cast("long"))).alias("refers_to"),
        F.lit(date).alias("date"), F.when(other, None).otherwise(F.col("payload")).alias("payload"),
    )


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0, date: str | None = None, compression: str = "gzip", max_bytes: int = 1 << 30) -> None:
    """Write a record per row to ``folder``, a new one that all machines share (any URI that pyarrow knows).

    Of rows with equal payloads of at least ``least`` bytes, that with the smallest id (then URL; nulls last) is a response and
    the others revisit it; of whole rows that are repeated, one is. Null html is an empty payload; a null id gets no id header.
    """
    spark = pages.sparkSession
    spark.dataSource.register(Warc)
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = page_records(pages, id_col=id_col, url_col=url_col, html_col=html_col, least=least, date=date)
    rows.write.format("warc").option("compression", compression).option("maxBytes", max_bytes).mode("append").save(folder)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records and gaps of all archives in ``folder``: file, kind (record, gap), start, end, reason, headers, payload."""
    spark.dataSource.register(Warc)
    return spark.read.format("warc").load(folder)


def quarantined(found: DataFrame) -> DataFrame:
    """The byte ranges that no valid record covers, with the check that failed first."""
    return found.filter("kind = 'gap'").select("file", "start", "end", "reason")


def page_digests(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id of the pages' records.

    A revisit has its payload's size from the record that it names; if that one is lost, the size and refers_to are null and
    the digest is that of its header.
    """
    head = lambda name: F.element_at("headers", name)
    bare = lambda name: F.regexp_extract(head(name), "^<urn:uuid:(.*)>$", 1)
    rows = found.filter((F.col("kind") == "record") & head("warc-type").isin("response", "revisit"))
    rows = cut(
        rows.select(
            head("x-page-id").cast("long").alias("page_id"), head("warc-type").alias("record_type"), bare("warc-record-id").alias("record_id"), bare("warc-refers-to").alias("_refers"), F.length("payload").cast("long").alias("payload_bytes"),
            F.when(head("warc-type") == "response", base32_sha1(F.col("payload"))).otherwise(F.regexp_replace(head("warc-payload-digest"), "^sha1:", "")).alias("payload_digest"),
        )
    )
    whole = rows.filter("record_type = 'response'")
    again = rows.filter("record_type = 'revisit'").drop("payload_bytes")
    known = whole.select(F.col("record_id").alias("_refers"), F.col("page_id").alias("refers_to"), "payload_bytes", F.col("payload_digest").alias("_digest"))
    again = again.join(known, "_refers", "left").withColumn("payload_digest", F.coalesce("_digest", "payload_digest"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    return whole.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(again.select(*columns))


def archive_pages(pages: DataFrame, *, least: int = 0) -> DataFrame:
    """Write ``pages`` as archives to the shared folder and read them back: ``page_digests`` of what was read.

    An empty table gives an empty result; repeated rows give a record each; further columns are ignored.
    """
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, least=least)
    return page_digests(read_archives(pages.sparkSession, folder))
