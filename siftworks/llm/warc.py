"""WARC records in ZIP packages: writing, and reading by ranges without extraction.

A written package holds stored members only: archive/data.warc.gz (one gzip member for each record) and indexes/index.cdxj (CDXJ
lines: where each record lies in it). Any stored members below archive/ and indexes/ are read, plain or gzipped. The reader
parses the end-of-central-directory record at the file's end, the ZIP64 locator and record where there is one, and the central
directory; it finds where the stored members' bytes begin, reads the indexes, and then reads records by their ranges,
neighbouring ranges together up to READ bytes. Nothing is unpacked to a disk.

Packages lie in the shared folder and are reached by its URI, so it may be a store that all executors see. A task writes under
names of its own attempt and reports them when done: those of failed attempts are never read.

Defined cases: a null payload is empty; a null page_id is written as such and comes back null, and is the original of its payload
only if no other id has it; rows that repeat the smallest page_id of their payload are all responses; a null url is
left out; no rows make no packages; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm.common import cut, join_groups, partitions, scratch

PACKAGE_BYTES = 64 << 20
READ = 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def default_store(spark: SparkSession) -> str:
    """What Spark puts before a path that names no store: its default file system, local or shared."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark.sparkContext._jsc.hadoopConfiguration()).toString().rstrip("/")


def in_store(path: str, store: str) -> str:
    """A path with its store, as Spark takes it."""
    if "://" in path:
        return path
    if path.startswith("file:"):
        return f"file://{path.removeprefix('file:')}"
    return f"file://{path}" if store == "file:" else f"{store}{path}"


# --- ZIP --------------------------------------------------------------------------------------------------------------------


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """Name -> first byte and length of each stored member of a ZIP file that can be read by ranges."""

    def at(offset: int, n: int) -> bytes:
        file.seek(offset)
        return file.read(n)

    tail_at = max(0, size - 65557)
    tail = at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of a central directory")
    n, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = at(tail_at + end - 20, 20) if tail_at + end >= 20 else b""
    if locator[:4] == b"PK\x06\x07":
        record = at(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 locator points elsewhere")
        n, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, found, p = at(start, length), {}, 0
    for _ in range(n):
        if directory[p : p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, p + 10)[0]
        packed, full, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", directory, p + 20)
        offset = struct.unpack_from("<I", directory, p + 42)[0]
        name = directory[p + 46 : p + 46 + name_n].decode()
        extra, q = directory[p + 46 + name_n : p + 46 + name_n + extra_n], 0
        while q + 4 <= len(extra):
            kind, own = struct.unpack_from("<HH", extra, q)
            if kind == 1:  # the values that don't fit, in this order
                values = list(struct.unpack_from(f"<{own // 8}Q", extra, q + 4))
                full = values.pop(0) if full == 0xFFFFFFFF else full
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                offset = values.pop(0) if offset == 0xFFFFFFFF else offset
            q += 4 + own
        if method == 0 and not name.endswith("/"):
            local = at(offset, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"no local header for {name}")
            found[name] = (offset + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        p += 46 + name_n + extra_n + comment_n
    return found


# --- records ----------------------------------------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, kind: str, digest: str, refers_to: int | None, n_bytes: int, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's headers (lower-case names), payload_bytes, payload_digest (of what is there, else as stated) and payload."""
    top, _, rest = raw.partition(b"\r\n\r\n")
    lines = top.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    http, _, payload = rest[: int(headers["content-length"])].partition(b"\r\n\r\n")
    stated = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "revisit":
        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return headers | {"payload_bytes": length, "payload_digest": stated, "payload": None}
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest != stated:
        raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
    return headers | {"payload_bytes": len(payload), "payload_digest": digest, "payload": payload}


def number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


# --- index ------------------------------------------------------------------------------------------------------------------


def url_key(url: str | None) -> str:
    """The host's labels from the last to the first, and the rest: what lines of an index are sorted by."""
    found = re.match(r"(?i)https?://(?:www\d*\.)?([^/?#]*)([^#]*)", url or "")
    if not found:
        return quote(url or "-", safe=":/")
    return quote((",".join(reversed(found[1].split("."))) + ")" + (found[2] or "/")).lower(), safe="/,)?=&:%+;")


def index_lines(parts: dict[str, tuple[int, int]], read: Callable[[int, int], bytes]) -> dict[str, list[dict]]:
    """Of each member below archive/ the offsets and lengths that the members below indexes/ list, plain or gzipped."""
    names = sorted(x for x in parts if x.startswith("archive/") and not x.endswith("/"))
    listed = sorted(x for x in parts if x.startswith("indexes/") and re.search(r"\.cdxj?(\.gz)?$", x))
    if not listed:
        raise ValueError("no stored index below indexes/")
    found: dict[str, dict[tuple[int, int], dict]] = {}
    for name in listed:
        raw = read(*parts[name])
        for line in (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode().split("\n"):
            if "{" not in line or line.startswith("!"):
                continue
            x = json.loads(line[line.index("{") :])
            own = x.get("filename") or (names[0] if len(names) == 1 else "")
            member = own if own.startswith("archive/") else f"archive/{own}"
            if member not in parts:
                raise ValueError(f"the index names {own!r}, which is no stored member below archive/")
            at = int(x["offset"]), int(x["length"])
            found.setdefault(member, {})[at] = {"offset": at[0], "length": at[1]}
    return {k: list(v.values()) for k, v in found.items()}


class Package:
    """One archive being written."""

    def __init__(self, folder: str):
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        self.stream = system.open_output_stream(f"{path}/{self.path.rsplit('/', 1)[1]}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.lines: list[str] = []
        self.size = 0

    def add(self, url: str | None, digest: str, raw: bytes) -> None:
        packed = gzip.compress(raw, 1, mtime=0)
        self.lines.append(f"{url_key(url)} {re.sub('[^0-9]', '', DATE)[:14]} " + json.dumps({"url": url, "digest": f"sha1:{digest}", "offset": str(self.size), "length": str(len(packed)), "filename": DATA.removeprefix("archive/")}))
        self.data.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(sorted(self.lines)))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines), self.size


# --- operators --------------------------------------------------------------------------------------------------------------


def base32_of_hex(hex_: Column) -> Column:
    """A 40-digit hex string as 32 base-32 characters."""
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda g: F.conv(F.substring(hex_, g * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    letter = lambda x, k: F.substring(F.lit(BASE32), F.shiftright(x, 5 * k).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    return F.array_join(F.transform(groups, lambda x: F.concat(*[letter(x, k) for k in (3, 2, 1, 0)])), "")


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, digest (hex SHA-1), n_bytes, kind, refers_to and html (null for revisits).

    Kinds are told by digests alone. Payloads are reduced to one per digest before they are moved, in each task and then in all,
    and joined with the responses: revisits move none, and a payload that fills a third of the pages costs one per task."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    light = cut(rows.select("page_id", "url", "digest", F.octet_length("html").cast("bigint").alias("n_bytes")))
    first = cut(light.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows")))
    again = (F.col("n_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    kinds = join_groups(light, first, "digest", "rows").withColumn("kind", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("first")))
    kinds = kinds.select("page_id", "url", "digest", "n_bytes", "kind", "refers_to")
    payloads = rows.groupBy("digest").agg(F.first("html").alias("html"))
    revisits = kinds.where("kind = 'revisit'").withColumn("html", F.lit(None).cast("binary"))
    return revisits.unionByName(kinds.where("kind = 'response'").join(payloads, "digest").select(revisits.columns))


def write_packages(planned: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes planned records; returns the packages (path, records, bytes), cut so that each is written once."""
    folder = in_store(folder, default_store(planned.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                for row in batch.slice(i, 256).to_pylist():
                    package = package or Package(folder)
                    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                    package.add(row["url"], digest, record(row["page_id"], row["url"], row["kind"], digest, row["refers_to"], row["n_bytes"], row["html"] or b""))
                    if package.size >= package_bytes:
                        done.append(package.close())
                        package = None
        if package:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["path", "records", "bytes"])

    return cut(planned.mapInArrow(run, "path string, records bigint, bytes bigint"))


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """packages: path. One row per record: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def ranges(lines: list[dict]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for x in sorted(lines, key=lambda x: x["offset"]):
            if held and (x["offset"] + x["length"] - held[0]["offset"] > READ or x["offset"] > held[-1]["offset"] + held[-1]["length"]):
                yield held
                held = []
            held.append(x)
        if held:
            yield held

    store = default_store(packages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (x for batch in batches for x in batch.column(0).to_pylist()):
            system, local = file_system(in_store(path, store))
            with system.open_input_file(local) as file:
                parts = members(file, file.size())

                def read(start: int, length: int) -> bytes:
                    file.seek(start)
                    return file.read(length)

                for member, lines in index_lines(parts, read).items():
                    for near in ranges(lines):
                        raw = read(parts[member][0] + near[0]["offset"], near[-1]["offset"] + near[-1]["length"] - near[0]["offset"])
                        rows = []
                        for x in near:
                            at = x["offset"] - near[0]["offset"]
                            one = raw[at : at + x["length"]]
                            got = parse(zlib.decompress(one, 31) if one[:2] == b"\x1f\x8b" else one)
                            rows.append({"page_id": number(got["warc-record-id"]), "url": got.get("warc-target-uri"), "record_type": got["warc-type"], "payload_bytes": got["payload_bytes"], "payload_digest": got["payload_digest"], "refers_to": number(got.get("warc-refers-to")), "payload": got["payload"] if payloads else None})
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spark = packages.sparkSession
    fields = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
    return packages.select("path").repartition(partitions(spark)).mapInArrow(run, fields)


def archive_and_read(spark: SparkSession, pages: DataFrame, least_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Writes all pages into packages in the shared folder and reads them back."""
    return read_packages(write_packages(plan_records(pages, least_bytes), scratch(spark, "warc")), payloads)
