"""WARC records in ZIP packages: written as stored members with an index, read back by byte ranges."""

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from aftermath.llm.shared import Workspace

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# A package is closed after so many records, so its index and a task's memory stay small.
RECORDS = 20_000
# Neighbouring records up to so many bytes are fetched by one range read.
BLOCK = 4 << 20
TAIL = 22 + 0xFFFF + 20


# ---- writing


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and leaves the payload out."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if kind == "response" else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if kind == "revisit":
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class Package:
    """A ZIP of stored members: gzipped records one after the other, and where each is."""

    def __init__(self, system, folder: str):
        self.name = f"{uuid.uuid4().hex}.wacz"
        system.create_dir(folder, recursive=True)
        self.stream = system.open_output_stream(f"{folder}/{self.name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.index, self.at = [], 0

    def add(self, page_id, packed: bytes) -> None:
        self.index.append(json.dumps({"page": page_id, "offset": self.at, "length": len(packed)}))
        self.data.write(packed)
        self.at += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(INDEX, "".join(f"{line}\n" for line in self.index))
        self.zip.close()
        self.stream.close()
        return self.name, len(self.index)


def with_roles(space: Workspace, pages: DataFrame, least: int) -> DataFrame:
    """(page_id, url, payload, digest, owner): owner is the page that a revisit repeats, else null.

    Owners of repeated payloads are found from digests alone and joined back;
    Spark splits the join of a payload that very many pages have.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1("payload"))
    long_enough = rows.where(F.octet_length("payload") >= least)
    owners = long_enough.groupBy("digest").agg(F.max("page_id").alias("_owner"), F.count(F.lit(1)).alias("_n"))
    owners = space.write(owners.where("_n > 1 AND _owner IS NOT NULL").select("digest", "_owner"), "owners")
    joined = rows.join(owners, "digest", "left")
    repeats = ~F.col("page_id").eqNullSafe(F.col("_owner")) & F.col("_owner").isNotNull()
    return joined.select("page_id", "url", "payload", "digest", F.when(repeats, F.col("_owner")).alias("owner"))


def write_archives(space: Workspace, pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages into packages; (folder, name, records) of each.

    A task attempt writes under names of its own. Only packages of attempts
    that finished are in the returned, written list.
    """
    folder = f"{space.folder}/packages"

    def run(batches):
        system, base = fs.FileSystem.from_uri(folder)
        package, done = None, []
        for batch in batches:
            for page_id, url, payload, digest, owner in zip(*(batch.column(i) for i in range(5))):
                package = package or Package(system, base)
                page_id, payload = page_id.as_py(), payload.as_py()
                name = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                package.add(page_id, gzip.compress(record(page_id, url.as_py(), payload, name, owner.as_py()), 5, mtime=0))
                if len(package.index) >= RECORDS:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        names, counts = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array([folder] * len(done), pa.string()), pa.array(names, pa.string()), pa.array(counts, pa.int64())],
            ["folder", "name", "records"],
        )

    rows = with_roles(space, pages, least)
    return space.write(rows.mapInArrow(run, "folder string, name string, records long"), "list")


# ---- reading


def members(file) -> dict[str, tuple[int, int]]:
    """Where the data of each stored member starts and how long it is, from the central directory.

    Only the file's end, its directory and the members' local headers are read.
    """
    size = file.size()
    start = max(0, size - TAIL)
    tail = file.read_at(size - start, start)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP package, or cut off")
    entries, length, offset = struct.unpack("<HII", tail[at + 10 : at + 20])
    if 0xFFFF == entries or 0xFFFFFFFF in (length, offset):
        if tail[at - 20 : at - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (where,) = struct.unpack("<Q", tail[at - 12 : at - 4])
        end = file.read_at(56, where)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, offset = struct.unpack("<QQQ", end[32:56])
    directory, out, p = file.read_at(length, offset), {}, 0
    for _ in range(entries):
        if directory[p : p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack("<H", directory[p + 10 : p + 12])[0]
        packed, plain = struct.unpack("<II", directory[p + 20 : p + 28])
        n_name, n_extra, n_note = struct.unpack("<HHH", directory[p + 28 : p + 34])
        (local,) = struct.unpack("<I", directory[p + 42 : p + 46])
        name = directory[p + 46 : p + 46 + n_name].decode()
        extra = directory[p + 46 + n_name : p + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:  # 64-bit values of those fields that are full, in this order
                values = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                local = next(values) if local == 0xFFFFFFFF else local
            extra = extra[4 + n :]
        if method == 0:
            head = file.read_at(30, local)
            n_name2, n_extra2 = struct.unpack("<HH", head[26:30])
            out[name] = (local + 30 + n_name2 + n_extra2, packed)
        p += 46 + n_name + n_extra + n_note
    return out


def _locate(batches):
    for batch in batches:
        for folder, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            system, base = fs.FileSystem.from_uri(folder)
            with system.open_input_file(f"{base}/{name}") as file:
                found = members(file)
                if DATA not in found or INDEX not in found:
                    raise ValueError(f"{name}: data and index must be stored members")
                begin, length = found[INDEX]
                lines = [json.loads(x) for x in file.read_at(length, begin).splitlines()]
            data = found[DATA][0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{folder}/{name}"] * len(lines), pa.string()),
                    pa.array([data + x["offset"] for x in lines], pa.int64()),
                    pa.array([x["length"] for x in lines], pa.int64()),
                ],
                ["path", "begin", "length"],
            )


def parsed(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of a gzipped record."""
    head, _, rest = gzip.decompress(raw).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    sizes = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda name: int(x) if (x := fields.get(name, "")[10:-1]) else None
    kind = fields["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    kept = payload if kind == "response" else None
    return number("WARC-Record-ID"), int(sizes["Content-Length"]), digest, kind, number("WARC-Refers-To"), kept


def _fetch(batches):
    opened, file, held, begin = None, None, b"", 0
    for batch in batches:
        rows = []
        for path, at, length, last in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if path != opened:
                folder, name = path.rsplit("/", 1)
                system, base = fs.FileSystem.from_uri(folder)
                file, opened, held = system.open_input_file(f"{base}/{name}"), path, b""
            if not begin <= at <= at + length <= begin + len(held):
                held, begin = file.read_at(last - at, at), at
            rows.append(parsed(held[at - begin : at - begin + length]))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        columns = zip(*rows) if rows else [()] * len(kinds)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_archives(packages: DataFrame) -> DataFrame:
    """All records of the packages (folder, name): page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    Directories and indexes are read first. Records are then dealt out by
    blocks of a package, so a large package is read by many tasks, each block
    by one range read. Payloads of revisits are null; those of responses are
    checked against their digest.
    """
    places = packages.repartition("name").mapInArrow(_locate, "path string, begin long, length long")
    # An index row stands for a whole record, so Spark must not size tasks by the index.
    records = packages.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    tasks = max(packages.sparkSession.sparkContext.defaultParallelism, -(-records // RECORDS))
    block = F.floor(F.col("begin") / BLOCK)
    end = F.max(F.col("begin") + F.col("length"))
    dealt = places.withColumn("block", block).repartition(tasks, "path", "block")
    dealt = dealt.withColumn("last", end.over(Window.partitionBy("path", "block")))
    dealt = dealt.sortWithinPartitions("path", "begin").select("path", "begin", "length", "last")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return dealt.mapInArrow(_fetch, schema)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and read the records back, without payloads.

    A null html is an empty payload. Of pages with equal payloads of at least
    ``least`` bytes the largest page_id is a response; repeated rows with that
    id are responses too. A null page_id is never referred to: such rows revisit
    if another page has their payload, and are responses otherwise. No pages
    give no packages and no rows. Other columns are ignored.
    """
    space = Workspace(pages.sparkSession, "warc")
    return read_archives(write_archives(space, pages, least)).drop("payload")
