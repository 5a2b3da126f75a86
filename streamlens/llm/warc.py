"""WARC files in ZIP packages: writer and range reader.

A package is a ZIP archive with stored (uncompressed) members: the WARC file,
one gzip member per record, and an index with the byte range of every record.
The reader never extracts a package.  It reads the end record (ZIP64 if need
be) and the central directory, finds the stored members, reads the indexes and
turns them into byte ranges of the package; records are then read range by
range, in blocks that Spark spreads over the cluster.

Revisits: of records with equal payloads of at least ``min_bytes``, the one with
the largest id is written as response; the others are revisit records without
payload that refer to it.

Edge cases: a NULL payload is empty.  A NULL id wins only over no other id;
if all ids of equal payloads are NULL, all are responses.  Rows that repeat the
winning id and payload are responses too.  A NULL URL is left out of the
record.  An empty table gives packages without records, or none.

Packages of other tools: index members are CDXJ (offsets as numbers or text) or
CDX with its legend line, plain or gzip; ``.idx`` files, which index the index,
are not read.  A record that several indexes list is one record.  Records may be
gzip members or plain.  Responses have the payload after the HTTP header,
without its chunked transfer coding; a missing payload digest, or one of another
algorithm, is computed, a base32 one given in hexadecimal.  All other records
(warcinfo, request, metadata, ...) have NULL payload columns, and a revisit has
the digest and length that its record states, if any.
"""

from __future__ import annotations

import base64
import binascii
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.llm.common import materialize, own_exchange
from streamlens.session import scratch_path
from streamlens.sources.files import filesystem

PACKAGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
PACKAGES_PER_TASK, BLOCKS_PER_TASK = 16, 4
MIN_BYTES = 1000
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "path string, page_id string, url string, record_type string, refers_to string, " \
          "payload_digest string, payload_bytes long, payload binary"


# ---- records ---------------------------------------------------------------

def encode_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One gzip member with a response, or a revisit if ``refers_to`` is set."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in _text(head).splitlines()[1:]:
        k, _, v = line.partition(":")
        out.setdefault(k.strip().lower(), v.strip())
    return out


def _split_http(block: bytes) -> tuple[dict[str, str], bytes] | None:
    """(header fields, body) of an HTTP message; None if it is none."""
    if not block.startswith(b"HTTP/"):
        return None
    head, sep, body = block.partition(b"\r\n\r\n")
    return _fields(head), body if sep else b""


def _unchunked(body: bytes) -> bytes:
    """The content of a chunked body; as it is when its framing is broken
    (some tools store the decoded body under the original header)."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            return body
        n = int(size, 16)
        if n == 0:
            return b"".join(out)
        piece = body[end + 2:end + 2 + n]
        if len(piece) < n or body[end + 2 + n:end + 4 + n] != b"\r\n":
            return body
        out.append(piece)
        at = end + 4 + n


def _sha1_hex(field: str | None) -> str | None:
    """The bare lower-case hexadecimal SHA-1 of a digest field; None if it is
    missing or not a SHA-1."""
    kind, _, value = (field or "").rpartition(":")
    if kind.lower() not in ("", "sha1", "sha-1"):
        return None
    if len(value) == 32:
        try:
            return base64.b32decode(value.upper()).hex()
        except binascii.Error:
            return None
    return value.lower() if len(value) == 40 and not value.lower().strip("0123456789abcdef") else None


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def decode_record(member: bytes) -> dict:
    """The fields of a record and its payload (None unless it is a response)."""
    raw = gzip.decompress(member) if member[:2] == b"\x1f\x8b" else member
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/"):
        raise ValueError("no WARC record at an indexed range")
    warc = _fields(head)
    block = rest[:int(warc["content-length"])]
    kind = warc["warc-type"].lower()
    http = _split_http(block) if kind in ("response", "revisit") else None
    payload = digest = size = None
    if kind == "response":
        fields, payload = http or ({}, block)
        if "chunked" in fields.get("transfer-encoding", "").lower():
            payload = _unchunked(payload)
        size = len(payload)
        digest = _sha1_hex(warc.get("warc-payload-digest")) or hashlib.sha1(payload).hexdigest()
    elif kind == "revisit":
        size = _number((http[0] if http else {}).get("content-length"))
        digest = _sha1_hex(warc.get("warc-payload-digest"))
    page, refers = (warc.get(k, "").strip("<>") for k in ("warc-record-id", "warc-refers-to"))
    return {"page_id": page.removeprefix("urn:page:") if page.startswith("urn:page:") else None,
            "url": warc.get("warc-target-uri"), "record_type": kind,
            "refers_to": refers.removeprefix("urn:page:") or None, "payload_digest": digest,
            "payload_bytes": size, "payload": payload}


# ---- writer ----------------------------------------------------------------

def _write_package(folder: str, rows: Iterator[tuple], date: str, limit: int) -> tuple[str, int, bool]:
    """Write rows to a new package until it holds ``limit`` bytes; returns its
    path, its number of records and whether rows may be left."""
    fs, root = filesystem(folder)
    name = f"{uuid.uuid4().hex}.wacz"  # a retried task writes another package; only listed ones are read
    index, at, more = [], 0, False
    with fs.open_output_stream(f"{root}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(WARC_MEMBER, "w", force_zip64=True) as f:
            for page_id, url, payload, refers_to in rows:
                member = encode_record(page_id, url, payload, refers_to, date)
                f.write(member)
                index.append(f"{url or '-'} {json.dumps({'offset': at, 'length': len(member)})}")
                at += len(member)
                if at >= limit:
                    more = True
                    break
        z.writestr(INDEX_MEMBER, "".join(line.replace("\n", "%0A").replace("\r", "%0D") + "\n" for line in index))
        z.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [
            {"path": WARC_MEMBER, "bytes": at}, {"path": INDEX_MEMBER, "records": len(index)}]}))
    return f"{folder}/{name}", len(index), more


def write_packages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = MIN_BYTES, date: str = "2024-01-01T00:00:00Z",
                   package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write every row as a record; returns the written list of packages
    (path, records).  ``folder`` must be shared by all executors."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"))
    # only digests that occur more than once; counted with map-side combining
    shared = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
              .agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    refers = F.when(F.col("winner").isNotNull() & ~F.col("id").eqNullSafe(F.col("winner")), F.col("winner"))
    records = rows.join(own_exchange(shared, "digest"), "digest", "left").select(
        F.col("id").cast("string"), "url", "payload", refers.cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for b in batches:
                for i in range(b.num_rows):
                    yield tuple(b.column(c)[i].as_py() for c in range(4))

        rows = each()
        first = next(rows, None)
        while first is not None:
            path, n, more = _write_package(folder, chain([first], rows), date, package_bytes)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])
            first = next(rows, None) if more else None

    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    return materialize(records.mapInArrow(run, "path string, records long"), "warc-list")


# ---- reader ----------------------------------------------------------------

def zip_members(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, offset of the data, stored size) from the central
    directory of a ZIP or ZIP64 archive."""
    def read(at: int, n: int) -> bytes:
        f.seek(at)
        return f.read(n)

    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    end = len(tail) - 21
    while True:  # the end record is the last signature whose comment reaches to the end
        end = tail.rfind(b"PK\x05\x06", 0, end + 3)
        if end < 0:
            raise ValueError("no ZIP end record")
        if end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
    entries, length, start = struct.unpack_from("<HLL", tail, end + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, out = read(start, length), 0, {}
    for _ in range(entries):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        stored, full, n_name, n_extra, n_comment = struct.unpack_from("<LLHHH", directory, at + 20)
        local = struct.unpack_from("<L", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, stop = at + 46 + n_name, at + 46 + n_name + n_extra
        while extra + 4 <= stop:
            kind, n = struct.unpack_from("<HH", directory, extra)
            if kind == 1:  # 64-bit values, in this order, of the fields that are all ones
                wide = iter(struct.unpack_from(f"<{n // 8}Q", directory, extra + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                local = next(wide) if local == 0xFFFFFFFF else local
            extra += 4 + n
        head = read(local, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header of {name}")
        out[name] = (method, local + 30 + sum(struct.unpack_from("<HH", head, 26)), stored)
        at = stop + n_comment
    return out


def _trailing_object(line: str) -> dict:
    """The JSON object that ends a CDXJ line; the key before it may hold " {"."""
    at = line.find(" {")
    while at >= 0:
        try:
            return json.loads(line[at + 1:])
        except ValueError:
            at = line.find(" {", at + 1)
    raise ValueError("an index line without a JSON object")


def index_entries(raw: bytes) -> Iterator[tuple[str | None, int, int]]:
    """(archive file or None, offset, length) of an index's lines: CDXJ, or CDX
    with a legend line; gzip if it begins so."""
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    legend = None
    for line in _text(raw).split("\n"):
        line = line.rstrip("\r")
        if line.startswith((" CDX ", "CDX ")):
            legend = line.split()[1:]
        elif line.endswith("}") and not line.startswith("!"):
            entry = _trailing_object(line)
            yield entry.get("filename"), int(entry["offset"]), int(entry["length"])
        elif legend and line.strip():
            entry = dict(zip(legend, line.split()))
            yield entry.get("g"), int(entry["V"]), int(entry["S"])


def record_ranges(f, size: int) -> list[tuple[int, int]]:
    """(offset, length) in the package of every record its indexes list."""
    members = zip_members(f, size)
    archives = {n.removeprefix("archive/"): m for n, m in members.items() if n.startswith("archive/") and not n.endswith("/")}
    indexes = {n: m for n, m in members.items() if n.startswith("indexes/") and not n.endswith(("/", ".idx"))}
    for name, (method, *_) in [*archives.items(), *indexes.items()]:
        if method:
            raise ValueError(f"{name} is compressed; only stored members can be range-read")
    only = next(iter(archives)) if len(archives) == 1 else WARC_MEMBER.removeprefix("archive/")
    out = set()
    for _, at, stored in indexes.values():
        f.seek(at)
        for name, offset, length in index_entries(f.read(stored)):
            name = (name or only).removeprefix("archive/")
            if name not in archives:
                raise ValueError(f"an index names {name}, which is not in the package")
            if offset < 0 or length <= 0 or offset + length > archives[name][2]:
                raise ValueError(f"an index names bytes outside {name}")
            out.add((archives[name][1] + offset, length))
    return sorted(out)


def read_packages(spark: SparkSession, packages: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All records of the packages in column ``path``: ids, URL, type, payload
    and digest as recorded.  Byte ranges are dealt out evenly, whatever the
    sizes of the packages."""
    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, root = filesystem(path)
                with fs.open_input_file(root) as f:
                    ranges = record_ranges(f, f.size())
                blocks: list[list] = []
                for at, n in ranges:
                    if not blocks or at + n - blocks[-1][0][0] > block_bytes:
                        blocks.append([])
                    blocks[-1].append((at, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(blocks), pa.string()),
                     pa.array([[{"at": a, "n": n} for a, n in x] for x in blocks],
                              pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())])))], names=["path", "ranges"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, ranges in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, root = filesystem(path)
                with fs.open_input_file(root) as f:
                    start = ranges[0]["at"]
                    data = f.read_at(ranges[-1]["at"] + ranges[-1]["n"] - start, start)
                rows = [{"path": path, **decode_record(data[r["at"] - start:r["at"] - start + r["n"]])} for r in ranges]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("path", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload", pa.binary())]))

    packages = packages.select("path")
    planned = packages.repartition(max(1, -(-packages.count() // PACKAGES_PER_TASK)), "path")
    blocks = materialize(planned.mapInArrow(plan, "path string, ranges array<struct<at:long,n:long>>"), "warc-blocks")
    # a block's row is small but stands for block_bytes to read: count rows, not their bytes
    tasks = max(1, -(-blocks.count() // BLOCKS_PER_TASK))
    return blocks.repartition(tasks, F.col("path"), F.element_at("ranges", 1)["at"]).mapInArrow(read, _RECORD)
