"""WARC archives with an index first: records are found by file, offset and length, and read in coalesced ranges.

Writing tasks append one gzip member for each record to files of their own and return the index: offset, length, URL
and digest of each record. Only the index of attempts that succeed becomes a table, so files of lost attempts are
never read. Of large equal payloads one record holds the payload and the others refer to it.

Reading starts from rows of the index. They are dealt out by file and stretch of it and sorted by offset; ranges that
lie close together are fetched by one read, and each record is cut out, unpacked and checked against its digest.
Files are opened through Arrow's file systems, so the folder may be on any store that those know.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

REVISIT_BYTES = 1000  # smaller payloads are never replaced by a reference
FILE_BYTES = 256 << 20  # an archive file that has reached this is followed by a new one
TASK_BYTES = 16 << 20  # of archives that one task is meant to read
READ_BYTES, GAP_BYTES = 4 << 20, 64 << 10  # one read has at most so much, and may read over such a gap
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

INDEX = ("page_id long, url string, file string, offset long, length long, payload_bytes long, payload_digest string, "
         "record_type string, refers_to long")
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "payload binary, intact boolean")


def planned(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload`` and what its record is to be.

    Of equal payloads of at least ``REVISIT_BYTES`` the largest ID is the response and the others revisit it; rows
    that share the largest ID are all responses. Null html is an empty payload. A row without an ID revisits, unless
    no row with its payload has one.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    shared = (
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 AND keeper IS NOT NULL").drop("n")
    )
    revisits = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(shared, "payload_digest", "left").select(
        "page_id", "url", "payload_bytes", "payload_digest", F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("keeper")).alias("refers_to"), F.when(~revisits, F.col("payload")).alias("payload"))


def record_name(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(row: dict) -> bytes:
    """One WARC record; control characters in the URL are escaped, so that they cannot end a header."""
    revisit = row["record_type"] == "revisit"
    payload = b"" if revisit else row["payload"]
    digest = row["payload_digest"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
        b"\r\n" if revisit else b"Content-Length: %d\r\n\r\n" % len(payload))
    headers = {
        "WARC-Type": row["record_type"], "WARC-Record-ID": record_name(row["page_id"], digest), "WARC-Date": DATE,
        "WARC-Target-URI": None if row["url"] is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in row["url"]),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Refers-To": record_name(row["refers_to"], digest) if revisit else None,
        "X-Page-ID": row["page_id"], "X-Refers-To-Page-ID": row["refers_to"], "X-Payload-Length": row["payload_bytes"],
        "Content-Length": len(http) + len(payload),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None) + "\r\n"
    return head.encode() + http + payload + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers and payload of one record; ``intact`` if lengths and, with a payload, its digest are right."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    payload = rest[:size].partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = lambda name: int(headers[name]) if name in headers else None
    revisit = headers["WARC-Type"] == "revisit"
    whole = version == "WARC/1.1" and rest[size:] == b"\r\n\r\n"
    return {
        "page_id": number("X-Page-ID"), "url": headers.get("WARC-Target-URI"), "record_type": headers["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-ID"), "payload_bytes": number("X-Payload-Length"), "payload_digest": digest,
        "payload": None if revisit else payload,
        "intact": whole and (revisit or hashlib.sha1(payload).hexdigest() == digest),
    }


def _packed(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _arrow(rows: list[dict], names: list[str], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in names], names=names)


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _kinds(schema: str) -> dict:
    return {name: _KINDS[kind] for name, kind in (part.split() for part in schema.split(", "))}


def write(plan: DataFrame, folder: str) -> DataFrame:
    """Write the planned records below ``folder``; the result is the index and has to be stored as a table once."""
    kinds = _kinds(INDEX)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                found = []
                for row in batch.to_pylist():
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = _packed(record(row))
                    out.write(data)
                    found.append(row | {"file": name, "offset": at, "length": len(data)})
                    at += len(data)
                yield _arrow(found, list(kinds), kinds)
        finally:
            if out is not None:
                out.close()

    return plan.mapInArrow(run, INDEX)


def ranges(rows: list[tuple[int, int]], most: int = READ_BYTES, gap: int = GAP_BYTES) -> list[tuple[int, int, int]]:
    """Coalesce sorted (offset, length) into (offset, length, number of records)."""
    found: list[list[int]] = []
    for offset, length in rows:
        if found and 0 <= offset - found[-1][1] <= gap and offset + length - found[-1][0] <= most:
            found[-1][1], found[-1][2] = offset + length, found[-1][2] + 1
        else:
            found.append([offset, offset + length, 1])
    return [(begin, end - begin, n) for begin, end, n in found]


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the wanted rows of an index. A revisit has no payload of its own."""
    kinds = _kinds(RECORDS)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            place = 0
            while place < len(rows):
                own = rows[place][0]
                until = place
                while until < len(rows) and rows[until][0] == own:
                    until += 1
                if own != name:
                    if file is not None:
                        file.close()
                    name, file = own, store.open_input_file(f"{root}/{own}")
                for begin, size, n in ranges([r[1:] for r in rows[place:until]]):
                    data = file.read_at(size, begin)
                    found = [parse(zlib.decompress(data[o - begin:o - begin + length], 31)) for _, o, length in rows[place:place + n]]
                    if not payloads:
                        found = [f | {"payload": None} for f in found]
                    yield _arrow(found, list(kinds), kinds)
                    place += n
        if file is not None:
            file.close()

    # Rows of an index are narrow: tasks are counted by the bytes that they stand for.
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES))
    stretch = F.floor(F.col("offset") / READ_BYTES)
    dealt = index.select("file", "offset", "length").repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, RECORDS)
