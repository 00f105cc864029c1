"""WARC archives: writing, and a normaliser for monolithic gzip.

Archives written as one gzip stream over the whole file can only be read from the front. normalise() inflates such a
stream once, in pieces of bounded size, writes each record as a gzip member of its own and a sidecar index (a line
`offset length type page` a record), so that a record is reached by one seek.

Files lie in a folder that all executors share: a local path, file: or any file system that pyarrow can open. A task
writes under names of its own attempt, and only the files that successful tasks report are read, so lost executors
and second attempts leave nothing behind that counts. A record is in memory whole, a file never is.

Records with equal payloads of min_bytes or more: the smallest page_id's is the response, the others are revisits that
carry its HTTP head (with the payload's length) and digest but no payload. Digests are compared by key in joins whose
large keys Spark splits; a payload that a third of the pages share is summed to one row a task first.

Defined cases: null html is the empty payload; a null url leaves out the target header, control characters in it are
percent-encoded; rows that repeat the smallest page_id with the same payload are all responses; a null page_id is
larger than any; an empty table gives no files and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Workspace

PIECE = 1 << 16
FILE_BYTES = 64 << 20  # uncompressed bytes after which a task begins another file
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if path.startswith("/") else None


def create(path: str):
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    from pyarrow.fs import FileSystem

    fs, inner = FileSystem.from_uri(path)
    fs.create_dir(os.path.dirname(inner), recursive=True)
    return fs.open_output_stream(inner)


def opened(path: str):
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow.fs import FileSystem

    fs, inner = FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def name_of(page_id) -> str:
    return "null" if page_id is None or page_id != page_id else str(int(page_id))


def record(page_id, url: str | None, payload: bytes, sha: str, refers_to) -> bytes:
    """A response record, or a revisit where refers_to is a page's name."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name_of(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_digests(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, payload_digest (base32), refers_to: the response's page_id for revisits, is_revisit."""
    html = F.coalesce("html", F.lit(""))
    slim = pages.select("page_id", "url", html.alias("html")).withColumns({"_sha": F.sha1(F.encode("html", "UTF-8")), "_bytes": F.octet_length("html")})
    firsts = slim.where(F.col("_bytes") >= min_bytes).groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and _first is not null")
    out = slim.join(firsts, "_sha", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return out.select("page_id", "url", "html", F.when(revisit, F.col("_first")).alias("refers_to"))


def write_monolithic(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """path, records of the archives written, each one gzip stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, out, path, n, size, gz = [], None, "", 0, 0, None
        for batch in batches:
            for page, url, html, ref in zip(batch.page_id, batch.url, batch.html, batch.refers_to):
                if out is None:
                    path, n, size, gz = f"{folder}/raw-{uuid.uuid4().hex}.warc.gz", 0, 0, zlib.compressobj(6, zlib.DEFLATED, 31)
                    out = create(path)
                payload = html.encode("utf-8")
                data = record(page, url, payload, digest(payload), name_of(ref) if ref is not None and ref == ref else None)
                for i in range(0, len(data), PIECE):
                    out.write(gz.compress(data[i : i + PIECE]))
                n, size = n + 1, size + len(data)
                if size >= FILE_BYTES:
                    out.write(gz.flush())
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            done.append((path, n))
        yield pd.DataFrame(done, columns=["path", "records"])

    ids = with_digests(pages, min_bytes).withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    return ids.mapInPandas(run, "path string, records long")


class Inflated:
    """Bytes of a gzip file of any number of members, read forward in pieces."""

    def __init__(self, source):
        self.source, self.z, self.ready, self.left = source, zlib.decompressobj(31), bytearray(), b""

    def more(self) -> bool:
        while True:
            data = self.left or self.source.read(PIECE)
            self.left = b""
            if not data:
                return False
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            got = self.z.decompress(data, PIECE * 4)
            self.left = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if got:
                self.ready += got
                return True

    def head(self) -> bytes | None:
        while (end := self.ready.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.ready.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        out = bytes(self.ready[: end + 4])
        del self.ready[: end + 4]
        return out

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self.more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(source) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    stream = Inflated(source)
    while (top := stream.head()) is not None:
        found = headers(top)
        block = stream.take(int(found["content-length"]))
        stream.take(4)
        yield top, found, block


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """path, index of the rewritten archives: a member a record and a sidecar of offsets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch.path:
                new = f"{folder}/member-{uuid.uuid4().hex}.warc.gz"
                at = 0
                with opened(path) as source, create(new) as out, create(new + ".idx") as index:
                    for top, found, block in records(source):
                        z = zlib.compressobj(6, zlib.DEFLATED, 31)
                        data = z.compress(top) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()
                        out.write(data)
                        page = found["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
                        index.write(f"{at} {len(data)} {found['warc-type']} {page}\n".encode())
                        at += len(data)
                yield pd.DataFrame({"path": [new], "index": [new + ".idx"]})

    return files.mapInPandas(run, "path string, index string")


READ = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string, html string"


def read_indexed(files: DataFrame, payloads: bool = True) -> DataFrame:
    """READ: every record of the archives, each reached by its offset; a response's digest is checked against its payload."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, index in zip(batch.path, batch["index"]):
                rows, size = [], 0
                with opened(path) as source, opened(index) as listed:
                    for line in listed:
                        at, n, kind, page = line.decode().split()
                        source.seek(int(at))
                        data = zlib.decompress(source.read(int(n)), 31)
                        end = data.index(b"\r\n\r\n") + 4
                        found = headers(data[:end])
                        block = data[end : end + int(found["content-length"])]
                        cut = block.index(b"\r\n\r\n") + 4
                        http, payload = headers(block[:cut]), block[cut:]
                        sha = found["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and digest(payload) != sha:
                            raise ValueError(f"{path}: the payload at {at} does not have the digest {sha}")
                        ref = found.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">") or None
                        rows.append((None if page == "null" else page, int(http["content-length"]), sha, kind, ref, found.get("warc-target-uri"), payload.decode() if payloads and kind == "response" else None))
                        size += len(payload)
                        if size >= 8 << 20:
                            yield pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")])
                            rows, size = [], 0
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")])

    return files.mapInPandas(run, READ)


def archive(pages: DataFrame, min_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Writes pages as monolithic archives, normalises these and reads the result back (READ, ids as bigint)."""
    spark, work = pages.sparkSession, Workspace(pages.sparkSession, "warc")
    raw = work.save(write_monolithic(pages, work.path + "/files", min_bytes), "raw")
    n = max(1, min(raw.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    members = work.save(normalise(raw.repartition(n), work.path + "/files"), "members")
    out = read_indexed(members.repartition(n), payloads)
    return out.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})
