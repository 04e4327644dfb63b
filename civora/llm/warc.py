"""WARC archives of web pages with a two-level capture index.

Writing: every task appends gzip-compressed records to archive files of its
own in the shared folder and reports one capture row per record. Records whose
payloads of at least ``REVISIT_BYTES`` are equal are stored once; the others
are revisit records that name the stored one.

Index: captures are sorted by reversed host and path (a range-partitioned
sort), cut into blocks that are compressed and written one after the other, and
a sparse directory keeps each block's first key and place. Lines per block grow
with the captures so that the directory never exceeds ``DIRECTORY_ENTRIES``
rows; it is the only thing that is held whole.

Reading: a request's key is searched by bisection in the directory, the block
is fetched by a range read, searched by bisection again, and the record is
fetched by a range read from its archive.

A task that is run again writes new files under new names. Only files that a
finished task has reported are ever read, so lost executors leave nothing but
unused files behind.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civora.llm.common import partitions, record_batch, shared_path, shared_table

REVISIT_BYTES = 1000
BLOCK_LINES = 3000
DIRECTORY_ENTRIES = 100_000
ARCHIVE_BYTES = 1 << 30
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

_CAPTURES = ("key string, page_id long, file string, offset long, length long")
_DIRECTORY = "first string, last string, file string, offset long, length long, lines long"
_RECORDS = ("page_id long, url string, record_type string, payload binary, payload_bytes long, "
            "payload_digest string, refers_to long")


def store(uri: str):
    """File system and path of a folder named by URI (local, HDFS, S3, GCS)."""
    from pyarrow import fs
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def url_key(url: str | None) -> str:
    """Reversed-host key: https://www.a.org:80/p?q -> org,a,www)/p?q ('' for null)."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower()
    except ValueError:
        return url
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + rest


def _line_key(url: str | None, page_id: int | None) -> str:
    """Sort key of a capture; pages whose urls differ in scheme, port, user or fragment only may share it."""
    key = re.sub(r"[\x00-\x20\x7f\\]", lambda m: "%%%02X" % ord(m.group()), url_key(url))
    return f"{key} {'-' if page_id is None else page_id}"


def _header_value(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m.group()), value)


def record(page_id, url, payload: bytes, original) -> bytes:
    """One WARC/1.0 record: a response, or a revisit of the page ``original``."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if original is not None else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'response' if original is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if original is not None:
        head += [f"WARC-Refers-To: <urn:page:{original}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.0":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit its content")
    page = lambda name: int(x) if (x := fields.get(name, "")[len("<urn:page:"):-1]) else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    out = {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"),
           "record_type": fields["WARC-Type"], "payload": None, "payload_digest": digest,
           "payload_bytes": int(fields["X-Payload-Length"]), "refers_to": None}
    if out["record_type"] == "response":
        out["payload"] = block.partition(b"\r\n\r\n")[2]
        out["payload_bytes"] = len(out["payload"])
        if hashlib.sha1(out["payload"]).hexdigest() != digest:
            raise ValueError(f"payload of page {out['page_id']} does not have its digest")
    else:
        out["refers_to"] = page("WARC-Refers-To")
    return out


class _Appender:
    """Appends byte strings to files of one task; tells file, offset and length."""

    def __init__(self, folder: str, suffix: str, limit: int, opening: bytes = b""):
        self.fs, self.base = store(folder)
        self.suffix, self.limit, self.opening, self.out, self.at = suffix, limit, opening, None, 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is not None and self.at + len(data) > self.limit:
            self.close()
        if self.out is None:
            self.fs.create_dir(self.base, recursive=True)
            self.name = uuid.uuid4().hex + self.suffix
            self.out = self.fs.open_output_stream(f"{self.base}/{self.name}", compression=None)
            self.out.write(self.opening)
            self.at = len(self.opening)
        place = (self.name, self.at, len(data))
        self.out.write(data)
        self.at += len(data)
        return place

    def close(self):
        if self.out is not None:
            self.out.close()
            self.out = None


class _Reader:
    """Range reads with a few open files."""

    def __init__(self, folder: str):
        self.fs, self.base = store(folder)
        self.open = {}

    def get(self, name: str, offset: int, length: int) -> bytes:
        f = self.open.get(name)
        if f is None:
            if len(self.open) >= 32:
                self.open.pop(next(iter(self.open))).close()
            f = self.open[name] = self.fs.open_input_file(f"{self.base}/{name}")
        return f.read_at(length, offset)

    def close(self):
        for f in self.open.values():
            f.close()


def _warcinfo() -> bytes:
    body = b"format: WARC File Format 1.0\r\n"
    head = (f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n")
    return gzip.compress(head.encode() + body + b"\r\n\r\n", 6, mtime=0)


def revisits(pages: DataFrame) -> DataFrame:
    """``pages`` with _original: the page whose equal payload is stored instead, or null."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("_payload"), F.sha1(payload).alias("_digest"))
    same = (pages.select("page_id", F.sha1(payload).alias("_digest"))
            .where(F.octet_length(payload) >= REVISIT_BYTES)
            .groupBy("_digest").agg(F.max("page_id").alias("_largest"), F.count(F.lit(1)).alias("_n"))
            .where("_n > 1").drop("_n"))
    original = F.when(~F.col("page_id").eqNullSafe(F.col("_largest")), F.col("_largest"))
    return rows.join(same, "_digest", "left").select("page_id", "url", "_payload", original.alias("_original"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per page under ``folder``; returns the captures (a stored table)."""

    def run(batches):
        out, rows = _Appender(folder, ".warc.gz", ARCHIVE_BYTES, _warcinfo()), []
        try:
            for b in batches:
                for page_id, url, payload, original in zip(*(b.column(i) for i in range(4))):
                    page_id, url = page_id.as_py(), url.as_py()
                    data = record(page_id, url, payload.as_py(), original.as_py())
                    rows.append((_line_key(url, page_id), page_id, *out.add(gzip.compress(data, 5, mtime=0))))
                    if len(rows) >= 2000:
                        yield record_batch(rows, _CAPTURES)
                        rows = []
        finally:
            out.close()  # before the last rows leave: what is reported is on disk
        if rows:
            yield record_batch(rows, _CAPTURES)

    return shared_table(revisits(pages).mapInArrow(run, _CAPTURES), "warc-captures")


def build_index(captures: DataFrame, folder: str, entries: int = DIRECTORY_ENTRIES) -> DataFrame:
    """Sorted, compressed blocks under ``folder``; returns the sparse directory (a stored table).

    Every sorted partition may end with a short block, so blocks hold at least
    twice the captures divided by ``entries`` and partitions stay below half of it.
    """
    lines = max(BLOCK_LINES, -(-2 * captures.count() // entries))
    n = min(partitions(captures.sparkSession), entries // 2)

    def run(batches):
        out, block, rows = _Appender(folder, ".cdx.gz", ARCHIVE_BYTES), [], []

        def flush():
            text = "\n".join(block).encode()
            place = out.add(gzip.compress(text, 6, mtime=0))
            rows.append((block[0].split("\t", 1)[0], block[-1].split("\t", 1)[0], *place, len(block)))
            block.clear()

        try:
            for b in batches:
                for r in b.to_pylist():
                    block.append("\t".join((r["key"], json.dumps([r["file"], r["offset"], r["length"]]))))
                    if len(block) >= lines:
                        flush()
            if block:
                flush()
        finally:
            out.close()
        if rows:
            yield record_batch(rows, _DIRECTORY)

    # the page number splits a key that many captures share
    placed = captures.repartitionByRange(n, "key").sortWithinPartitions("key")
    return shared_table(placed.mapInArrow(run, _DIRECTORY), "warc-directory")


def look_up(requests: DataFrame, directory: DataFrame, index_folder: str, archive_folder: str,
            with_payload: bool = False) -> DataFrame:
    """Records of the requested (page_id, url) pairs, read back through the index.

    A request finds every capture under its key (page_id and url without
    scheme, port, user and fragment). However many requests name a key, each
    of its captures is given once; an unknown key gives none.
    """
    spark = requests.sparkSession
    blocks = sorted(tuple(r) for r in directory.select("first", "last", "file", "offset", "length").collect())
    held = spark.sparkContext.broadcast(blocks)  # at most DIRECTORY_ENTRIES rows

    def locate(batches):
        lasts = [b[1] for b in held.value]
        for b in batches:
            rows = []
            for page_id, url in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                key = _line_key(url, page_id)
                i = bisect.bisect_left(lasts, key)  # first block that may hold the key
                while i < len(lasts) and held.value[i][0] <= key:
                    rows.append((i, key))
                    i += 1
            if rows:
                yield record_batch(rows, "block long, key string")

    def fetch(batches):
        index, archive = _Reader(index_folder), _Reader(archive_folder)
        now, lines, rows, size = None, [], [], 0
        try:
            for b in batches:
                for block, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if block != now:
                        now = block
                        lines = zlib.decompress(index.get(*held.value[block][2:]), 31).decode().split("\n")
                    i = bisect.bisect_left(lines, key + "\t")
                    while i < len(lines) and lines[i].startswith(key + "\t"):
                        r = parse(zlib.decompress(archive.get(*json.loads(lines[i].split("\t", 1)[1])), 31))
                        size += r["payload_bytes"] if with_payload else 0
                        rows.append((r["page_id"], r["url"], r["record_type"], r["payload"] if with_payload else None,
                                     r["payload_bytes"], r["payload_digest"], r["refers_to"]))
                        i += 1
                    if len(rows) >= 2000 or size > 1 << 24:
                        yield record_batch(rows, _RECORDS)
                        rows, size = [], 0
            if rows:
                yield record_batch(rows, _RECORDS)
        finally:
            index.close()
            archive.close()

    return (requests.select("page_id", "url").distinct().mapInArrow(locate, "block long, key string")
            .repartition(partitions(spark), "block").dropDuplicates(["block", "key"]).sortWithinPartitions("block", "key")
            .mapInArrow(fetch, _RECORDS))


def round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Archive all pages, index the captures, read every record back through the index.

    A null html is an empty payload, a null url a record without a target; a
    null page_id is stored and read back as null and is never the stored copy.
    Rows that repeat the largest page_id of an equal payload are all stored as
    responses. Other columns are ignored; an empty table gives no rows.
    """
    pages = pages.select("page_id", "url", "html")
    folder = shared_path(pages.sparkSession, "warc")
    directory = build_index(write(pages, f"{folder}/archives"), f"{folder}/index")
    return look_up(pages, directory, f"{folder}/index", f"{folder}/archives", with_payload)
