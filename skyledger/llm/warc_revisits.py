"""WARC archives with revisit records: duplicates of a payload point at one response.

Headers alone (digest, length, page id) are shuffled to find, for each payload of at least
``min_bytes``, the largest page id; the pages then meet that short list by digest and are written by the
tasks that hold them, one gzip member per record. Reading back parses the archives and joins each
revisit to the response it names.

A missing html is an empty payload; a missing page id is the smallest; a missing url is written as
``urn:missing``. Pages that repeat both id and payload are all responses, as none is a copy of another
page. One payload may hold any share of the pages: the list of digests is combined before its shuffle,
and Spark broadcasts the list or splits the skewed join, by size. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import column_of, open_shared, publish_file, scratch_dir, settle, texts_of

MIN_BYTES = 1000
DATE = "2025-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the registered namespace for URLs


def payload_headers(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its SHA-1 in hex and its bytes; computed in the scan, nothing moves."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"),
    )


def originals(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Digests that several pages share, with the page that stays a response."""
    return (
        payload_headers(pages).where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1")
        .select("digest", "original")
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, date: str) -> bytes:
    """One record as a gzip member; ``original`` names the page a revisit refers to."""
    revisit = original is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    sha = "sha1:" + b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;()@*[]') if url else 'urn:missing'}",
        f"WARC-Payload-Digest: {sha}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(original, digest)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> DataFrame:
    """Writes one archive per task into the shared ``folder``; returns (file, records), settled."""
    shared = originals(pages, min_bytes)
    rows = payload_headers(pages).join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("original") > F.coalesce(F.col("page_id"), F.lit(-(1 << 63))), F.col("original")).alias("refers"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0

        def members() -> Iterator[bytes]:
            nonlocal written
            for batch in batches:
                ids, urls = column_of(batch, "page_id").to_pylist(), column_of(batch, "url").to_pylist()
                digests, refers = column_of(batch, "digest").to_pylist(), column_of(batch, "refers").to_pylist()
                for row in zip(ids, urls, texts_of(batch, "payload"), digests, refers):
                    written += 1
                    yield record(*row, date)

        records = members()
        first = next(records, None)
        if first is None:
            return
        name = publish_file(folder, "pages.warc.gz", _with_first(first, records))
        yield pa.RecordBatch.from_pydict({"file": [name], "records": [written]})

    return settle(rows.mapInArrow(run, "file string, records long"), "warc-files")


def _with_first(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def members_of(folder: str, name: str) -> Iterator[bytes]:
    """The records of an archive, inflated one at a time."""
    with open_shared(folder, name) as source:
        inflate, parts = zlib.decompressobj(31), []
        while data := source.read(1 << 20):
            data = bytes(data)
            while data:
                parts.append(inflate.decompress(data))
                if not inflate.eof:
                    break
                yield b"".join(parts)
                data, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
        if any(parts):
            raise ValueError(f"{name} ends inside a record")


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """WARC headers (lower-case names) and the payload after the HTTP headers."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {key.lower(): value for key, _, value in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if len(rest) != len(block) + 4:
        raise ValueError("a record's length is wrong")
    return headers, block.partition(b"\r\n\r\n")[2]


READ = "page_id long, record_type string, payload_bytes long, payload_digest string, id string, refers string"


def read_archives(files: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """One row per record; bytes and digest of responses are taken from the payload that was read.

    A revisit has no payload of its own: its bytes are null until it is resolved.
    """
    names = [part.split()[0] for part in READ.split(", ")]

    def rows(name: str) -> Iterator[tuple]:
        for member in members_of(folder, name):
            headers, payload = parse_record(member)
            page = headers["warc-page-id"]
            common = (int(page) if page else None, headers["warc-type"])
            if headers["warc-type"] == "revisit":
                digest = _hex(headers["warc-payload-digest"])
                yield *common, None, digest, headers["warc-record-id"], headers["warc-refers-to"]
            else:
                digest = hashlib.sha1(payload).hexdigest()
                if digest != _hex(headers["warc-payload-digest"]):
                    raise ValueError(f"{name}: a payload differs from its digest")
                yield *common, len(payload), digest, headers["warc-record-id"], None

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in column_of(batch, "file").to_pylist():
                held = []
                for row in rows(name):
                    held.append(row)
                    if len(held) == 10_000:
                        yield _batch(held, kinds, names)
                        held = []
                if held:
                    yield _batch(held, kinds, names)

    # One task per archive: the names are too few bytes for adaptive execution to keep them apart.
    return files.select("file").repartition(tasks or max(1, files.count())).mapInArrow(run, READ)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _hex(digest: str) -> str:
    from base64 import b32decode

    return b32decode(digest.removeprefix("sha1:")).hex()


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Joins each revisit to the response it names: (page_id, payload_bytes, payload_digest, record_type,
    refers_to). A revisit whose response is missing keeps a null ``payload_bytes``."""
    found = records.where("record_type = 'response'").groupBy("id").agg(
        F.max("page_id").alias("original"), F.max("payload_bytes").alias("original_bytes")
    )
    revisits = records.where("record_type = 'revisit'").join(found.withColumnRenamed("id", "refers"), "refers", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = records.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return responses.select(*columns).unionByName(
        revisits.select(
            "page_id", F.col("original_bytes").alias("payload_bytes"), "payload_digest", "record_type",
            F.col("original").alias("refers_to"),
        )
    )


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES, date: str = DATE) -> DataFrame:
    """Writes all pages and reads the archives back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    files = write_archives(pages, folder, min_bytes, date)
    return resolve_revisits(settle(read_archives(files, folder), "warc-records"))
