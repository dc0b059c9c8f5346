"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing: every task appends gzip members (one per record, the usual ``.warc.gz`` layout) to files of
its own in the archive folder and returns one index row per record: file, offset, length, URL and
digest. Spark commits the index as a Parquet table. A file that a lost or repeated task left behind
is in no index row and is never read, so the archive is whole whenever the index is.

Revisits: payload digests are counted in a narrow pass (digest, smallest page_id; combined in the map
tasks). Only digests that occur more than once are joined back, and only those rows look them up.

Reading: the selected index rows are sorted by file and offset; neighbouring records merge into one
read while the gap and the range stay below their limits.

Defined results: a null html is an empty payload and counts for revisits like any other; a null URL
gives a record without a target URI; rows repeating the smallest page_id of a payload are all
responses; null page_ids are never the response of another page; an empty table gives no records. Very
long pages are records like others (one record is held in memory at a time).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpina.llm.common import staged
from alpina.session import scratch_path

VERSION = b"WARC/1.1\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 256 << 20
MERGE_GAP = 64 << 10
TASK_BYTES = 32 << 20  # of archive that a reading task gets
MERGE_BYTES = 8 << 20
INDEX_SCHEMA = ("file string, offset long, length long, url string, payload_digest string, page_id long, "
                "record_type string, refers_to long")
PAGE_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, payload binary")


def _filesystem(uri: str):
    """(file system, path) of a folder on shared storage; local paths, file://, s3://, gs://, hdfs://."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else "file://" + uri)


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _header(fields: list[tuple[str, object]]) -> bytes:
    clean = ((k, "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(v)) if k.endswith("URI") else v)
             for k, v in fields)
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in clean)


def make_record(page_id, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One response or revisit record; a revisit has the HTTP header only."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {len(payload)}\r\n\r\n".encode())
    block = http if revisit else http + payload
    fields: list[tuple[str, object]] = [("WARC-Type", "revisit" if revisit else "response"),
                                        ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    fields += [("X-Page-Id", "" if page_id is None else page_id), ("X-Refers-To-Page", "" if refers_to is None else refers_to),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return VERSION + _header(fields) + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC header, HTTP header, payload) of one record."""
    if not raw.startswith(VERSION):
        raise ValueError("not a WARC record")
    head, _, rest = raw[len(VERSION):].partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[:int(warc["content-length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record length does not fit its header")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _fields(http.partition(b"\r\n")[2]), payload


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n") if x)}


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _roles(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) with ``refers_to``: the response's page_id for revisits, else null."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha"))
    repeated = staged(keyed.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                      .filter("n > 1 AND first IS NOT NULL").select("sha", "first"), "warc-repeated")
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (keyed.join(repeated, "sha", "left")
            .select("page_id", "url", F.when(later, F.col("first")).alias("refers_to"), "html"))


def write_archive(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write one record per row of ``pages`` (page_id, url, html); returns the folder and its index."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _filesystem(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, refers_to, html in zip(*(batch[c].tolist() for c in ("page_id", "url", "refers_to", "html")), strict=True):
                page_id, refers_to = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                url = url if isinstance(url, str) else None
                payload = html.encode()
                digest, revisit = digest32(payload), refers_to is not None
                member = gzip.compress(make_record(page_id, url, payload, digest, refers_to, revisit), 6, mtime=0)
                if out is None or at + len(member) > FILE_BYTES and at:
                    if out is not None:
                        out.close()
                    fs.create_dir(root, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                out.write(member)
                rows.append((name, at, len(member), url, digest, page_id, "revisit" if revisit else "response", refers_to))
                at += len(member)
            frame = pd.DataFrame(rows, columns=[x.split()[0] for x in INDEX_SCHEMA.split(", ")])
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})
        if out is not None:
            out.close()

    index = _roles(pages).mapInPandas(write, INDEX_SCHEMA)
    return folder, staged(index, "warc-index")


def merged_ranges(spans: list[tuple[int, int]], gap: int = MERGE_GAP, most: int = MERGE_BYTES) -> list[tuple[int, int, int]]:
    """(first span, last span + 1, end offset) of each read over sorted (offset, length) spans."""
    out: list[tuple[int, int, int]] = []
    for i, (offset, length) in enumerate(spans):
        if out:
            first, _, end = out[-1]
            if offset - end <= gap and offset + length - spans[first][0] <= most:
                out[-1] = (first, i + 1, max(end, offset + length))
                continue
        out.append((i, i + 1, offset + length))
    return out


def read_records(folder: str, selected: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """The records of the ``selected`` index rows, parsed; every response's payload is checked
    against its digest. A revisit's ``payload_bytes`` is the length its HTTP header keeps."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _filesystem(folder)
        for batch in batches:
            rows = []
            for name, part in batch.groupby("file", sort=False):
                spans = sorted(zip(part["offset"].tolist(), part["length"].tolist(), strict=True))
                with fs.open_input_file(f"{root}/{name}") as f:
                    for first, last, end in merged_ranges(spans):
                        start = spans[first][0]
                        chunk = f.read_at(end - start, start)
                        for offset, length in spans[first:last]:
                            rows.append(_page(gzip.decompress(chunk[offset - start:offset - start + length]), with_payload))
            frame = pd.DataFrame(rows, columns=[x.split()[0] for x in PAGE_SCHEMA.split(", ")])
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    places = selected.select("file", "offset", "length")
    total = selected.agg(F.sum("length")).first()[0] or 0
    # the number follows the archives' bytes: the index rows are far too small to judge the work by
    tasks = max(1, -(-total // TASK_BYTES))
    return places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInPandas(read, PAGE_SCHEMA)


def _page(raw: bytes, with_payload: bool) -> tuple:
    warc, http, payload = parse_record(raw)
    digest, kind = warc["warc-payload-digest"].removeprefix("sha1:"), warc["warc-type"]
    if kind == "response" and digest32(payload) != digest:
        raise ValueError(f"payload of {warc['warc-record-id']} does not fit its digest")
    page, refers = (int(warc[k]) if warc[k] else None for k in ("x-page-id", "x-refers-to-page"))
    return (page, warc.get("warc-target-uri"), int(http["content-length"]), digest, kind, refers,
            payload if with_payload and kind == "response" else None)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read every record back through the index: one row per page."""
    folder, index = write_archive(pages.select("page_id", "url", "html"))
    return read_records(folder, index, with_payload=False).drop("payload", "url")
