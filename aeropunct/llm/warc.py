"""Web archives: records written with an index, then read back by byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropunct.llm.common import Scratch

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
IDENTICAL = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"
# Ranges closer than the gap are read at once, up to the block size.
READ_GAP, READ_BLOCK = 64 << 10, 8 << 20
# Records of an archive file are rolled over to the next file beyond this size.
ARCHIVE_BYTES = 1 << 30

INDEX = (
    "archive string, offset long, length long, url string, digest string, "
    "page_id long, record_type string, refers_to long"
)


def _number(value: str | None) -> int | None:
    """Ids travel as text: pandas would turn whole numbers with nulls into floats."""
    return None if value is None else int(value)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_uri(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"none" if page_id is None else b"%d" % page_id)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record as a gzip member of its own; a revisit (``first`` given) has no payload.

    The HTTP header of a revisit keeps the length of the payload it stands for.
    """
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if first is None else b"")
    # A header line cannot hold line ends; a null address has no line.
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A").encode()
    lines = [
        b"WARC-Type: " + (b"response" if first is None else b"revisit"),
        b"WARC-Record-ID: <urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {digest} {url}")).encode(),
        b"WARC-Date: " + DATE,
        b"WARC-Concurrent-To: " + _page_uri(page_id),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + target)
    if first is not None:
        lines += [b"WARC-Profile: " + IDENTICAL, b"WARC-Refers-To: " + _page_uri(first)]
    whole = VERSION + b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(whole) + member.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, HTTP header and payload of one record."""
    head, _, rest = data.removeprefix(VERSION).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def _writer(root: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        stream, archive, offset = None, "", 0
        try:
            for pages in batches:
                rows = []
                for page_id, url, html, revisit, first in pages.itertuples(index=False):
                    payload = b"" if html is None else html.encode()
                    digest = payload_digest(payload)
                    refers = _number(first) if revisit else None
                    data = record(_number(page_id), url, payload, digest, refers)
                    if stream is None or offset > ARCHIVE_BYTES:
                        if stream:
                            stream.close()
                        # A task that runs twice writes files of its own; only the files
                        # of the run whose index rows Spark keeps are ever read.
                        archive = f"{uuid.uuid4().hex}.warc.gz"
                        stream, offset = store.open_output_stream(f"{base}/{archive}", compression=None), 0
                    stream.write(data)
                    kind = "revisit" if refers is not None else "response"
                    rows.append((archive, offset, len(data), url, digest, _number(page_id), kind, refers))
                    offset += len(data)
                yield _frame(rows, INDEX)
        finally:
            if stream:
                stream.close()

    return write


def _frame(rows: list[tuple], ddl: str) -> pd.DataFrame:
    columns = [part.split()[0] for part in ddl.split(", ")]
    kinds = {part.split()[0]: part.split()[1] for part in ddl.split(", ")}
    frame = pd.DataFrame(rows, columns=columns, dtype=object)
    return frame.astype({c: "Int64" for c in columns if kinds[c] == "long"})


def write_archives(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """Writes a record a row of ``pages(page_id, url, html)`` and returns the index.

    Digests are counted first, from narrow rows; the pages themselves move once, to
    their own revisit marks. Of equal payloads the smallest page id is the response,
    so rows without an id are revisits unless no row of that payload has one. Rows
    that repeat the smallest id are responses too.
    """
    payload = F.coalesce("html", F.lit(""))
    narrow = pages.select("page_id", F.sha1(payload.cast("binary")).alias("sha"))
    groups = scratch.keep(
        narrow.groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("sha", "first"),
        "groups",
    )
    again = scratch.keep(
        narrow.join(groups, "sha").filter("page_id IS NULL OR page_id > first").distinct(), "again"
    )
    # Rows without an id are told apart by their payload, others by their id first.
    key = F.coalesce(F.col("page_id").cast("string"), F.col("sha"))
    marks = again.select(key.alias("key"), "sha", "first", F.lit(True).alias("revisit"))
    rows = (
        pages.select("page_id", "url", "html", F.sha1(payload.cast("binary")).alias("sha"))
        .withColumn("key", key)
        .join(marks, ["key", "sha"], "left")
        .select(
            F.col("page_id").cast("string"),
            "url",
            "html",
            F.coalesce("revisit", F.lit(False)).alias("revisit"),
            F.col("first").cast("string"),
        )
    )
    root = scratch.path("archives")
    return scratch.keep(rows.mapInPandas(_writer(root), INDEX), "index").withColumn(
        "root", F.lit(root)
    )


RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long"
)


def _ranges(index: pd.DataFrame) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Archive, begin, end and records of each range that is read at once."""
    ordered = index.sort_values(["root", "archive", "offset"])
    path, begin, end, records = "", 0, 0, []
    for root, archive, offset, length in ordered[["root", "archive", "offset", "length"]].itertuples(index=False):
        here = f"{root}/{archive}"
        if here != path or offset - end > READ_GAP or offset + length - begin > READ_BLOCK:
            if records:
                yield path, begin, end, records
            path, begin, end, records = here, offset, offset, []
        records.append((offset, length))
        end = max(end, offset + length)
    if records:
        yield path, begin, end, records


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for index in batches:
        rows = []
        for path, begin, end, records in _ranges(index):
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as source:
                source.seek(begin)
                data = source.read(end - begin)
            for offset, length in records:
                member = data[offset - begin : offset - begin + length]
                fields, http, payload = parse(zlib.decompress(member, 31))
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(http.decode().rpartition("Content-Length: ")[2].split("\r\n")[0])
                if kind == "response" and (payload_digest(payload) != digest or len(payload) != size):
                    raise ValueError(f"damaged record at {path}:{offset}")
                refers = _page(fields.get("WARC-Refers-To"))
                page_id = _page(fields["WARC-Concurrent-To"])
                url = fields.get("WARC-Target-URI")
                rows.append((page_id, url, size, digest, kind, refers))
        yield _frame(rows, RECORDS)


def read_records(selected: DataFrame) -> DataFrame:
    """Reads the selected index rows: sorted ranges of each archive, near ones at once.

    Payloads are checked against their digests; a record that differs stops the job.
    """
    parts = max(1, int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = selected.repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    return ordered.mapInPandas(_read, RECORDS)


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Every page written to archives and read back through the index.

    Returns page_id, url, payload_bytes, payload_digest, record_type, refers_to. Null
    html is an empty payload; all empty payloads are equal. Null addresses stay null.
    Rows may repeat; columns beyond page_id, url and html are not read. Archive files
    and index lie in the shared folder, opened by its scheme (file, s3, gs, hdfs).
    """
    scratch = Scratch(spark, "warc")
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return read_records(write_archives(narrow, scratch))
