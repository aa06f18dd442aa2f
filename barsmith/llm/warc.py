"""WARC archives with an index: write records, note where they are, read back only what is selected.

Every record is a gzip member of its own. The index has file, offset, length, URL, digest and type of
every record. Reading sorts the selected index rows by file and offset, joins byte ranges that lie
close together into one read, and cuts the members out of it.

Files go through a filesystem URI, so the folder may be any store that the workers reach. A task
attempt writes files of its own name; the index names the files of attempts that finished, so a lost
executor leaves at most files that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm import words

FILE_BYTES = 256 << 20   # a file is closed beyond this size
RANGE_BYTES = 8 << 20    # a joined read has at most this size, unless one record is larger
GAP_BYTES = 64 << 10     # ranges this close are read together
TASK_BYTES = 32 << 20    # one group of index rows covers so much of a file

_INDEX = ("file string, offset long, length long, url string, payload_digest string, record_type string, "
          "page_id long, refers_to long")
_INDEX_KIND = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                         ("payload_digest", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                         ("refers_to", pa.int64())])


def digest(payload: bytes) -> str:
    """Base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str | None) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def record(page_id: int | None, url: str | None, payload: bytes, own_digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record that has the HTTP header without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {_clean(url)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{own_digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload of a record."""
    def fields(text: bytes) -> dict[str, str]:
        return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                    for line in text.decode().split("\r\n")[1:])

    head, rest = raw.split(b"\r\n\r\n", 1)
    warc = fields(head)
    block = rest[: int(warc["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return warc, fields(http), payload


def _number(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if urn and urn != "<urn:page:>" else None


def address(path: str) -> str:
    """The path as Arrow names it; s3a and s3n are Hadoop's names of s3."""
    scheme, sep, rest = path.partition("://")
    return f"s3{sep}{rest}" if scheme in ("s3a", "s3n") else path


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least_bytes: int = 0) -> DataFrame:
    """Write a record per row below the folder and return the index, itself a table of the shared folder.

    Of rows with equal payloads of at least least_bytes bytes, the one with the largest id is a
    response and the others are revisits of it; shorter payloads are all responses. A null html is an
    empty payload, a null url an empty one. Rows that repeat the largest id are all responses. A row
    without id revisits like others, but is never referred to: payloads without any id are responses.
    """
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")) \
        .withColumn("sha", F.sha1(F.col("html").cast("binary")))
    thin = own.select("page_id", "sha", F.octet_length("html").alias("bytes")).where(F.col("bytes") >= least_bytes)
    first = thin.groupBy("sha", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")) \
        .where("n > 1 AND refers_to IS NOT NULL").select("sha", "refers_to")
    # By page: a payload that very many pages share is met by the thin side only.
    copies = thin.select("page_id", "sha").join(first, "sha").where("NOT page_id <=> refers_to") \
        .select(F.col("page_id").alias("copy"), F.col("sha").alias("copy_sha"), "refers_to").distinct()
    same = F.col("page_id").eqNullSafe(F.col("copy")) & (F.col("sha") == F.col("copy_sha"))
    ready = own.join(copies, same, "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(address(folder))
        store.create_dir(path, recursive=True)
        out, name, offset, rows = None, "", 0, []
        try:
            for batch in words.slices(batches):
                for page, url, html, refers in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    payload = html.encode()
                    mark = digest(payload)
                    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = pack.compress(record(page, url, payload, mark, refers)) + pack.flush()
                    out.write(member)
                    rows.append((f"{folder}/{name}", offset, len(member), url, mark,
                                 "response" if refers is None else "revisit", page, refers))
                    offset += len(member)
                    if offset >= FILE_BYTES:
                        out.close()
                        out = None
                if out is not None:
                    out.flush()
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k.type) for c, k in zip(zip(*rows), _INDEX_KIND)], schema=_INDEX_KIND)
                    rows = []
        finally:
            if out is not None:
                out.close()

    return session.materialize(ready.mapInArrow(run, _INDEX), "warc-index")


def ranges(rows: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Start, end and row numbers of joined reads over (offset, length) rows sorted by offset."""
    start = end = -1
    members: list[int] = []
    for i, (offset, length) in enumerate(rows):
        if members and (offset - end > GAP_BYTES or offset + length - start > RANGE_BYTES):
            yield start, end, members
            members = []
        if not members:
            start = end = offset
        members.append(i)
        end = max(end, offset + length)
    if members:
        yield start, end, members


def read(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the selected index rows: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for revisits and if not asked for).

    Size and digest of a response are taken from the payload read, those of a revisit from its headers.
    An index row that is listed several times is read several times.
    """
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, payload binary")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("offset", kind="stable")
        store, path = fs.FileSystem.from_uri(address(group["file"].iloc[0]))
        places = list(zip(group["offset"].tolist(), group["length"].tolist()))
        out = []
        with store.open_input_file(path) as source:
            for start, end, members in ranges(places):
                source.seek(start)
                raw = source.read(end - start)
                for i in members:
                    offset, length = places[i]
                    warc, http, payload = parse(zlib.decompress(raw[offset - start : offset - start + length], 31))
                    response = warc["WARC-Type"] == "response"
                    out.append((
                        _number(warc["WARC-Record-ID"]), warc["WARC-Target-URI"],
                        len(payload) if response else int(http["Content-Length"]),
                        digest(payload) if response else warc["WARC-Payload-Digest"].removeprefix("sha1:"),
                        warc["WARC-Type"], _number(warc.get("WARC-Refers-To")),
                        payload if response and with_payload else None))
        made = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
        return made.astype({"page_id": "Int64", "refers_to": "Int64"})

    # As many partitions as the bytes to read ask for; the rows of the index alone are few.
    size = index.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0
    return index.select("file", "offset", "length", F.floor(F.col("offset") / TASK_BYTES).alias("part")) \
        .repartition(2 * math.ceil(size / TASK_BYTES) + 1, "file", "part") \
        .groupBy("file", "part").applyInPandas(lambda group: run(group), schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives below the shared folder."""
    return session.scratch(spark, "warc")
