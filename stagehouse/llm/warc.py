"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Pages become text lines whose separator is the end of a WARC record, so Spark's
text sink writes valid archives to any file system it knows. Of pages with equal
payloads the one with the largest id is stored, the others refer to it.

Pages are written by classes of size, each with its own number of records a file, so no
file exceeds ``FILE_BYTES`` but one that holds a single larger record.

The reader takes whole files (their size is bounded when they are written) of
plain records or of one gzip member per record. A record is accepted when its
version line, headers, length, end mark and payload digest hold. After a failed
check the reader looks for the next place where a valid record begins, goes on
there and logs the bytes between as a gap with the reason.

Defined cases: null html is an empty payload; a null url is an empty URI, and
line breaks and other controls in it are percent-encoded; a null page_id is the
smallest id; of repeated rows of one page all are responses if their id is the
largest of their payload, else all revisit; an empty table gives an archive without records; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm.common import read_table
from stagehouse.session import materialize, scratch_path

END = b"\r\n\r\n"
# Records of the smallest pages in a file; the next classes hold pages of up to four times the size each.
RECORDS_PER_FILE = 4000
FILE_BYTES = 128 << 20
# What a record has besides its url and payload, at most.
HEAD_BYTES = 1024
REVISIT_FROM = 0
VERSION = b"WARC/1."
MEMBER = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"


def _base32(digests: pd.Series) -> pd.Series:
    return pd.Series([base64.b32encode(bytes.fromhex(x)).decode() for x in digests], dtype=object)


def with_revisits(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, ``first`` (the response a revisit refers to) and ``revisit``."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", payload.alias("payload"))
    sha = F.sha1(F.col("payload").cast("binary"))
    base = base.withColumn("digest", F.pandas_udf(_base32, "string")(sha))
    shared = (
        base.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("pages"))
        .where("pages > 1")
        .select(F.col("digest").alias("_digest"), "first")
    )
    shared = materialize(shared, "shared-payloads")
    joined = base.join(shared, base["digest"] == shared["_digest"], "left").drop("_digest")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("revisit", other & (F.octet_length("payload") >= least))


def _header(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def records(marked: DataFrame) -> DataFrame:
    """One text per page: a WARC record without its end mark."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    uri = F.coalesce(F.col("url"), F.lit(""))
    for code in (*range(0x20), 0x7F):
        if code in (9, 10, 13):
            uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\n"),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length("payload").cast("string")),
        F.lit("\r\n"),
    )
    block = F.concat(http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _header("WARC-Record-ID", urn("page_id")),
        F.when(F.col("revisit"), _header("WARC-Refers-To", urn("first"))).otherwise(""),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", uri),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return marked.select(F.concat(head, block).alias("value"))


def _size_class(payload: str) -> F.Column:
    """How often the number of records a file must be quartered for records of this size."""
    length = lambda c: F.coalesce(F.octet_length(c).cast("long"), F.lit(0))
    # Controls of a url take three bytes.
    bulk = HEAD_BYTES + 3 * length("url") + length(payload)
    out, quarter = F.lit(0), 0
    while RECORDS_PER_FILE >> 2 * quarter:
        out = out + (bulk * RECORDS_PER_FILE > FILE_BYTES << 2 * quarter).cast("int")
        quarter += 1
    return out


def write_archives(pages: DataFrame, path: str, least: int = REVISIT_FROM) -> None:
    classes = sorted(r["size"] for r in pages.select(_size_class("html").alias("size")).distinct().collect())
    marked = with_revisits(pages, least)
    for number, size in enumerate(classes or [0]):
        mine = records(marked.where(_size_class("payload") == size) if len(classes) > 1 else marked)
        writer = mine.write.option("lineSep", END.decode())
        writer = writer.option("maxRecordsPerFile", max(1, RECORDS_PER_FILE >> 2 * size))
        writer.mode("append" if number else "overwrite").text(path)


class Damaged(ValueError):
    """A check of a record failed."""


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(data: bytes | memoryview, at: int) -> tuple[dict, int]:
    """The record that begins at ``at`` and where the next one begins."""
    if data[at : at + len(VERSION)] != VERSION:
        raise Damaged("version line")
    stop = data.find(END, at)
    if stop < 0:
        raise Damaged("headers")
    headers = _headers(data[at:stop])
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("length")
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != END:
        raise Damaged("end mark")
    block = data[begin:end]
    payload, http = block, {}
    if headers.get("content-type", "").startswith("application/http"):
        inner = block.find(END)
        if inner < 0:
            raise Damaged("http headers")
        http, payload = _headers(block[:inner]), block[inner + 4 :]
    kind = headers.get("warc-type", "")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if kind == "revisit":
        size = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
    elif digest:
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise Damaged("payload digest")
    else:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    record = {
        "record_type": kind,
        "record_id": headers.get("warc-record-id"),
        "refers_to": headers.get("warc-refers-to"),
        "uri": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if kind == "revisit" else payload,
    }
    return record, end + 4


def _parse_at(data: bytes, at: int) -> tuple[dict, int]:
    """A plain record or a gzip member that holds one."""
    if data[at : at + 3] != MEMBER:
        return parse_record(data, at)
    member = zlib.decompressobj(31)
    try:
        inside = member.decompress(memoryview(data)[at:])
    except zlib.error as error:
        raise Damaged("gzip member") from error
    if not member.eof:
        raise Damaged("gzip member cut off")
    record, end = parse_record(inside, 0)
    if end != len(inside):
        raise Damaged("bytes after the record in its member")
    return record, len(data) - len(member.unused_data)


def _candidates(data: bytes, at: int) -> Iterator[int]:
    """Places after ``at`` where a record may begin, in order."""
    line, member = data.find(VERSION, at), data.find(MEMBER, at)
    while line >= 0 or member >= 0:
        if member < 0 or 0 <= line < member:
            yield line
            line = data.find(VERSION, line + 1)
        else:
            yield member
            member = data.find(MEMBER, member + 1)


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict | None]]:
    """Records as (begin, end, None, record) and gaps as (begin, end, reason, None)."""
    at = 0
    while at < len(data):
        try:
            record, end = _parse_at(data, at)
        except Damaged as failed:
            reason, found = str(failed), None
            for place in _candidates(data, at + 1):
                try:
                    found = (place, *_parse_at(data, place))
                except Damaged:
                    continue
                break
            stop = found[0] if found else len(data)
            yield at, stop, reason, None
            if not found:
                return
            at, record, end = found
        yield at, end, None, record
        at = end


FIELDS = "file string, begin long, end long, gap string, record_type string, record_id string, refers_to string, uri string, payload_bytes long, payload_digest string, payload binary"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all files: a row with ``gap`` set is a quarantined run of bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["path"], frame["content"], strict=True):
                rows = []
                for begin, end, gap, record in salvage(bytes(data)):
                    row = {**dict.fromkeys(names), "file": name, "begin": begin, "end": end, "gap": gap, **(record or {})}
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                out = pd.DataFrame(rows, columns=names)
                out["payload_bytes"] = out["payload_bytes"].astype("Int64")
                yield out

    return files.select("path", "content").mapInPandas(read, FIELDS)


def _page(column: str):
    return F.regexp_extract(F.col(column), r"^<urn:page:(-?\d+)>$", 1)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    # A gap in what was just written is an error, not something to leave out.
    failed = F.raise_error(F.concat_ws(" ", F.lit("unreadable record in"), "file", "begin", "gap")).cast("boolean")
    found = read_archives(spark, path, payloads=False).where(F.when(F.col("gap").isNotNull(), failed).otherwise(F.lit(True)))
    number = lambda c: F.when(_page(c) != "", _page(c).cast("long"))
    return found.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", number("refers_to")).alias("refers_to"),
    )
