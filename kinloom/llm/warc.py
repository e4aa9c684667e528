"""WARC archives of pages: writing with revisits, reading by verified record boundaries.

Writing.  A record is header text, payload and an empty line, so Spark's text writer with
that line as separator writes an archive; each task writes files of a bounded number of
records, compressed as one stream.  Of equal payloads the record with the largest page_id
is the response, the others are revisits without payload that refer to it.

Reading.  The magic of a record may also stand inside a payload.  Tasks therefore report
every place that looks like a record as a candidate with the offset of its successor.
Per file, pointer jumping from offset 0 marks what the chain of successors reaches in
logarithmically many steps; all other candidates are rejected.  A chain that does not end
at the end of its file fails the job.  Offsets are those of the uncompressed stream.  Only (offset, successor) pairs of one file come together, never
contents.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from .common import map_arrow, with_package, written

FILE_RECORDS = 2000
END = "\r\n\r\n"
_MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
# Digits of number bases as Spark writes them, and those of RFC 4648.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """A SHA-1 in hexadecimal as RFC 4648 base32: five hexadecimal digits make four."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to).

    Payloads of at least ``least`` bytes are written once.  A null html is an empty
    payload.  A row without page_id is smaller than any other and can be referred to by
    none but its like; rows sharing page_id and payload are the same record, repeated.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("sha1"),
        F.xxhash64(payload).alias("check"),
    )
    groups = (
        rows.filter(F.col("payload_bytes") >= least).groupBy("sha1", "check")
        .agg(F.max("page_id").alias("keeper"), F.lit(True).alias("grouped"))
    )
    revisit = F.col("grouped").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(groups, ["sha1", "check"], "left").select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        base32(F.col("sha1")).alias("payload_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"),
    )


def _record_text() -> Column:
    revisit = F.col("record_type") == "revisit"
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), page("page_id")),
        # Control characters and spaces would break the header line.
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20\\x7F]", "%20")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), page("refers_to"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), F.when(revisit, F.lit("")).otherwise(F.col("payload")))


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    text = records(pages, least).select(_record_text().alias("value"))
    text.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def unpacked(content: bytes) -> bytes:
    """An archive's bytes; gzip members, one or many, are taken together."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        parts += [member.decompress(content), member.flush()]
        content = member.unused_data
    return b"".join(parts)


def candidates(data: bytes) -> Iterator[tuple[int, int, dict[str, str], int, int]]:
    """(offset, successor, header, block start, block end) of whatever looks like a whole record.

    A header may have any length.  Records start at offset 0 or after an empty line, so of
    several magics before the same header end only the first can start one; the headers
    that are looked at never overlap.
    """
    end = -1
    for magic in _MAGIC.finditer(data):
        if magic.end() - 2 <= end:
            continue
        end = data.find(b"\r\n\r\n", magic.end() - 2)
        if end < 0:
            return
        lines = data[magic.end() : end].decode("utf-8", "replace").split("\r\n")
        header = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = header.get("content-length", "")
        if not (length.isascii() and length.isdigit()) or len(length) > 15:
            continue
        start = end + 4
        stop = start + int(length)
        if data[stop : stop + 4] == b"\r\n\r\n":
            yield magic.start(), stop + 4, header, start, stop


_SCHEMA = (
    "file string, offset long, successor long, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, intact boolean"
)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The candidates of all archives below ``path`` with what their headers say.

    Each file also has one row for its end: offset and successor are its length, all else
    is null.  ``intact`` tells whether a response's block has the length and digest of its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("file", pa.string()), ("offset", pa.int64()), ("successor", pa.int64()), ("page_id", pa.int64()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
             ("refers_to", pa.int64()), ("intact", pa.bool_())]
        )
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = unpacked(content.as_py())
                rows = [_row(file, data, *c) for c in candidates(data)]
                rows.append({"file": file, "offset": len(data), "successor": len(data)})
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return map_arrow(files, run, _SCHEMA)


def _row(file: str, data: bytes, offset: int, successor: int, header: dict[str, str], start: int, stop: int) -> dict:
    number = lambda key: int(m[1]) if (m := re.fullmatch(r"(?:<urn:page:)?(-?\d+)>?", header.get(key, ""))) else None
    kind = header.get("warc-type", "")
    digest = header.get("warc-payload-digest", "").removeprefix("sha1:")
    size = number("warc-payload-length")
    real = base64.b32encode(hashlib.sha1(memoryview(data)[start:stop]).digest()).decode()
    return {
        "file": file,
        "offset": offset,
        "successor": successor,
        "page_id": number("warc-record-id"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("warc-refers-to"),
        "intact": kind == "revisit" or (size == stop - start and real == digest),
    }


def reached(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Which candidates of one file the chain from offset 0 reaches, by pointer jumping."""
    order = np.argsort(offsets)
    at = offsets[order]
    jump = np.searchsorted(at, successors[order])
    last = len(at)  # a successor that is no candidate ends the chain
    jump = np.where((jump < last) & (at[np.minimum(jump, last - 1)] == successors[order]), jump, last)
    jump = np.append(jump, last)
    mark = np.zeros(last + 1, bool)
    mark[0] = at[0] == 0
    for _ in range(int(last).bit_length()):
        mark[jump[mark]] = True
        jump = jump[jump]
    out = np.zeros(last, bool)
    out[order] = mark[:last]
    return out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, candidates inside payloads rejected.

    Fails if the records of a file do not fill it from its start to its end.
    """
    found = written(scan(spark, path), "warc-candidates")

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        offsets, successors = frame["offset"].to_numpy(), frame["successor"].to_numpy()
        mark, end = reached(offsets, successors), offsets == successors
        if not mark[end].all():
            raise ValueError(f"the records of {frame['file'].iloc[0]} do not end at its length of {offsets[end][0]} bytes")
        return frame.loc[mark & ~end, ["file", "offset"]]

    pairs = with_package(found.select("file", "offset", "successor")).groupBy("file")
    true = pairs.applyInPandas(chain, "file string, offset long")
    return found.join(true, ["file", "offset"], "left_semi")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per row of ``pages``, as read back."""
    path = new_folder(pages.sparkSession, "warc")
    write_archives(pages, path, least)
    rows = read_archives(pages.sparkSession, path)
    intact = F.when(F.col("intact"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload was damaged")))
    return rows.select("page_id", "payload_bytes", intact.alias("payload_digest"), "record_type", "refers_to")
