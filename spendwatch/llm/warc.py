"""WARC archives: writing, and reading by boundary-chain verification.

Writing: one record per page.  Pages with equal payloads of at least
``least_revisit`` bytes share one response record, that of the largest page_id;
the others become revisit records without a payload.  An archive holds the
records of one task, at most RECORDS_PER_ARCHIVE, and is compressed as a whole;
the reader takes plain archives too.  Offsets are those of the plain bytes.

Reading: a task looks for the record magic anywhere in an archive and emits a
candidate with the offset of its successor, computed from its own
Content-Length.  Magic inside a payload gives candidates too, but nothing
leads to them: pointer jumping from offset 0 (log n doublings over the
archive's candidate offsets) retains what is reachable.  Only offsets and
header fields are grouped by archive, no payloads.

Defined cases: null html is an empty payload; a null url has no target header;
line ends in a url are percent-encoded; repeated rows are repeated records
(rows that share the largest page_id of a payload are all responses); a null
page_id has the id "null" and is read back as null; an archive whose first byte
is no record yields nothing, and a chain ends at the first broken record.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.llm.common import empty_if_null, grouped, trimmed
from spendwatch.session import scratch_path

LEAST_REVISIT = 1000
RECORDS_PER_ARCHIVE = 4096
MAGIC = b"WARC/1.0\r\n"
DATE = "1970-01-01T00:00:00Z"


def decide(pages: DataFrame, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to (null: a response)."""
    html = empty_if_null("html")
    rows = trimmed(pages, "page_id", "url", "html").select(
        "page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html).alias("payload_digest"))
    large = rows.where(F.col("payload_bytes") >= least_revisit)
    kept = large.groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = large.join(kept, "payload_digest", "left").withColumn(
        "refers_to", F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")))
    columns = ["page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"]
    small = rows.where(F.col("payload_bytes") < least_revisit).withColumn("refers_to", F.lit(None).cast("long"))
    return joined.select(columns).unionAll(small.select(columns))


def write_archives(decided: DataFrame, path: str) -> None:
    """One text file per archive; the record end is the writer's line separator."""
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:page:"), page, F.lit(">"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)
    decided.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "maxRecordsPerFile", RECORDS_PER_ARCHIVE).option("compression", "gzip").text(path)


def candidates(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """archive, offset, successor (-1: no parsable record) and the fields of everything that starts like a record."""
    names = ["archive", "offset", "successor", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to", "url", "sha1"]

    def field(head: bytes, name: bytes) -> str | None:
        m = re.search(b"\r\n" + name + b": ([^\r\n]*)", head)
        return m[1].decode("utf-8", "replace") if m else None

    def parsed(data, at: int) -> tuple:
        stop = data.find(b"\r\n\r\n", at)
        head = data[at:stop] if stop >= 0 else b""
        length = field(head, b"Content-Length")
        if length is None or not length.isdigit():
            return (at, -1, *[None] * 8)
        end = stop + 4 + int(length)
        if end + 4 > len(data) or data[end:end + 4] != b"\r\n\r\n":
            return (at, -1, *[None] * 8)
        number = lambda v: int(m[0]) if v and (m := re.search(r"-?\d+", v)) else None
        payload = data[stop + 4:end]
        digest = field(head, b"WARC-Payload-Digest")
        return (at, end + 4, field(head, b"WARC-Type"), number(field(head, b"WARC-Record-ID")), number(field(head, b"X-Payload-Length")),
                digest.removeprefix("sha1:") if digest else None, number(field(head, b"WARC-Refers-To")),
                field(head, b"WARC-Target-URI"), hashlib.sha1(payload).hexdigest(), payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_py()
                if data.startswith(b"\x1f\x8b"):
                    data = gzip.decompress(data)
                rows, at = [], data.find(MAGIC)
                while at >= 0:
                    rows.append((archive, *parsed(data, at)))
                    at = data.find(MAGIC, at + 1)
                for lo in range(0, len(rows), 1024):
                    cols = list(zip(*rows[lo:lo + 1024]))
                    arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
                    if with_payload:
                        arrays.append(pa.array(cols[10], pa.binary()))
                    yield pa.RecordBatch.from_arrays(arrays, names=names + ["payload"] * with_payload)

    schema = ("archive string, offset long, successor long, record_type string, page_id long, payload_bytes long, "
              "payload_digest string, refers_to long, url string, sha1 string") + ", payload binary" * with_payload
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


def reachable(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Which candidates a chain from offset 0 visits; offsets ascending."""
    n = offsets.size
    jump = np.append(np.searchsorted(offsets, successors), n)
    hit = jump[:n] < n
    hit[hit] = offsets[jump[:n][hit]] == successors[hit]
    jump[:n][~hit] = n
    seen = np.zeros(n + 1, dtype=bool)
    seen[0] = n > 0 and offsets[0] == 0
    for _ in range(n.bit_length()):
        seen[jump[seen]] = True
        jump = jump[jump]
    return seen[:n] & (successors >= 0)


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives under ``path``, in the columns of ``candidates``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "archive"):
            keep = reachable(group["offset"].to_numpy(), group["successor"].to_numpy())
            yield from group.filter(pa.array(keep)).combine_chunks().to_batches()

    found = candidates(spark, path, with_payload)
    schema = ", ".join(f"{n} {t}" for n, t in found.dtypes)
    return found.repartition("archive").sortWithinPartitions("archive", "offset").mapInArrow(run, schema)


def round_trip(pages: DataFrame, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write the pages' archives to the shared folder and describe what is read back."""
    path = scratch_path(pages.sparkSession, "llm-warc")
    write_archives(decide(pages, least_revisit), path)
    records = read_records(pages.sparkSession, path)
    # A response's digest and size are those of the payload found in the archive.
    whole = F.col("record_type") == "response"
    return records.select("page_id", "payload_bytes", F.when(whole, F.col("sha1")).otherwise(F.col("payload_digest")).alias("payload_digest"),
                          "record_type", "refers_to")
