"""WARC archives of web pages, read back into one capture index in global order.

Writing is Spark's text writer: a record is a string and its record separator ends each, which is the
layout of a WARC file. Payloads that were met before become revisit records without a body. Reading goes
file by file and record by record; the captures of each file are one run, sorted where it was read. The
runs are merged externally: ranges of (URL key, time, page) of even size go to one task each, where a
loser tree merges what each run has in that range, so the parts in order are the history of all
captures by URL.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import written
from tickloom.session import shared_folder

#: Payloads below this size are always stored again.
REVISIT_BYTES = 100
#: Records of an archive file at most: what one reading task sorts.
FILE_RECORDS = 2000
#: Captures of a merging task, about.
MERGE_ROWS = 100_000
#: Capture time of page 0 (2024-01-01); the tables have none, so a page's number counts seconds from here.
EPOCH = 1_704_067_200

_END = "\r\n"


def _record_id(page: str) -> str:
    return f"concat('<urn:uuid:', regexp_replace(md5(concat('page ', {page})), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '$1-$2-$3-$4-'), '>')"


def _lines(*lines: str) -> Column:
    """Header lines; a line whose expression is null is left out."""
    return F.expr(f"concat_ws('\\r\\n', {', '.join(lines)})")


def records(pages: DataFrame) -> DataFrame:
    """``record``: every row of ``pages`` as a WARC record without its closing blank lines.

    A null html is an empty payload, a null url an empty target; blanks and control characters in urls
    are escaped. Of equal payloads of at least REVISIT_BYTES bytes the rows with the smallest page_id are
    responses, all others (null ids too) revisit it; if all their ids are null, all are responses.
    """
    slim = pages.selectExpr(
        "CAST(page_id AS LONG) AS page_id",
        r"regexp_replace(coalesce(CAST(url AS STRING), ''), '[\\x00-\\x20\\x7F]', '%20') AS url",
        "coalesce(CAST(html AS STRING), '') AS html",
    ).withColumns({"bytes": F.expr("CAST(octet_length(html) AS LONG)"), "digest": F.expr("sha2(html, 256)")})
    again = slim.where(f"bytes >= {REVISIT_BYTES}").groupBy("digest").agg(F.min("page_id").alias("head"), F.count("*").alias("n"))
    again = again.where("n > 1 AND head IS NOT NULL").select("digest", "head")
    rows = slim.join(again, "digest", "left").withColumn("revisit", F.expr("head IS NOT NULL AND NOT page_id <=> head"))
    http = _lines(
        "'HTTP/1.1 200 OK'",
        "'Content-Type: text/html; charset=utf-8'",
        "concat('Content-Length: ', bytes)",
        "''",
        "IF(revisit, '', html)",
    )
    rows = rows.withColumn("body", http)
    seconds = f"to_utc_timestamp(timestamp_seconds({EPOCH} + coalesce(page_id, 0)), current_timezone())"
    return rows.select(
        _lines(
            "'WARC/1.1'",
            "concat('WARC-Type: ', IF(revisit, 'revisit', 'response'))",
            f"concat('WARC-Record-ID: ', {_record_id('coalesce(CAST(page_id AS STRING), uuid())')})",
            f"concat('WARC-Date: ', date_format({seconds}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"))",
            "concat('WARC-Target-URI: ', url)",
            "concat('WARC-Payload-Digest: sha256:', digest)",
            "IF(revisit, 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest', NULL)",
            f"IF(revisit, concat('WARC-Refers-To: ', {_record_id('CAST(head AS STRING)')}), NULL)",
            "IF(revisit, concat('Refers-To-Page-ID: ', head), NULL)",
            "concat('Page-ID: ', page_id)",
            "'Content-Type: application/http; msgtype=response'",
            "concat('Content-Length: ', octet_length(body))",
            "''",
            "body",
        ).alias("record")
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """The records of ``pages`` as gzipped WARC files in a new folder ``path``."""
    (
        records(pages)
        .write.option("lineSep", _END * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


def url_key(url: str) -> str:
    """The sort key of a URL: its host's labels from the right, then path and query, in lower case."""
    try:
        parts = urlsplit(url.strip())
        host = re.sub(r"^www\d*\.", "", parts.hostname or "")
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}".lower()


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(headers, block, offset) of each record of an uncompressed WARC stream, one at a time."""
    offset = 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins at byte {start}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            offset += len(line)
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"the record at byte {start} is cut off")
        offset += len(line) + length
        yield headers, block, start


def _capture(headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    if headers["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"the payload of {headers['warc-record-id']} is not what its digest says")
    page = headers.get("page-id")
    refers = headers.get("refers-to-page-id")
    return (
        url_key(headers["warc-target-uri"]),
        headers["warc-date"],
        int(page) if page else None,
        size,
        digest,
        headers["warc-type"],
        int(refers) if refers else None,
    )


_COLUMNS = [
    ("url_key", pa.string()),
    ("captured", pa.string()),
    ("page_id", pa.int64()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("record_type", pa.string()),
    ("refers_to", pa.int64()),
    ("archive", pa.string()),
    ("place", pa.int64()),
]
_SCHEMA = (
    "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, archive string, place long"
)


def _order(capture: tuple) -> tuple:
    page = capture[2]
    return capture[0].encode("utf-8"), capture[1], page is None, page or 0, capture[7:]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _COLUMNS, strict=True)], names=[n for n, _ in _COLUMNS])


def _read_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            name = batch.column(0)[i].as_py()
            content = pa.BufferReader(batch.column(1)[i].as_buffer())
            with gzip.GzipFile(fileobj=content) as stream:
                run = [(*_capture(h, b), name, at) for h, b, at in read_records(io.BufferedReader(stream))]
            if run:
                yield _batch(sorted(run, key=_order))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archive files of a folder; those of a file come sorted, as one run."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.selectExpr("regexp_extract(path, '[^/]*$', 0) AS name", "content").mapInArrow(_read_runs, _SCHEMA)


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, the overall winner stands on top."""

    def __init__(self, runs: list[list], order):
        self.runs, self.order = runs, order
        self.at = [0] * len(runs)
        self.keys = [order(r[0]) if r else None for r in runs]
        k = len(runs)
        self.losers = [-1] * k
        winners = [-1] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            first, second = (a, b) if self._before(a, b) else (b, a)
            winners[node], self.losers[node] = first, second
        self.winner = winners[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def __iter__(self) -> Iterator:
        k = len(self.runs)
        while k and self.keys[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.keys[run] = self.order(self.runs[run][self.at[run]]) if self.at[run] < len(self.runs[run]) else None
            node = (run + k) // 2
            while node:  # only matches on the way up are played again
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: list[list[tuple]] = []
    last = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[7] != last:
                runs.append([])
                last = row[7]
            runs[-1].append(row)
    out = []
    for row in LoserTree(runs, _order):
        out.append(row)
        if len(out) == 10_000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def capture_index(runs: DataFrame) -> DataFrame:
    """All captures in global order of (URL key, time, page): the parts of the result in order, and within.

    Ranges are cut by page as well, so the captures of one URL may span several tasks.
    """
    runs = written(runs, "capture-runs")
    parts = max(1, -(-runs.count() // MERGE_ROWS), int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = runs.repartitionByRange(parts, "url_key", "captured", F.col("page_id").asc_nulls_last())
    inside = ["archive", "url_key", "captured", F.col("page_id").asc_nulls_last(), "place"]
    return ranges.sortWithinPartitions(*inside).mapInArrow(_merge, _SCHEMA)


def archived(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and returns their capture index.

    One row per page, repeated rows included; nothing for an empty table. Of extra columns none is read.
    """
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return capture_index(read_runs(spark, path))
