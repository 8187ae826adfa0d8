"""WARC archives of pages, and a capture index merged from sorted runs.

Pages become records that Spark's text writer puts into archive files: a record
ends in CR LF CR LF, the last LF of which is the line end the writer adds, so a
file is a concatenation of records, compressed as a whole. Reading goes by
Content-Length alone; offsets count in the uncompressed file.

Every archive read yields its captures as a locally sorted run. Runs are dealt
to tasks by ranges of (URL key, timestamp); each task merges its pieces of the
runs with a loser tree, so captures of all archives come out globally ordered.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emisplit.llm.common import new_folder, same

#: Payloads from this many bytes on are stored once.
LEAST = 1000
#: Pages in one archive file.
PER_FILE = 2048
_EPOCH = 1577836800  # 2020-01-01, the date of page 0; pages carry no date of their own

_CAPTURE = (
    "url_key string, captured timestamp, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, archive string, record_offset long, record_length long"
)
_FIELDS = [x.split()[0] for x in _CAPTURE.split(", ")]


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels from the last to the first, then the path, in lower case."""
    plain = F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_extract(plain, r"^([^/?:]*)", 1)
    reverse = F.array_join(F.reverse(F.split(F.regexp_replace(host, r"^www\.", ""), r"\.")), ",")
    rest = F.regexp_replace(F.regexp_extract(plain, r"^[^/?:]*(?::\d+)?(.*)$", 1), r"(?<=.)/$", "")
    return F.coalesce(F.concat(reverse, F.lit(")"), rest), F.lit(""))


def with_references(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, refers_to`` of each page.

    Of equal payloads of at least ``least`` bytes the one with the largest id
    is kept, and the others refer to it.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    payload = F.encode("html", "UTF-8")
    rows = rows.withColumns(
        {"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha1(payload), "check": F.xxhash64("html")}
    )
    large = rows.where(F.col("payload_bytes") >= least)
    keys = ["payload_digest", "payload_bytes", "check"]
    kept = large.groupBy(*keys).agg(F.max("page_id").alias("kept_id"), F.count("*").alias("copies")).where("copies > 1")
    joined = rows.join(kept, keys, "left")
    refers = F.when(F.col("page_id") < F.col("kept_id"), F.col("kept_id"))
    return joined.select("page_id", "url", "html", "payload_bytes", "payload_digest", refers.alias("refers_to"))


def record(page_id: Column, url: Column, html: Column, digest: Column, size: Column, refers_to: Column) -> Column:
    """A WARC record without its last LF; a revisit has the HTTP head only."""
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n")
    )
    block = F.concat(head, F.when(refers_to.isNull(), html).otherwise(F.lit("")))
    date = F.date_format(F.timestamp_seconds(F.lit(_EPOCH) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1 << 32))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    known = F.when(page_id.isNotNull(), F.concat(F.lit("WARC-Record-ID: <urn:page:"), page_id.cast("string"), F.lit(">\r\n")))
    # Blanks and line ends can't stand in a header line; they are percent-encoded and decoded again on reading.
    safe = url
    for raw in ("%", "\r", "\n", " "):
        safe = F.replace(safe, F.lit(raw), F.lit(f"%{ord(raw):02X}"))
    parts = [
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(refers_to.isNull(), F.lit("response")).otherwise(F.lit("revisit")),
        F.lit("\r\n"),
        F.coalesce(known, F.lit("")),
        F.lit("WARC-Date: "),
        date,
        F.lit("\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), safe, F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"),
        digest,
        F.lit("\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">\r\n")), F.lit("")),
        F.when(
            refers_to.isNotNull(),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
        ).otherwise(F.lit("")),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
        F.lit("\r\n\r"),
    ]
    return F.concat(*parts)


def write_archives(pages: DataFrame, folder: str, least: int = LEAST) -> None:
    """Write a record per page into archive files under ``folder``."""
    rows = with_references(pages, least)
    names = ("page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to")
    lines = rows.select(record(*[F.col(c) for c in names]).alias("value"))
    lines.write.option("lineSep", "\n").option("maxRecordsPerFile", PER_FILE).text(folder, compression="gzip")


def _number(header: bytes | None) -> int | None:
    return int(header[len(b"<urn:page:") : -1]) if header else None


def _records(archive: str, data: bytes) -> Iterator[dict]:
    at = 0
    while at < len(data):
        split = data.index(b"\r\n\r\n", at)
        head = dict(x.split(b": ", 1) for x in data[at:split].split(b"\r\n")[1:])
        start = split + 4
        end = start + int(head[b"Content-Length"])
        body = data.index(b"\r\n\r\n", start) + 4
        http = dict(x.split(b": ", 1) for x in data[start : body - 4].split(b"\r\n")[1:])
        kind = head[b"WARC-Type"].decode()
        digest = head[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
        size = int(http[b"Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n" or kind == "response" and (
            size != end - body or hashlib.sha1(memoryview(data)[body:end]).hexdigest() != digest
        ):
            raise ValueError(f"damaged record at byte {at} of {archive}")
        url = head.get(b"WARC-Target-URI")
        for code, raw in ((b"%20", b" "), (b"%0A", b"\n"), (b"%0D", b"\r"), (b"%25", b"%")):
            url = url.replace(code, raw) if url is not None else None
        yield {
            "page_id": _number(head.get(b"WARC-Record-ID")),
            "url": None if url is None else url.decode(),
            "captured": head[b"WARC-Date"].decode(),
            "record_type": kind,
            "refers_to": _number(head.get(b"WARC-Refers-To")),
            "payload_bytes": size,
            "payload_digest": digest,
            "archive": archive,
            "record_offset": at,
            "record_length": end + 4 - at,
        }
        at = end + 4


_READ = pa.schema(
    [
        (n, pa.int64() if n in ("page_id", "refers_to", "payload_bytes", "record_offset", "record_length") else pa.string())
        for n in ("page_id", "url", "captured", "record_type", "refers_to", "payload_bytes", "payload_digest", "archive", "record_offset", "record_length")
    ]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            name = path.as_py().rsplit("/", 1)[-1]
            rows = list(_records(name, gzip.decompress(content.as_buffer())))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _READ)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Captures of all archives under ``folder``; response payloads are checked against their digest."""
    schema = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in _READ)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(folder).select("path", "content")
    rows = files.mapInArrow(_read, schema)
    return rows.withColumns({"captured": F.to_timestamp("captured"), "url_key": url_key(F.col("url"))}).select(*_FIELDS)


def loser_tree(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs: an inner node keeps the loser of its match, the winner moves up."""
    k = len(runs)
    at = [0] * k

    def head(run: int) -> tuple:
        return (0, runs[run][at[run]], run) if at[run] < len(runs[run]) else (1, (), run)

    losers = [-1] * max(k, 1)  # a run that reaches an empty node waits there for its opponent
    winner = -1
    for run in range(k):
        best, node = run, (run + k) // 2
        while node > 0:
            if losers[node] < 0:
                losers[node], best = best, -1
                break
            if head(losers[node]) < head(best):
                losers[node], best = best, losers[node]
            node //= 2
        if best >= 0:
            winner = best
    while k and at[winner] < len(runs[winner]):
        yield runs[winner][at[winner]]
        at[winner] += 1
        best, node = winner, (winner + k) // 2
        while node > 0:
            if head(losers[node]) < head(best):
                losers[node], best = best, losers[node]
            node //= 2
        winner = best


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    columns = [table.column(n).to_pylist() for n in ("archive", "url_key", "captured", "record_offset")]
    rows = [(*r, i) for i, r in enumerate(zip(*columns, strict=True))]
    # The rows come sorted by (archive, key): each archive's stretch is one sorted run.
    runs = [[(r[1], r[2], r[0], r[3], r[4]) for r in run] for _, run in groupby(rows, itemgetter(0))]
    order = [r[-1] for r in loser_tree(runs)]
    for batch in table.take(pa.array(order, pa.int64())).to_batches(max_chunksize=10_000):
        yield batch


def merged_index(captures: DataFrame) -> DataFrame:
    """All captures ordered by URL key, timestamp, archive and offset.

    The partitions are consecutive ranges, so the result read in order is one
    global index. A URL with many captures spreads over several ranges; a task
    holds the index rows of its range only.
    """
    ranges = captures.repartitionByRange("url_key", "captured", "archive", "record_offset")
    runs = ranges.sortWithinPartitions("archive", "url_key", "captured", "record_offset")
    return runs.mapInArrow(_merged, captures.schema)


def capture_index(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Write archives of ``pages``, read them back and return the merged index.

    NULL html is an empty payload, NULL URLs are left out of the record and
    sort first, NULL ids give a record without an id. A page id that occurs
    twice gives two records; of equal ids with equal payloads none refers to
    the other. No pages give no archives and no rows. Extra columns are not
    written.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    write_archives(pages, folder, least)
    return merged_index(read_archives(spark, folder))
