"""Operator 10: WARC archives and their index.

write_archives marks repeated payloads and writes one record a row. A record is one gzip member; Spark's text sink puts
them into files under its commit protocol, with an empty gzip member as its line separator, so that every file is a plain
multi-member gzip of WARC records on any file system that Spark writes to. Pages are written by size classes, so that a file
holds FILE_BYTES of payload at most, or one larger page. read_archives parses the files again, checks
digests, and yields the captures of each file as a run sorted by (URL key, timestamp). merge_index range-partitions the
runs, of which each keeps its order within a range, and merges those of a range by a loser tree, which gives capture
histories in one global order.

Defined cases: null html is an empty payload; null URLs have an empty key; null ids sort last and refer by null; of
repeated rows with the smallest id one is the response; line breaks in URLs are percent-encoded; other columns are
ignored; no rows give no records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, free_name, materialize, scratch, ship, with_rows

LEAST = 100  # payload bytes from which a repeat is written as a revisit
PER_FILE = 2000  # records in a file
FILE_BYTES = 1 << 27  # payload bytes in a file, unless one page is larger
PER_RANGE = 100_000  # captures that one merge task orders
# An empty gzip member; the names of the formats' fields are those of WARC 1.1.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff0300" + "00" * 8)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str) -> str:
    """Host labels reversed, then path and query, lower case; without scheme, leading www, default port and fragment."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url.strip().lower())
    if not m:
        return url.strip().lower()
    host = re.sub(r":(80|443)$", "", re.sub(r"^www\d*\.", "", m[1].rpartition("@")[2]))
    return ",".join(reversed(host.split("."))) + ")" + (m[2] or "/")


def record(page: int | None, url: str | None, stamp: str, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One WARC record: a response with the payload, or a revisit with the HTTP head alone."""
    url = re.sub(r"[\r\n]", lambda c: f"%{ord(c[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {stamp}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{'' if first is None else first}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str | None = None) -> None:
    """Write a record per row below `path`; Without time_col, the capture time counts seconds from 2000 by id."""
    ship(pages.sparkSession)
    stamp = F.col(time_col).cast("timestamp") if time_col else F.timestamp_seconds(F.lit(946684800) + F.coalesce(F.col(id_col), F.lit(0)) % 946080000)
    row = free_name(pages, "row")
    rows = with_rows(pages, row).select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("stamp"), F.col(row).alias("row"),
    ).withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    # digests that repeat, without payloads, once for all size classes; Spark broadcasts them where their table is small
    first = materialize(
        rows.where(F.octet_length("html") >= LEAST).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"),
        "firsts",
    )
    marked = rows.join(first, "digest", "left").select(
        "id", "url", "html", "stamp", "digest", F.col("first.id").alias("first"), F.coalesce(F.col("first.row") != F.col("row"), F.lit(False)).alias("revisit")
    )

    def members(it):
        for batch in it:
            for at in range(0, batch.num_rows, 256):
                cols = [c.to_pylist() for c in batch.slice(at, 256).columns]
                out = []
                for page, url, html, stamp, digest, first, revisit in zip(*cols, strict=True):
                    c = zlib.compressobj(3, zlib.DEFLATED, 31)
                    out.append(c.compress(record(page, url, stamp, html.encode(), digest, first, revisit)) + c.flush())
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    # in class k, a page has FILE_BYTES / PER_FILE * 16**k bytes at most and a file PER_FILE / 16**k pages
    least = FILE_BYTES // PER_FILE
    size, tops = F.octet_length(F.coalesce(F.col(html_col), F.lit(""))), [least, least * 16, least * 256]
    kind = F.when(size <= tops[0], 0).when(size <= tops[1], 1).when(size <= tops[2], 2).otherwise(3)
    found = [r[0] for r in pages.groupBy(kind.alias("kind")).count().collect()] or [0]  # four at most
    for k in sorted(found):
        own = marked.where((F.octet_length("html") > (tops[k - 1] if k else -1)) & (F.octet_length("html") <= (tops[k] if k < 3 else 1 << 62)))
        (
            own.mapInArrow(members, "member binary")
            .select(F.col("member").cast("string").alias("value"))
            .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", max(1, PER_FILE // 16**k))
            .mode("append").text(path)
        )
    discard(first)


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, WARC fields, block) of each record in a file's bytes."""
    at = 0
    while at < len(data):
        unzip = zlib.decompressobj(31)
        text = unzip.decompress(data[at:] if len(data) - at < 1 << 16 else memoryview(data)[at : at + (1 << 16)])
        fed = min(len(data), at + (1 << 16))
        parts = [text]
        while not unzip.eof:
            if fed >= len(data):
                raise ValueError(f"the record at {at} is cut off")
            step = memoryview(data)[fed : fed + (1 << 16)]
            parts.append(unzip.decompress(step))
            fed += len(step)
        end = fed - len(unzip.unused_data)
        text = b"".join(parts)
        if text:
            head, _, rest = text.partition(b"\r\n\r\n")
            lines = head.decode("utf-8", "replace").split("\r\n")
            fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
            size = int(fields["content-length"])
            if not lines[0].startswith("WARC/1.") or rest[size:] != b"\r\n\r\n":
                raise ValueError(f"no whole WARC record at {at}")
            yield at, end - at, fields, rest[:size]
        at = end


_CAPTURE = "urlkey string, stamp string, page_id long, file string, offset long, length long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
_NAMES = [x.split(" ")[0] for x in _CAPTURE.split(", ")]


def _page(uri: str | None) -> int | None:
    found = re.search(r":(-?\d+)>$", uri or "")
    return int(found[1]) if found else None


def _key(row: tuple) -> tuple:
    return (row[0], row[1], row[2] is None, row[2] or 0, row[3], row[4])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def read_archives(spark, path: str) -> DataFrame:
    """The captures of all files below `path`, each file's sorted by (URL key, timestamp): the runs of the index."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def runs(it):
        for batch in it:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out = []
                for at, length, fields, block in records(data.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    said = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
                    if fields["warc-type"] == "response" and (len(payload) != said or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{name}: the payload of the record at {at} is damaged")
                    out.append(
                        (url_key(fields.get("warc-target-uri", "")), fields["warc-date"], _page(fields["warc-record-id"]), name.rpartition("/")[2], at, length,
                         said, digest, fields["warc-type"], _page(fields.get("warc-refers-to")))
                    )
                if out:
                    yield _batch(sorted(out, key=_key))

    return files.mapInArrow(runs, _CAPTURE)


def loser_tree(runs: list[list]) -> Iterator:
    """Merge sorted lists of (key, value): inner nodes hold the losers of their matches, a new head plays up one path."""
    k = len(runs)
    if k == 0:
        return
    at = [0] * k

    def beats(a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; -1 stands for a run that beats all, an ended run beats none."""
        if a < 0 or b < 0:
            return a < 0
        x, y = at[a] < len(runs[a]), at[b] < len(runs[b])
        if not (x and y):
            return x
        return (runs[a][at[a]][0], a) < (runs[b][at[b]][0], b)

    tree = [-1] * k  # tree[0] is the winner

    def play(run: int) -> None:
        node, winner = (run + k) // 2, run
        while node > 0:
            if beats(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner

    for r in range(k):
        play(r)
    while at[tree[0]] < len(runs[tree[0]]):
        r = tree[0]
        yield runs[r][at[r]]
        at[r] += 1
        play(r)


def merge_index(captures: DataFrame) -> DataFrame:
    """All captures in one order by (URL key, timestamp, id): partitions are ranges, rows stand in order in each."""
    runs = materialize(captures, "runs")
    ranges = max(1, -(-runs.count() // PER_RANGE))

    def merge(it):
        own: dict[str, list] = {}
        for batch in it:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own.setdefault(row[3], []).append((_key(row), row))
        for run in own.values():
            if any(a[0] > b[0] for a, b in zip(run, run[1:])):  # a shuffle may hand a run's pieces over out of turn
                run.sort(key=lambda x: x[0])
        out = []
        for _, row in loser_tree(list(own.values())):
            out.append(row)
            if len(out) == 5000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return runs.repartitionByRange(ranges, "urlkey", "stamp", F.col("page_id").asc_nulls_last(), "file", "offset").mapInArrow(merge, _CAPTURE)


def archive_round_trip(pages: DataFrame, path: str | None = None, **columns: str) -> DataFrame:
    """Write pages as archives, read them back and return the merged index."""
    path = path or f"{scratch(pages.sparkSession)}/warc"
    write_archives(pages, path, **columns)
    return merge_index(read_archives(pages.sparkSession, path))
