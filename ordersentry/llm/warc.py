"""WARC archives and their capture index (operator 10).

Writing: one record per page, payload the html in UTF-8.  Of records with
equal payloads of at least ``min_revisit`` bytes the one with the smallest
page id is a ``response``; the others are ``revisit`` records that name it and
carry no payload.  Spark's text writer puts ``\\r\\n\\r\\n`` behind every record,
which is the format's record end, so each file it writes (gzip) is an
archive.

Reading: archives are read as binary files and cut by Content-Length.  Each
archive gives one *run* of index entries sorted by (URL key, timestamp,
page).  The external merge ranges the entries over tasks by that key and
merges, in every task, the slices of the runs by a k-way loser tree, so the
index is globally ordered without sorting the whole again; a URL or host
with many captures is cut by timestamp and page.

Defined cases: null html is an empty payload; null url is the empty URL;
white space and control characters in a URL are percent-encoded; a null
page id is written as ``null`` and read back as null; rows that repeat the
smallest id of a payload are all responses; an empty table makes no archive.
Pages carry no capture time, so a record's date is ``FIRST_CAPTURE`` plus
its id in seconds, modulo ``CAPTURE_SPAN`` (so dates of any id have four-digit
years and sort as text).
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_CAPTURE = 1704067200      # 2024-01-01T00:00:00Z
CAPTURE_SPAN = 1 << 32          # seconds; ends in the year 2160
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def classify(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """Pages with payload size, digest and, for revisits, ``refers_to``.  Only
    digests that occur more than once enter the join."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha2("html", 256))
    firsts = (rows.filter(F.col("payload_bytes") >= min_revisit).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    rows = rows.join(firsts, "digest", "left")
    return rows.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))).drop("first_id")


def records(classified: DataFrame) -> DataFrame:
    """One WARC/1.1 record per row as text (without the record end)."""
    revisit = F.col("refers_to").isNotNull()
    url = F.col("url")
    for code in [*range(0x21), 0x7F]:       # fixed: characters that a header line can't hold
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF * 2), F.col("html"))
    rows = classified.withColumn("block", F.when(revisit, F.lit("")).otherwise(http))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    date = F.date_format(F.timestamp_seconds(F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(CAPTURE_SPAN)) + FIRST_CAPTURE), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
                    F.lit(f"{CRLF}WARC-Record-ID: <urn:page:"), name, F.lit(f">{CRLF}WARC-Date: "), date,
                    F.lit(f"{CRLF}WARC-Target-URI: "), url,
                    F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), F.col("digest"),
                    F.lit(f"{CRLF}X-Payload-Length: "), F.col("payload_bytes").cast("string"),
                    F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: <urn:page:"),
                                             F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
                    F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
                    F.octet_length("block").cast("string"), F.lit(CRLF * 2))
    return rows.select(F.concat(head, F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, min_revisit: int = 100, records_per_file: int = 4096) -> str:
    (records(classify(pages, min_revisit)).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))
    return path


_PAGE = re.compile(r"<urn:page:(-?\d+|null)>")


def url_key(url: str) -> str:
    """Host labels reversed, then path and query: captures of a site sort together."""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:                       # not a URL: sorts by its own text
        return ")" + url
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{host}{f':{port}' if port else ''}){parts.path or '/'}{query}".lower()


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, length, headers, block) of every record of one archive."""
    offset = 0
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record at offset {offset}: {line[:40]!r}")
        size, headers = len(line), {}
        while (line := stream.readline()).strip():
            size += len(line)
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at offset {offset} doesn't end where its Content-Length says")
        size += len(line) + len(block) + 4
        yield offset, size, headers, block
        offset += size


def index_entry(file: str, offset: int, length: int, headers: dict, block: bytes) -> tuple:
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size, refers = int(headers["X-Payload-Length"]), None
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4:]
        size, found = len(payload), hashlib.sha256(payload).hexdigest()
        if found != digest:
            raise ValueError(f"{file}, offset {offset}: payload digest {found}, header {digest}")
    else:
        refers = int(_PAGE.fullmatch(headers["WARC-Refers-To"])[1])
    page = _PAGE.fullmatch(headers["WARC-Record-ID"])[1]
    url = headers["WARC-Target-URI"]
    return (url_key(url), headers["WARC-Date"], None if page == "null" else int(page), kind, size, digest, refers, url, file, offset, length)


ENTRY_SCHEMA = ("url_key string, captured string, page_id long, record_type string, payload_bytes long, payload_digest string, "
                "refers_to long, url string, file string, offset long, length long")
_ENTRY_ARROW = pa.schema([("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                          ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                          ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[8], entry[9]


def merge_runs(runs: list[list[tuple]]) -> Iterator[tuple]:
    """k-way merge by a loser tree: ``tree[1:]`` keeps the loser of each match,
    and the next winner plays only the matches on its leaf's path."""
    k = len(runs)
    if not k:
        return
    at = [0] * k

    def head(r):
        return (0, _order(runs[r][at[r]])) if at[r] < len(runs[r]) else (1,)

    keys = [head(r) for r in range(k)]
    tree = [-1] * k
    winner = -1
    for r in range(k):                        # each run climbs until it meets an empty match
        node, climber = (r + k) // 2, r
        while node and tree[node] != -1:
            if keys[tree[node]] < keys[climber]:
                climber, tree[node] = tree[node], climber
            node //= 2
        if node:
            tree[node] = climber
        else:
            winner = climber
    while keys[winner][0] == 0:
        yield runs[winner][at[winner]]
        at[winner] += 1
        keys[winner] = head(winner)
        node = (winner + k) // 2
        while node:
            if keys[tree[node]] < keys[winner]:
                winner, tree[node] = tree[node], winner
            node //= 2


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The global capture index of the archives below ``path``, ordered by
    (url_key, captured, page_id) over its partitions."""
    def runs(batches):
        for b in batches:
            for file, content in zip(b.column("path").to_pylist(), b.column("content")):
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    entries = sorted((index_entry(file, *record) for record in read_records(stream)), key=_order)
                if entries:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*entries), _ENTRY_ARROW)], schema=_ENTRY_ARROW)

    def merge(batches):
        slices: dict[str, list[tuple]] = {}
        for b in batches:
            for entry in zip(*(c.to_pylist() for c in b.columns)):
                slices.setdefault(entry[8], []).append(entry)
        for run in slices.values():           # a run's slice arrives in order unless a fetch was repeated
            if any(_order(x) > _order(y) for x, y in zip(run, run[1:])):
                run.sort(key=_order)
        out = []
        for entry in merge_runs(list(slices.values())):
            out.append(entry)
            if len(out) == 10_000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _ENTRY_ARROW)], schema=_ENTRY_ARROW)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _ENTRY_ARROW)], schema=_ENTRY_ARROW)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    entries = archives.mapInArrow(runs, ENTRY_SCHEMA)
    return entries.repartitionByRange("url_key", "captured", "page_id", "file", "offset").mapInArrow(merge, ENTRY_SCHEMA)
