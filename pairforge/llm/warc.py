"""Web archives of pages, read back, with a merged capture index.

Payload digests decide which records are responses and which are revisits of
the response with the largest page_id.  Archives are written as gzip files of
WARC/1.1 records by Spark's text writer, one archive per task, and read back
record by record by their content lengths.  Each archive's captures form a
run sorted by URL key, timestamp and page_id; runs are cut at global
splitters, and each range merges its runs with a loser tree, which gives the
capture histories in global order.  Splitters are full keys, so a URL that
holds a third of all captures spreads over many ranges.

Defined cases: null html is an empty payload; null url has an empty key and no
target header; a row without page_id is left out; rows that repeat a page_id
and payload are records of the same type; no rows: an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from bisect import bisect_right
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import byte_texts, free_shuffles, save
from pairforge.session import scratch_path

#: captures that one range merges on average
RANGE_ROWS = 50_000
#: sampled keys per range for the splitters
SPLIT_SAMPLE = 50
_EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
_PERIOD = 10 * 365 * 86_400
_END = "\r\n\r\n"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: str | None) -> str:
    """Sort key: host labels reversed, no scheme, user, ``www.``, default port or fragment."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(\?[^#]*)?", url or "", re.I)
    if not m:
        return (url or "").split("#")[0].lower()
    host, _, port = m[1].rpartition("@")[2].lower().partition(":")
    host = host.removeprefix("www.")
    port = f":{port}" if port not in ("", "80", "443") else ""
    query = "&".join(sorted(m[3][1:].split("&"))) if m[3] else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (m[2] or "/").lower() + (f"?{query.lower()}" if query else "")


def capture_time(page_id: int) -> str:
    """The pages have no time: a fixed one per page_id."""
    return (_EPOCH + timedelta(seconds=page_id % _PERIOD)).strftime("%Y-%m-%dT%H:%M:%SZ")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=page_id & (1 << 64) - 1)}>"


def _page_id(record_id: str) -> int:
    value = uuid.UUID(record_id.strip("<>").removeprefix("urn:uuid:")).int
    return value - (1 << 64) if value >> 63 else value


def warc_record(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response or, if it refers to another page, a revisit record, without the final blank lines."""
    http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    block = ("\r\n".join(http) + _END).encode() + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {capture_time(page_id)}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + _END).encode() + block


def read_records(data: bytes):
    """(offset, length, header fields, block) of each record of an archive."""
    at = 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        lines = data[at:body - 4].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        end = body + int(fields["Content-Length"])
        yield at, end + 4 - at, fields, data[body:end]
        at = end + 4


class LoserTree:
    """Merges sorted lists: every inner node keeps the loser of its match."""

    def __init__(self, runs: list[list]):
        self._runs = runs
        self._at = [0] * len(runs)
        self._size = 1
        while self._size < len(runs):
            self._size *= 2
        self._losers = [0] * self._size
        self._winner = self._build(1)

    def _head(self, run: int):
        """Exhausted runs come last; equal heads keep the order of the runs."""
        if run >= len(self._runs) or self._at[run] >= len(self._runs[run]):
            return (1, None, run)
        return (0, self._runs[run][self._at[run]], run)

    def _less(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        if x[0] or y[0]:
            return (x[0], x[2]) < (y[0], y[2])
        return (x[1], x[2]) < (y[1], y[2])

    def _build(self, node: int) -> int:
        if node >= self._size:
            return node - self._size
        left, right = self._build(2 * node), self._build(2 * node + 1)
        winner, loser = (left, right) if self._less(left, right) else (right, left)
        self._losers[node] = loser
        return winner

    def __iter__(self):
        while (head := self._head(self._winner))[0] == 0:
            yield head[1]
            run = self._winner
            self._at[run] += 1
            node = (run + self._size) // 2
            while node:
                if self._less(self._losers[node], run):
                    self._losers[node], run = run, self._losers[node]
                node //= 2
            self._winner = run


def _digester(batches):
    for batch in batches:
        texts = byte_texts(batch.column("html"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), pa.array([payload_digest(t) for t in texts], pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "digest", "size"])


def _recorder(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            columns = (part.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to"))
            yield pa.RecordBatch.from_arrays([pa.array(
                [warc_record(p, u, t, d, r).decode()
                 for p, u, d, r, t in zip(*columns, byte_texts(part.column("html")), strict=True)], pa.string())],
                names=["value"])


_CAPTURE = [("urlkey", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()),
            ("at", pa.int64()), ("size", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64())]
_CAPTURE_SQL = ("urlkey string, timestamp string, page_id bigint, archive string, at bigint, size bigint, "
                "record_type string, refers_to bigint, payload_digest string, payload_bytes bigint")
_NAMES = [n for n, _ in _CAPTURE]


def _captures(archive: str, data: bytes) -> list[tuple]:
    """The archive's captures in order: a run."""
    rows = []
    for at, size, fields, block in read_records(data):
        payload = block[block.index(b"\r\n\r\n") + 4:]
        revisit = fields["WARC-Type"] == "revisit"
        rows.append((url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"], _page_id(fields["WARC-Record-ID"]),
                     archive, at, size, fields["WARC-Type"],
                     _page_id(fields["WARC-Refers-To"]) if revisit else None,
                     fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else payload_digest(payload),
                     None if revisit else len(payload)))
    return sorted(rows, key=lambda r: r[:5])


def _inflated(content: bytes) -> bytes:
    """All members of a gzip file, one after the other (an archive may have one per record)."""
    return gzip.GzipFile(fileobj=io.BytesIO(content)).read() if content else b""


def _run_cutter(splitters: list[tuple]):
    def cut(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(),
                                     strict=True):
                run = _captures(path.rsplit("/", 1)[-1], _inflated(content))
                parts: dict[int, list] = {}
                for row in run:
                    parts.setdefault(bisect_right(splitters, row[:3]), []).append(dict(zip(_NAMES, row, strict=True)))
                yield pa.RecordBatch.from_pylist(
                    [{"part": k, "run": rows} for k, rows in parts.items()],
                    schema=pa.schema([("part", pa.int64()), ("run", pa.list_(pa.struct(_CAPTURE)))]))
    return cut


def _merger(table: pa.Table) -> pa.Table:
    runs = [[tuple(row.values()) for row in run] for run in table.column("run").to_pylist()]
    # keys end with archive and offset, which differ: later fields are never compared
    merged = list(LoserTree(sorted(runs, key=lambda r: r[0][3])))
    columns = list(zip(*merged, strict=True))
    part = table.column("part")[0].as_py()
    return pa.table({"part": pa.array([part] * len(merged), pa.int64()),
                     "place": pa.array(range(len(merged)), pa.int64()),
                     **{n: pa.array(c, k) for (n, k), c in zip(_CAPTURE, columns, strict=True)}})


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write the pages (page_id, url, html) as archives below ``path``.

    Of the pages with equal payloads of at least ``min_bytes`` bytes that with
    the largest page_id is a response and the others revisit it."""
    rows = pages.where("page_id is not null").select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    slim = save(rows.select("page_id", "html").mapInArrow(_digester, "page_id bigint, digest string, size bigint"),
                "warc-digests")
    heads = (slim.where(F.col("size") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("head"), F.min("page_id").alias("low")).where("low < head").select("digest", "head"))
    known = (slim.join(heads, "digest", "left")
             .groupBy("page_id", "digest").agg(F.max("head").alias("head"), F.max("size").alias("size"))
             .select(F.col("page_id").alias("page"), "digest",
                     F.when((F.col("head") > F.col("page_id")) & (F.col("size") >= min_bytes), F.col("head"))
                     .alias("refers_to")))
    full = rows.withColumn("own", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    # rows that repeat a page_id with another payload keep their own digest
    joined = full.join(known.withColumn("known", _hex_of_base32("digest")),
                       (F.col("page_id") == F.col("page")) & (F.col("own") == F.col("known")))
    (joined.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(_recorder, "value string")
     .write.option("lineSep", _END).option("compression", "gzip").text(path))


def _hex_of_base32(column: str):
    """Lower-case hex of a 32-letter base-32 SHA-1: 4 groups of 8 letters, 5 bytes each."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    spelled = F.translate(column, letters, digits)
    return F.lower(F.concat(*[F.lpad(F.conv(F.substring(spelled, 8 * i + 1, 8), 32, 16), 10, "0") for i in range(4)]))


def capture_index(spark, path: str, keys: DataFrame) -> DataFrame:
    """The captures of the archives below ``path`` in global order (part, place).

    ``keys``: the pages' page_id and url, from which splitters are sampled."""
    total = keys.count()
    ranges = max(12, total // RANGE_ROWS)
    step = max(1, total // (ranges * SPLIT_SAMPLE))
    sample = sorted((url_key(_CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", r["url"]) if r["url"] is not None else None),
                     capture_time(r["page_id"]), r["page_id"])
                    for r in keys.where(F.pmod(F.xxhash64("page_id"), F.lit(step)) == 0).collect())
    splitters = [sample[len(sample) * k // ranges] for k in range(1, ranges)] if sample else []
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    runs = files.mapInArrow(_run_cutter(splitters), f"part bigint, run array<struct<{_CAPTURE_SQL}>>")
    return runs.groupBy("part").applyInArrow(_merger, f"part bigint, place bigint, {_CAPTURE_SQL}")


def archived(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """One row per page, from the archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to, and the capture index: part, place, urlkey, timestamp,
    archive, at, size."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    free_shuffles(spark)
    keys = pages.where("page_id is not null").select(F.col("page_id").cast("bigint").alias("page_id"), "url")
    index = save(capture_index(spark, path, keys), "warc-index")
    whole = (index.where("record_type = 'response'")
             .groupBy(F.col("page_id").alias("head"), F.col("payload_digest").alias("head_digest"))
             .agg(F.max("payload_bytes").alias("head_bytes")))
    return (index.join(whole, (F.col("refers_to") == F.col("head")) & (F.col("payload_digest") == F.col("head_digest")),
                       "left")
            .select("page_id", F.coalesce("payload_bytes", "head_bytes").alias("payload_bytes"),
                    F.coalesce("head_digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to",
                    "part", "place", "urlkey", "timestamp", "archive", "at", "size"))
