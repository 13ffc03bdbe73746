"""WARC archives, and a capture index merged from sorted runs."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.staging import col, stage

#: Records of one archive file.
FILE_RECORDS = 2_000
#: Captures of one sorted run, and of one range of the merged index.
RUN_CAPTURES = 20_000
RANGE_CAPTURES = 50_000

_BREAK = "\r\n\r\n"
_RECORD = re.compile(rb"<urn:page:(-?\d*):(\d+)>")


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base 32: each five hex digits are four digits of base 32."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(pages: DataFrame, path: str, least_revisit: int = 0, captured: Column | None = None) -> None:
    """Write a record per row of ``pages(page_id, url, html)`` as gzip WARC files below ``path``.

    Of records with equal payloads of at least ``least_revisit`` bytes, the one with the largest page_id is a
    response; the others are revisits that name it and carry no payload. Ties on page_id (repeated rows, null ids
    being smallest) go to the last row read, so exactly one is a response. Smaller payloads are all responses.
    Null html: empty payload. Null url: no target. Line breaks in a url are percent-encoded. Without ``captured``
    a record's date is the first of 2024 plus page_id seconds. Other columns are left out.

    The rows are numbered and written once; the choice and the records read that one frame, so they agree on the numbers
    whatever the input's layout, also when a lost executor's part is computed again. The choice is an aggregate over digests,
    which combines before the shuffle, and is joined back; no group of equal payloads meets in one place. Spark's text
    writer puts the blank lines that end a record between records.
    """
    body = F.coalesce(col("html"), F.lit(""))
    when = captured if captured is not None else F.timestamp_seconds(F.lit(1704067200) + F.coalesce(col("page_id"), F.lit(0)) % (1 << 31))
    rows = pages.select(
        col("page_id").alias("page_id"),
        F.regexp_replace(F.regexp_replace(col("url"), "\r", "%0D"), "\n", "%0A").alias("url"),
        body.alias("html"),
        F.octet_length(body).cast("long").alias("bytes"),
        base32_sha1(body).alias("digest"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.monotonically_increasing_id().alias("uid"),
    )
    rows = stage(rows, "warc-pages")
    heads = rows.where(F.col("bytes") >= least_revisit).groupBy("digest").agg(F.max(F.struct("page_id", "uid")).alias("head"), F.count("*").alias("n"))
    heads = stage(heads.where("n > 1").select(F.col("digest").alias("of"), "head"), "warc-heads")
    joined = rows.join(heads, (F.col("digest") == F.col("of")) & (F.col("bytes") >= least_revisit), "left")
    revisit = F.col("head").isNotNull() & (F.col("head.uid") != F.col("uid"))

    def named(page: str, uid: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(":"), F.col(uid).cast("string"), F.lit(">"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_BREAK))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        named("page_id", "uid"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.col("url")), F.lit("")),
        F.lit("\r\nWARC-Date: "),
        F.col("date"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                named("head.page_id", "head.uid"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(_BREAK),
        block,
    )
    writer = joined.select(record.alias("value")).write.option("lineSep", _BREAK).option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("compression", "gzip").text(path)


def url_key(url: str | None) -> str:
    """A url as sorted host labels and path: ``http://www.a.org:80/x?q#f`` is ``org,a)/x?q``. A null or odd url is kept as it is."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    if not host:
        return url
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def parse_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[bytes, bytes], bytes, int, int]]:
    """(header fields in lower case, block, offset, length) of a stream of bytes; only the current record is held."""
    held, passed = bytearray(), 0
    chunks = iter(chunks)

    def fill(upto: Callable[[], bool]) -> bool:
        while not upto():
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(lambda: b"\r\n\r\n" in held):
        at = held.index(b"\r\n\r\n")
        first, *lines = bytes(held[:at]).split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:60]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines)}
        end = at + 4 + int(fields[b"content-length"])
        if not fill(lambda: len(held) >= end + 4):
            raise ValueError("a WARC record is cut short")
        yield fields, bytes(held[at + 4 : end]), passed, end + 4
        del held[: end + 4]
        passed += end + 4


CAPTURE = (
    "url_key string, captured string, page_id long, uid long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, archive string, offset long, length long"
)
_ORDER = ("url_key", "captured", "page_id", "uid")


def fetch(spark: SparkSession, captures: DataFrame) -> DataFrame:
    """``page_id, uid, payload`` of captures (rows of an index): each archive is read to the offsets asked of it, and no further.

    Revisits carry no payload; ask for the capture they refer to. The captures of an archive are a bounded number.
    """
    asked = captures.groupBy("archive").agg(F.collect_list(F.struct("offset", "length", "page_id", "uid")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, wanted in zip(batch.column("content"), batch.column("asked").to_pylist()):
                text, got = zlib.decompressobj(wbits=31), []
                end = max(w["offset"] + w["length"] for w in wanted)
                plain = text.decompress(data.as_buffer(), end)
                for w in wanted:
                    fields, block, _, _ = next(parse_records(iter([plain[w["offset"] : w["offset"] + w["length"]]])))
                    got.append((w["page_id"], w["uid"], block.partition(b"\r\n\r\n")[2]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), (pa.int64(), pa.int64(), pa.binary()))], ["page_id", "uid", "payload"])

    paths = [r["archive"] for r in asked.select("archive").toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], "page_id long, uid long, payload binary")
    files = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("archive"), "content")
    return files.join(asked, "archive").mapInArrow(cut, "page_id long, uid long, payload binary")


def _arrow(rows: Sequence[tuple], extra: Sequence[tuple[str, pa.DataType]] = ()) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [(n, kinds[t]) for n, t in (f.split() for f in CAPTURE.split(", "))] + list(extra)
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def capture_of(fields: dict[bytes, bytes], block: bytes) -> tuple:
    """An index row; the digest of a response's payload is computed anew and compared with its header."""
    head, _, payload = block.partition(b"\r\n\r\n")
    kind = fields[b"warc-type"].decode()
    size = int(re.search(rb"(?i)content-length:\s*(\d+)", head)[1])
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload and header differ in {fields[b'warc-record-id']!r}")
    page, uid = _RECORD.fullmatch(fields[b"warc-record-id"]).groups()
    refers = _RECORD.fullmatch(fields[b"warc-refers-to"])[1] if kind == "revisit" else b""
    url = fields[b"warc-target-uri"].decode() if b"warc-target-uri" in fields else None
    number = lambda x: int(x) if x else None
    return url_key(url), fields[b"warc-date"].decode(), number(page), int(uid), url, size, digest, kind, number(refers)


def _sort_key(row: tuple) -> tuple:
    """By url key, time, page (null first) and row."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[3]


def read_runs(spark: SparkSession, path: str, run_captures: int = RUN_CAPTURES) -> DataFrame:
    """The captures of the archives below ``path`` as sorted runs: ``run, seq`` and the capture's columns.

    A gzip file is read by one task from front to back. Its text parts are joined again to the bytes that were
    written, and records are cut by their lengths, so blank lines inside a payload do no harm. ``archive``, ``offset`` and
    ``length`` say where a record stands in the unpacked file; :func:`fetch` reads it from there.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, run = TaskContext.get().partitionId(), 0, []
        pieces = ((name, v) for b in batches for name, v in zip(b.column("archive").to_pylist(), b.column("value").cast(pa.binary())))
        archives = itertools.groupby(pieces, key=lambda piece: piece[0])  # a task may read several files, one after the other

        def out() -> pa.RecordBatch:
            run.sort(key=_sort_key)
            name = f"{task}-{number}"
            return _arrow([(*row, name, i) for i, row in enumerate(run)], (("run", pa.string()), ("seq", pa.int32())))

        for name, parts in archives:
            for fields, block, offset, length in parse_records(v.as_buffer().to_pybytes() + b"\r\n\r\n" for _, v in parts):
                run.append((*capture_of(fields, block), name, offset, length))
                if len(run) >= run_captures:
                    yield out()
                    number, run = number + 1, []
        if run:
            yield out()

    lines = spark.read.option("lineSep", _BREAK).text(path).select("value", F.col("_metadata.file_path").alias("archive"))
    return lines.mapInArrow(read, CAPTURE + ", run string, seq int")


class LoserTree:
    """Merge sorted lists: inner nodes hold the loser of their match, the root the overall winner.

    After the winner is taken, only the matches on its path are played again: log2(k) comparisons a row.
    """

    def __init__(self, lists: Sequence[Sequence[tuple]], key: Callable[[tuple], tuple]) -> None:
        self.lists, self.key, self.k = lists, key, max(1, len(lists))
        self.at = [0] * len(lists)
        self.heads = [key(x[0]) if x else None for x in lists]
        self.losers = [-1] * self.k
        winners = [-1] * self.k + list(range(len(lists))) + [-1] * (self.k - len(lists))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._wins(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else (0 if lists else -1)

    def _wins(self, a: int, b: int) -> bool:
        if a < 0 or self.heads[a] is None:
            return False
        return b < 0 or self.heads[b] is None or (self.heads[a], a) <= (self.heads[b], b)

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            w = self.winner
            yield self.lists[w][self.at[w]]
            self.at[w] += 1
            self.heads[w] = self.key(self.lists[w][self.at[w]]) if self.at[w] < len(self.lists[w]) else None
            node = (w + self.k) // 2
            while node >= 1:
                if self._wins(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def merge_index(runs: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """The captures in one order over all runs: partitions are consecutive ranges, each in order.

    Ranges are cut by url key, time, page and row together, so a url with very many captures spans several. A range
    holds a segment of every run that reaches into it; a loser tree merges the segments.
    """
    runs = stage(runs, "warc-runs")
    parts = max(1, -(-runs.count() // range_captures))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[str, list[tuple]] = {}
        for batch in batches:
            rows = zip(*[c.to_pylist() for c in batch.columns])
            for row in rows:
                segments.setdefault(row[-2], []).append(row[:-2])
        rows = []
        for row in LoserTree(list(segments.values()), _sort_key):
            rows.append(row)
            if len(rows) == 10_000:
                yield _arrow(rows)
                rows = []
        yield _arrow(rows)

    ranged = runs.repartitionByRange(parts, *_ORDER).sortWithinPartitions("run", "seq")
    return ranged.mapInArrow(merge, CAPTURE)
