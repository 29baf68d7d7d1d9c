"""Web archives: WARC records written and read back by Spark, and one capture index merged from sorted runs."""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import Scratch, arrow_schema, bounded_sample, ship, shuffle_partitions

# The format's line ends and record end, and the least payload that is worth a revisit record.
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
LEAST_REVISIT = 100
# Records of an archive file, and index entries that one merge task orders, about.
FILE_RECORDS = 4000
RANGE_ENTRIES = 20_000
# Copies of the first capture of a payload, so that a hot payload's rows spread over as many tasks.
SALTS = 16
# Captures without a time of their own are a second apart, from here on.
EPOCH = 1_000_000_000


def warc_records(pages: DataFrame) -> DataFrame:
    """The text of one record per row of `pages` (page_id, url, html), without the end mark.

    Of rows with equal payloads of at least LEAST_REVISIT bytes, the one with the smallest page_id becomes a
    response, the others revisits of it, without the payload. Null html is an empty payload. Null ids come
    after all others; equal ids are ordered by url, and rows equal in both by their place in the table. Line
    ends in a url are percent-encoded.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("n"),
        F.monotonically_increasing_id().alias("uid"),
    )
    order = F.struct(
        F.col("page_id").isNull().alias("late"),
        F.coalesce("page_id", F.lit(0)).alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.col("uid"),
    )
    # Summed before the shuffle; only payloads that occur again go on.
    firsts = (
        rows.filter(F.col("n") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("times"))
        .filter("times > 1")
        .select(F.col("digest").alias("_d"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    dealt = rows.withColumn("_k", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(firsts, (F.col("digest") == F.col("_d")) & (F.col("_k") == F.col("_salt")), "left")
    again = F.col("first").isNotNull() & (F.col("first.uid") != F.col("uid"))

    def record_id(late, page_id, uid):
        return F.concat(F.lit("<urn:capture:"), F.when(~late, page_id.cast("string")).otherwise(F.lit("")), F.lit(":"), uid.cast("string"), F.lit(">"))

    def line(name: str, value):
        return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))

    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    time = F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(EPOCH)))
    stamp = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), time.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("n").cast("string"),
        F.lit(RECORD_END),
    )
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id").isNull(), F.col("page_id"), F.col("uid"))),
        line("WARC-Target-URI", url),
        line("WARC-Date", stamp),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            again,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", record_id(F.col("first.late"), F.col("first.page_id"), F.col("first.uid"))),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return joined.select(F.concat(header, F.lit(CRLF), block).alias("value"))


def write_warc(pages: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Gzipped archives in `path`, through Spark's text writer: the record end is its line end, so what it writes
    are plain WARC files. A file holds at most `file_records` records."""
    writer = warc_records(pages).write.option("lineSep", RECORD_END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", file_records).text(path)


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then path and query: captures of a site sort side by side."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    if not host:
        return url
    labels = host.removeprefix("www.").split(".")
    standard = port is None or (parts.scheme, port) in (("http", 80), ("https", 443))
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(labels))}{'' if standard else f':{port}'}){parts.path or '/'}{query}"


class RecordStream:
    """Bytes in, records out: (offset, header lines, block) as soon as a record is whole, by its Content-Length."""

    def __init__(self) -> None:
        self.buffer, self.offset = bytearray(), 0

    def feed(self, data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
        self.buffer += data
        while True:
            # A reader that cuts at record ends cannot tell how a file ended; line ends left over are no record.
            while self.buffer.startswith(b"\r\n"):
                del self.buffer[:2]
                self.offset += 2
            end = self.buffer.find(b"\r\n\r\n")
            if end < 0:
                return
            first, *lines = self.buffer[:end].decode().split(CRLF)
            if not first.startswith("WARC/"):
                raise ValueError(f"no WARC record at byte {self.offset}: {first[:60]!r}")
            header = dict(x.split(": ", 1) for x in lines)
            start, size = end + 4, int(header["Content-Length"])
            if len(self.buffer) < start + size + 4:
                return
            block = bytes(self.buffer[start : start + size])
            if self.buffer[start + size : start + size + 4] != b"\r\n\r\n":
                raise ValueError(f"record at byte {self.offset} is longer than it says")
            yield self.offset, header, block
            del self.buffer[: start + size + 4]
            self.offset += start + size + 4

    def close(self) -> None:
        if self.buffer:
            raise ValueError(f"{len(self.buffer)} bytes after the last whole record")


def _id_of(record_id: str) -> int | None:
    page = record_id.removeprefix("<urn:capture:").split(":")[0]
    return int(page) if page else None


ENTRY = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url_key string, captured string, file string, offset long"
)
ENTRY_NAMES = arrow_schema(ENTRY).names


def _entry(file: str, offset: int, header: dict[str, str], block: bytes) -> tuple:
    """What the index keeps of a record; a payload that does not match its digest is an error."""
    head, _, payload = block.partition(b"\r\n\r\n")
    told = int(head.decode().rsplit("Content-Length: ", 1)[1].split(CRLF)[0])
    digest = header["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = header["WARC-Type"]
    if kind == "response" and (len(payload) != told or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{file}: payload at byte {offset} does not match its digest")
    captured = "".join(x for x in header["WARC-Date"] if x.isdigit())
    refers = _id_of(header["WARC-Refers-To"]) if kind == "revisit" else None
    return _id_of(header["WARC-Record-ID"]), told, digest, kind, refers, url_key(header.get("WARC-Target-URI")), captured, file, offset


def order_key(entry: tuple) -> tuple:
    """URL key, capture time, then page (null last) and place, so that no two entries tie."""
    return entry[5], entry[6], entry[0] is None, entry[0] or 0, entry[7], entry[8]


RUN = "range int, run string, entries binary"


def _runs(splitters: list[tuple]):
    """Each archive becomes a run: its index entries in order, cut where a merge range ends."""
    schema = arrow_schema(RUN)

    def cut(entries: list[tuple]) -> Iterator[tuple]:
        entries.sort(key=order_key)
        at = 0
        while at < len(entries):
            part = bisect_right(splitters, order_key(entries[at]))
            upto = len(entries)
            if part < len(splitters):
                upto = bisect_left(entries, splitters[part], lo=at + 1, key=order_key)
            yield part, entries[at][7], json.dumps(entries[at:upto]).encode()
            at = upto

    def run(batches):
        file, stream, entries = None, RecordStream(), []

        def finish():
            stream.close()
            for row in cut(entries):
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema=schema)

        for batch in batches:
            for name, value in zip(batch.column("file").to_pylist(), batch.column("value"), strict=True):
                if name != file:
                    if file is not None:
                        yield from finish()
                    file, stream, entries = name, RecordStream(), []
                for offset, header, block in stream.feed(value.as_py() + RECORD_END.encode()):
                    entries.append(_entry(file, offset, header, block))
        if file is not None:
            yield from finish()

    return run


class LoserTree:
    """k-way merge of sorted lists. Every inner node keeps the loser of its match, so taking the next item
    replays only the matches on the path from the winner's leaf: one comparison per level."""

    def __init__(self, runs: list[list[tuple]], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.heads = [key(r[0]) if r else None for r in runs]
        self.losers = [-1] * max(1, self.k)
        self.winner = self._play(1) if self.k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def _play(self, node: int) -> int:
        """Winner below the node; leaves are numbered k to 2k - 1."""
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if not self._beats(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            w = self.winner
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.heads[w] = self.key(self.runs[w][self.at[w]]) if self.at[w] < len(self.runs[w]) else None
            node = (w + self.k) // 2
            while node >= 1:
                if self._beats(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


HISTORY = ENTRY + ", range int, position int"


def _merge(table: pa.Table) -> pa.Table:
    runs = [[tuple(e) for e in json.loads(x)] for x in table.column("entries").to_pylist()]
    merged = list(LoserTree(runs, order_key))
    part = table.column("range")[0].as_py()
    columns = list(zip(*merged, strict=True)) + [[part] * len(merged), range(len(merged))]
    schema = arrow_schema(HISTORY)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _splitters(pages: DataFrame, ranges: int, files: list[str], per_cut: int, per_range: int = 20) -> list[tuple]:
    """Bounds of the merge ranges by `order_key`, from a sample of bounded size; they only balance the tasks.

    Rows are sampled by their place in the table, so that equal rows are in the sample by their number. Rows that
    share URL key, time and page, as those without url and id do, differ only in their place: where they fill
    more than a range, they are cut at every `per_cut`-th archive.
    """
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))  # as in the records
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.monotonically_increasing_id().alias("uid"))

    def key(page: int | None, url: str | None) -> tuple:
        time = datetime.fromtimestamp(EPOCH + (page or 0) % EPOCH, UTC)
        return url_key(url), time.strftime("%Y%m%d%H%M%S"), page is None, page or 0

    keys = sorted(key(r["page_id"], r["url"]) for r in bounded_sample(rows, ["uid"], ranges * per_range).collect())
    bounds = Counter(keys[i * len(keys) // ranges] for i in range(1, ranges)) if keys else {}
    cuts = sorted(files)[::per_cut]
    return sorted((*k, file, -1) for k, n in bounds.items() for file in ("", *(cuts if n > 1 else ())))


def capture_history(spark: SparkSession, path: str, splitters: list[tuple]) -> DataFrame:
    """The archives' capture index in global order: by `range`, then `position`.

    Every archive is read once, as a stream, and gives a sorted run. Ranges of `order_key` are merged
    apart from each other, each by a loser tree over the runs' cuts, so no task sees more than its range. A URL
    with many captures spreads over as many ranges.
    """
    ship(spark)
    lines = (
        spark.read.option("lineSep", RECORD_END)
        .text(path)
        .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_name").alias("file"))
    )
    runs = lines.mapInArrow(_runs(splitters), RUN)
    return runs.groupBy("range").applyInArrow(_merge, HISTORY)


def archived_pages(pages: DataFrame, scratch: Scratch | None = None, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """Writes a record per row of `pages`, reads the archives back and merges their index: page_id,
    payload_bytes, payload_digest, record_type, refers_to, then the index columns of `capture_history`.

    Rows with null id, url or html keep their record, see `warc_records`; other columns are not read. An empty
    table gives an empty one. The archives stay in the shared folder.
    """
    spark = pages.sparkSession
    scratch = scratch or Scratch(spark, "warc")
    path = scratch.path()
    write_warc(pages, path)
    ranges = max(shuffle_partitions(spark), pages.count() // range_entries)
    files = [f.rpartition("/")[2] for f in spark.read.text(path).inputFiles()]
    return capture_history(spark, path, _splitters(pages, ranges, files, max(1, range_entries // FILE_RECORDS)))
