"""WARC archives of pages, and their index by external merge.

Writing: a record is built as one string by column expressions and written by
Spark's text writer, whose line separator is the two line ends that close a
record; so archives go wherever Spark writes. Of records with equal payloads
(of at least ``min_bytes``) the one with the largest page_id is a response,
the others are revisits that name it. A record id is a UUID that holds the
page_id, so it can be read back.

Reading: archives are decompressed and parsed as a stream. Payload length and
digest of a response are measured on its bytes; a revisit has them in its
headers. Each archive becomes one capture run, locally sorted by URL key,
timestamp and page_id, in the shared folder. The runs are dealt out by ranges
of that whole key, so the captures of one URL may span tasks. A range takes
each archive's captures as ascending runs, begins a new run wherever the order
breaks (an archive's run may have been read by several tasks), keeps what does
not fit into ``HELD_BYTES`` in files of its own, and merges the runs with a
loser tree: the parts, in order, are the globally ordered capture histories.

Defined cases: a null payload is an empty one; a null URL has no target header
and an empty URL key; a row with a null page_id is a response without page id
in its record id; of repeated rows with the largest page_id each is a
response; each payload of a page_id that comes with several is a response or
revisit of its own; payloads of more than ``SMALL_BYTES`` are in archives with
fewer records, so that an archive holds about ``ARCHIVE_BYTES`` at most; page
ids that are ``SPAN`` apart share a date; an empty table gives no captures;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import tempfile
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.common import map_batches, pick, scratch, written

END = "\r\n"
#: Bytes of an archive before compression, and of a payload of which it holds ``RECORDS_PER_FILE``.
ARCHIVE_BYTES, RECORDS_PER_FILE = 1 << 30, 4096
SMALL_BYTES = ARCHIVE_BYTES // RECORDS_PER_FILE
#: Bytes of captures that a range keeps in memory; more go to files of the task.
HELD_BYTES = 64 << 20
#: Captures without a date of their own count seconds from here (2024-01-01T00:00:00Z) by page_id.
FIRST_SECOND = 1_704_067_200
SPAN = 1 << 28
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: RFC 4648 digits, and those of base 32 as ``conv`` writes them.
BASE32, CONV32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"

CAPTURE = (
    "url_key string, timestamp string, page_id long, url string, record_type string, payload_bytes long,"
    " payload_digest string, refers_to long, archive string, record_offset long"
)
NAMES = [c.split()[0] for c in CAPTURE.split(",")]


# --- writing -------------------------------------------------------------------

def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four times 40 bits as eight digits."""
    h = F.sha1(payload.cast("binary"))
    return F.translate(F.concat(*[F.lpad(F.conv(F.substring(h, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]), CONV32, BASE32)


def record_id(page_id: Column) -> Column:
    """A version 8 UUID that holds the page_id: two bits, then 62."""
    x = F.lower(F.lpad(F.hex(page_id), 16, "0"))
    top = F.conv(F.substring(x, 1, 1), 16, 10).cast("int")
    high = F.lower(F.hex(F.shiftright(top, 2)))
    variant = F.lower(F.hex(F.lit(8) + top.bitwiseAND(3)))
    known = F.concat(F.lit("00000000-0001-800"), high, F.lit("-"), variant, F.substring(x, 2, 3), F.lit("-"), F.substring(x, 5, 12))
    return F.concat(F.lit("<urn:uuid:"), F.coalesce(known, F.lit("00000000-0000-8000-8000-000000000000")), F.lit(">"))


def page_of(record: str) -> int | None:
    """The page_id that a record id holds."""
    d = record.strip("<>").removeprefix("urn:uuid:").replace("-", "")
    if d[11] == "0":
        return None
    x = (int(d[15], 16) << 62) | ((int(d[16], 16) & 3) << 60) | int(d[17:], 16)
    return x - (1 << 64) if x >> 63 else x


def _date(page_id: Column) -> Column:
    second = F.timestamp_seconds(F.lit(FIRST_SECOND) + F.coalesce(F.pmod(page_id, F.lit(SPAN)), F.lit(0)))
    return F.date_format(F.to_utc_timestamp(second, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _line(name: str, value: Column) -> Column:
    """One header line, none for a null; control characters cannot break it."""
    safe = F.regexp_replace(value, r"[\x00-\x1F\x7F]", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(END)), F.lit(""))


def records(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(value): a WARC record for each page, without the two line ends after it."""
    pages = pages.withColumn("n", F.octet_length("payload")).withColumn("same", F.sha2(F.col("payload").cast("binary"), 256))
    kinds = pages.select("page_id", "url", "same", "n")
    kinds = kinds.where((F.col("n") >= min_bytes) & F.col("page_id").isNotNull())
    first = F.max_by(F.struct(F.col("page_id").alias("refers_to"), F.col("url").alias("refers_url")), "page_id")
    firsts = kinds.groupBy("same").agg(first.alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    later = kinds.join(written(firsts, "first-records"), "same").where("page_id <> first.refers_to")
    later = later.select("page_id", "same", "first.*").distinct()
    p = pages.join(later, ["page_id", "same"], "left")  # a page_id may come with several payloads
    digest, again = F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))), F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("n").cast("string"), F.lit(END + END)
    )
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", record_id(F.col("page_id"))),
        _line("WARC-Date", _date(F.col("page_id"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", digest),
        _line("WARC-Profile", F.when(again, PROFILE)),
        _line("WARC-Refers-To", F.when(again, record_id(F.col("refers_to")))),
        _line("WARC-Refers-To-Target-URI", F.when(again, F.col("refers_url"))),
        _line("WARC-Refers-To-Date", F.when(again, _date(F.col("refers_to")))),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
    )
    return p.select(F.concat(head, block).alias("value"), "n")


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> None:
    """Compressed archives of all pages as files in ``path``, of bounded records and bytes."""
    p = pick(pages, page_id=id_col, url=url_col, payload=payload_col)
    p = p.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("payload").cast("string"), F.lit("")).alias("payload"),
    )
    # Sizes of payloads, in powers of two from the small ones up: one write for each there is.
    half = lambda n: F.greatest(F.ceil(F.log2(F.greatest(n, F.lit(1)) / SMALL_BYTES)), F.lit(0)).cast("int")
    sizes = [r.size for r in p.select(half(F.octet_length("payload")).alias("size")).distinct().collect()]  # at most 13
    out = records(p, min_bytes)
    for size in sorted(sizes):
        own = out.where(half(F.col("n")) == size).select("value") if len(sizes) > 1 else out.select("value")
        own = own.write.mode("append").option("lineSep", END + END).option("compression", "gzip")
        own.option("maxRecordsPerFile", max(1, RECORDS_PER_FILE >> size)).text(path)
    if not sizes:
        out.select("value").write.mode("append").text(path)


# --- reading -------------------------------------------------------------------

class Inflated:
    """Reads a gzip byte string, of one or many members, piece by piece."""

    def __init__(self, data: bytes, step: int = 1 << 16):
        self.data, self.at, self.step, self.ready = memoryview(data), 0, step, bytearray()
        self.unzip, self.offset = zlib.decompressobj(31), 0

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        if self.unzip.eof:
            self.unzip = zlib.decompressobj(31)
        chunk = self.data[self.at : self.at + self.step]
        self.ready += self.unzip.decompress(chunk)
        self.at += len(chunk) - len(self.unzip.unused_data)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """All up to and with ``mark``; None at the end."""
        seen = 0
        while (i := self.ready.find(mark, seen)) < 0:
            seen = max(0, len(self.ready) - len(mark) + 1)
            if not self._more():
                return None
        return self.take(i + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.ready) < n and self._more():
            pass
        got = bytes(self.ready[:n])
        if len(got) < n:
            raise ValueError("the archive ends inside a record")
        del self.ready[:n]
        self.offset += n
        return got


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split(END)[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def url_key(url: str) -> str:
    """The URL with its host's labels reversed: ``com,example)/path?query``, in lower case."""
    try:
        u = urlsplit(url.strip().lower())
        host, port = u.hostname or "", f":{u.port}" if u.port else ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    return ",".join(reversed(host.removeprefix("www.").split("."))) + port + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def parse_archive(name: str, data: bytes) -> Iterator[tuple]:
    """The captures of one archive, in the order of its records."""
    stream = Inflated(data)
    while True:
        start = stream.offset
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        h = parse_headers(head)
        block = stream.take(int(h["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"{name}: record at {start} does not end where its length says")
        http, _, payload = block.partition(b"\r\n\r\n")
        digest, n = h["warc-payload-digest"].removeprefix("sha1:"), int(parse_headers(http)["content-length"])
        if h["warc-type"] == "response":
            measured = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if (measured, len(payload)) != (digest, n):
                raise ValueError(f"{name}: payload at {start} does not match its digest or length")
        url, refers = h.get("warc-target-uri", ""), h.get("warc-refers-to")
        stamp = re.sub(r"\D", "", h["warc-date"])
        yield url_key(url), stamp, page_of(h["warc-record-id"]), url, h["warc-type"], n, digest, page_of(refers) if refers else None, name, start


def run_order(capture: tuple) -> tuple:
    """What a run is sorted by: URL key, timestamp, page_id (null first), place in the archive."""
    return capture[0], capture[1], -(1 << 64) if capture[2] is None else capture[2], capture[8], capture[9]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


SCHEMA = pa.schema([(n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to", "record_offset") else pa.string()) for n in NAMES])


def read_runs(spark, path: str) -> DataFrame:
    """One locally sorted run of captures per archive, in the shared folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def parse(batches):
        for b in batches:
            for name, data in zip(*b.columns):
                run = sorted(parse_archive(name.as_py().rpartition("/")[2], data.as_py()), key=run_order)
                for at in range(0, len(run), 1 << 13):
                    yield _batch(run[at : at + (1 << 13)], SCHEMA)

    return written(map_batches(files, parse, CAPTURE), "capture-runs")


class LoserTree:
    """Merges k sorted iterators; each step replays one path of the tree."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.loser = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        if a < 0 or b < 0:
            return a < 0  # -1: a run not entered yet wins, so that all get in
        x, y = self.keys[a], self.keys[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            if self._beats(self.loser[node], winner):
                winner, self.loser[node] = self.loser[node], winner
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            w = self.loser[0]
            if self.keys[w] is None:
                return
            yield self.heads[w]
            head = next(self.runs[w], None)
            self.heads[w], self.keys[w] = head, None if head is None else self.key(head)
            self._play(w)


class Runs:
    """Ascending runs of captures as they come in, in memory up to a bound, then in files."""

    def __init__(self, folder: str, held_bytes: int):
        self.folder, self.held_bytes = folder, held_bytes
        self.runs: list[list] = []  # of each run: batches in memory, its file's writer, its last key
        self.open: dict[str, int] = {}  # archive -> its run that may go on
        self.bytes = 0

    def add(self, captures: pa.RecordBatch) -> None:
        keys = [run_order(r) for r in zip(*[c.to_pylist() for c in captures.columns])]
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i][3] != keys[start][3] or keys[i] < keys[i - 1]:
                self._append(keys[start], keys[i - 1], captures.slice(start, i - start))
                start = i
        if self.bytes > self.held_bytes:
            self._to_files()

    def _append(self, first: tuple, last: tuple, captures: pa.RecordBatch) -> None:
        at = self.open.get(first[3])
        if at is None or self.runs[at][2] > first:
            at = self.open[first[3]] = len(self.runs)
            self.runs.append([[], None, last])
        run = self.runs[at]
        run[0].append(captures)
        run[2] = last
        self.bytes += captures.get_total_buffer_size()

    def _to_files(self) -> None:
        for i, run in enumerate(self.runs):
            if run[0]:
                run[1] = run[1] or pa.ipc.new_stream(f"{self.folder}/{i}", SCHEMA)
                for b in run[0]:
                    run[1].write_batch(b)
                run[0] = []
        self.bytes = 0

    def _rows(self, i: int) -> Iterator[tuple]:
        held, writer, _ = self.runs[i]
        batches = held
        if writer is not None:
            writer.close()
            batches = chain(pa.ipc.open_stream(pa.memory_map(f"{self.folder}/{i}")), held)
        for b in batches:
            yield from zip(*[c.to_pylist() for c in b.columns])

    def merged(self) -> Iterator[tuple]:
        return iter(LoserTree([self._rows(i) for i in range(len(self.runs))], run_order))


def merge_runs(runs: DataFrame) -> DataFrame:
    """The captures in global order: ``part`` and ``nth`` within it give the place."""

    def merge(batches):
        schema = SCHEMA.append(pa.field("part", pa.int32())).append(pa.field("nth", pa.int64()))
        part, nth, held = TaskContext.get().partitionId(), 0, []
        with tempfile.TemporaryDirectory() as folder:
            own = Runs(folder, HELD_BYTES)
            for b in batches:
                own.add(pa.RecordBatch.from_arrays(b.columns, schema=SCHEMA))
            for capture in own.merged():
                held.append((*capture, part, nth))
                nth += 1
                if len(held) == 1 << 13:
                    yield _batch(held, schema)
                    held = []
        if held:
            yield _batch(held, schema)

    ranges = runs.repartitionByRange("url_key", "timestamp", "page_id", "archive", "record_offset")
    return map_batches(ranges, merge, f"{CAPTURE}, part int, nth long")


def archive_and_index(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Writes the archives (to ``path``, or a new shared folder), reads them back, returns their merged index."""
    spark = pages.sparkSession
    path = path or scratch(spark, "archives")
    write_archives(pages, path, **columns)
    return merge_runs(read_runs(spark, path))
