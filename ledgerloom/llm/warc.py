"""WARC archives: writing with revisit records, reading back, and a merged capture index.

Writing. Every page is one record. Of pages with equal payloads (SHA-1 and length,
at least ``min_bytes`` long) the one of largest id is a response, the others are
revisit records that refer to it and carry no payload. Every record is a gzip member
of its own, so one can be read from its offset. Members are rows of Spark's text sink,
with an empty member as line end, so archives lie on any file system Spark writes to,
and lost or repeated task attempts leave no file behind. An archive holds at most
``file_bytes`` of records (or one larger record) and ``records_per_file`` records.

Reading. Archive files are read whole, member by member, and parsed by the lengths in
their headers; every payload's digest is computed again and compared. Each archive's
captures are sorted by URL key and time and written: a run.

Index. The runs are merged externally: ranges of (URL key, time, id), as many as the
number of captures asks for, are dealt to tasks, a URL with any number of captures to as
many as it needs. A task gets its pieces of the k runs one after the other; they stay
Arrow columns, and of each piece only a block of ``BLOCK`` keys at a time is in the loser
tree that merges them. The result is in one global order, ``place``, so the captures of a
URL are its history.

Defined results: null html is an empty payload; a null url is written as an empty
one and has the URL key ``)/``; line breaks in a url are percent-encoded; of equal
rows with one id all are responses or all revisit; pages without an id never are
referred to while one with an id has the payload; an empty table gives an empty
index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path

from .common import saved
from .url_filters import host_and_path

FILE_BYTES = 32 << 20       # of an archive's records, uncompressed
RANGE_ROWS = 100_000        # captures merged by a task, about
MAX_RANGES = 8_192          # their sampled bounds go through the driver
BLOCK = 256                 # keys of a piece in the merge at once
_EMPTY = gzip.compress(b"", mtime=0)
_CRLF = "\r\n"
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_INDEX = ("urlkey string, captured string, page_id long, url string, payload_bytes long, "
          "payload_digest string, record_type string, refers_to long, archive string, "
          "record_at long")
_FIELDS = [f.split()[0] for f in _INDEX.split(", ")]


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four base32 digits."""
    code = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(code, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*quads)), _DIGITS, _BASE32)


def url_key(url: Column) -> Column:
    """Reversed host, then path and query: ``com,example,www)/path?query``."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?[^#]*", 0)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.lit(")"),
                    F.when(path == "", F.lit("/")).otherwise(path), query)


def decide(pages: DataFrame, min_bytes: int = 0, page_id: str = "page_id", url: str = "url",
           html: str = "html") -> DataFrame:
    """page_id, url, payload, its length and digest, and the response it repeats (null: none)."""
    body = F.coalesce(pages[html], F.lit(""))
    rows = pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"),
                        body.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")) \
        .withColumn("payload_digest", payload_digest(F.encode("payload", "UTF-8")))
    # digests alone; the largest id of each payload that has several
    named = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy(
        "payload_digest", "payload_bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    named = saved(named.filter("n > 1").drop("n"), "warc-payloads")
    joined = rows.join(named, ["payload_digest", "payload_bytes"], "left")
    repeats = F.col("first").isNotNull() & (~F.col("page_id").eqNullSafe(F.col("first")))
    return joined.withColumn("refers_to", F.when(repeats, F.col("first"))).drop("first")


def record(captured: Column) -> Column:
    """The text of a WARC record of a row of :func:`decide`."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))

    name = lambda c: F.concat(F.lit("<urn:x-page:"),
                              F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    target = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")),
                       F.lit("\n"), F.lit("%0A"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}"),
                    line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(_CRLF))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Target-URI", target),
        line("WARC-Date", captured),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", name("refers_to")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(_CRLF), http, F.when(revisit, F.lit("")).otherwise(F.col("payload")), F.lit(_CRLF * 2))


def _members(batches, file_bytes: int, records_per_file: int):
    """(record) -> its gzip member and the number of its archive among those of the task."""
    number = size = records = 0
    for batch in batches:
        members, files = [], []
        for row in range(batch.num_rows):
            raw = batch.column(0)[row].as_buffer()
            if records and (size + raw.size > file_bytes or records >= records_per_file):
                number, size, records = number + 1, 0, 0
            size, records = size + raw.size, records + 1
            members.append(gzip.compress(raw, 6, mtime=0))
            files.append(number)
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary()), pa.array(files, pa.int32())],
                                         names=["member", "file"])


def write_archives(pages: DataFrame, path: str, captured: Column | None = None, min_bytes: int = 0,
                   records_per_file: int = 4096, file_bytes: int = FILE_BYTES,
                   page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write ``pages`` as WARC files of gzip members below ``path``.

    ``captured``: the record's date as text, over (page_id, url, payload); by
    default a second per id after a fixed day, as pages carry no time.
    """
    rows = decide(pages, min_bytes, page_id, url, html)
    if captured is None:
        moment = F.timestamp_seconds(1_600_000_000 + F.coalesce("page_id", F.lit(0)) % 1_000_000_000)
        captured = F.date_format(F.to_utc_timestamp(moment, F.current_timezone()),
                                 "yyyy-MM-dd'T'HH:mm:ss'Z'")
    members = rows.select(record(captured).alias("record")).mapInArrow(
        lambda b: _members(b, file_bytes, records_per_file), "member binary, file int")
    # the sink writes a string's bytes as they are, and the line end in the given encoding
    members.select(F.col("member").cast("string").alias("value"), "file").write.partitionBy("file") \
        .option("encoding", "ISO-8859-1").option("lineSep", _EMPTY.decode("latin-1")).text(path)


def members(data: bytes, at: int = 0):
    """(start, content) of every gzip member of an archive from ``at`` on that is not empty."""
    while at < len(data):
        reader, out, end = zlib.decompressobj(31), [], at
        while not reader.eof:
            part = data[end:end + 65_536]
            if not part:
                raise ValueError(f"cut member at byte {at}")
            out.append(reader.decompress(part))
            end += len(part)
        content = b"".join(out)
        if content:
            yield at, content
        at = end - len(reader.unused_data)


def record_at(data: bytes, at: int) -> tuple[dict, bytes]:
    """Header fields and block of the record whose member begins at byte ``at`` of an archive."""
    _, content = next(members(data, at))
    _, fields, block = next(parse(content))
    return fields, block


def parse(data: bytes):
    """(start, header fields, block) of every record of uncompressed WARC content."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode().split(_CRLF)
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head[1:])
        size = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + size]
        if len(block) < size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"cut record at byte {at}")
        yield at, fields, block
        at = end + 8 + size


def _captures(name: str, data: bytes) -> list[tuple]:
    """Index rows of an archive, without their URL key."""
    named = lambda x: int(x[12:-1]) if len(x) > 13 else None  # noqa: E731  <urn:x-page:N>
    rows = []
    for at, (_, fields, block) in ((at, r) for at, content in members(data) for r in parse(content)):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n")
                    if x.startswith(b"Content-Length"))
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != digest or len(payload) != size:
                raise ValueError(f"{name}: the payload at byte {at} is not what its header says")
        rows.append((fields["WARC-Date"], named(fields["WARC-Record-ID"]),
                     fields["WARC-Target-URI"], size, digest, kind,
                     named(fields["WARC-Refers-To"]) if kind == "revisit" else None, name, at))
    return rows


def _read(batches):
    names = [f for f in _FIELDS if f != "urlkey"]
    for batch in batches:
        for row in range(batch.num_rows):
            rows = _captures(batch.column(0)[row].as_py(), batch.column(1)[row].as_py())
            columns = list(zip(*rows)) or [[] for _ in names]
            kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(),
                     "record_at": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns)], names=names)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of the archives below ``path``, digests verified."""
    files = spark.read.format("binaryFile").load(path).select(
        F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("archive"), "content")
    schema = ", ".join(f for f in _INDEX.split(", ") if not f.startswith("urlkey"))
    rows = files.mapInArrow(_read, schema)
    return rows.select(url_key(F.col("url")).alias("urlkey"), *_FIELDS[1:])


class LoserTree:
    """Merges k sorted lists; each step replays one path of matches, log2 k comparisons."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.losers = [-1] * self.k         # [0]: the winner; -1: a match not yet played
        for run in range(self.k):
            self._play(run)

    def _head(self, run: int):
        run_rows, at = self.runs[run], self.at[run]
        return (0, self.key(run_rows[at]), run) if at < len(run_rows) else (1, None, run)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        return x[0] < y[0] if x[0] or y[0] else x < y

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node:
            other = self.losers[node]
            if other == -1:                 # the first to come waits for its opponent
                self.losers[node] = run
                return
            if self._beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self):
        while self.k:
            run = self.losers[0]
            if self.at[run] >= len(self.runs[run]):
                return
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self._play(run)


class Piece:
    """Rows ``start`` to ``end`` of a sorted table as a list of keys; one block of them is held.

    A key is URL key and time, then id (null first), the record's place, and the row.
    """

    def __init__(self, table: pa.Table, start: int, end: int):
        self.columns = [table.column(c) for c in ("urlkey", "captured", "page_id", "archive", "record_at")]
        self.start, self.end, self.first, self.block = start, end, 0, []

    def __len__(self) -> int:
        return self.end - self.start

    def __getitem__(self, i: int) -> tuple:
        if not self.first <= i < self.first + len(self.block):
            n = min(BLOCK, len(self) - i)
            self.first, at = i, self.start + i
            self.block = [(key, time, page is not None, page or 0, archive, place, at + k)
                          for k, (key, time, page, archive, place) in enumerate(
                              zip(*(c.slice(at, n).to_pylist() for c in self.columns)))]
        return self.block[i - self.first]


def _merge(batches):
    """Pieces of sorted runs, one after the other, to one sorted sequence with its places."""
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    named = table.column("archive").combine_chunks().dictionary_encode().indices.to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(named)) + 1).tolist(), len(named)]
    pieces = [Piece(table, a, b) for a, b in zip(cuts, cuts[1:])]
    place, rows = TaskContext.get().partitionId() << 33, []
    for i, key in enumerate(LoserTree(pieces, lambda k: k)):
        rows.append(key[-1])
        if len(rows) == 10_000 or i + 1 == len(named):
            part = table.take(pa.array(rows)).combine_chunks().to_batches()[0]      # one chunk a column
            places = pa.array(np.arange(place + i + 1 - len(rows), place + i + 1))
            yield pa.RecordBatch.from_arrays([*part.columns, places], names=[*part.schema.names, "place"])
            rows = []


def merge_runs(captures: DataFrame) -> DataFrame:
    """The capture index: all captures in one order by URL key and time, with ``place``."""
    order = ["urlkey", "captured", "page_id", "archive", "record_at"]
    # an archive is read by one task, so its run needs no shuffle
    runs = saved(captures.sortWithinPartitions("archive", *order),
                 "warc-runs")
    spark = captures.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 min(MAX_RANGES, -(-runs.count() // RANGE_ROWS)))
    dealt = runs.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order)
    return dealt.mapInArrow(_merge, _INDEX + ", place long")


def archive_and_index(pages: DataFrame, path: str | None = None, min_bytes: int = 0,
                      **columns) -> DataFrame:
    """Write ``pages`` as archives (to the shared folder by default), read them, merge the index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "llm-warc")
    write_archives(pages, path, min_bytes=min_bytes, **columns)
    return merge_runs(read_captures(spark, path))
