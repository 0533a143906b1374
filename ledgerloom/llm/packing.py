"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Tokens. A document is its ids followed by one end id. A document longer than the
capacity is cut into full pieces, of which the first may be shorter.

Bulk-synchronous best-fit (decreasing). Pieces of one length are interchangeable,
and so are gaps of one size, so the range-sorted pieces and gaps are held as runs:
at most one run of pieces per length, whatever the number of documents.

* Range sort: pieces are range-partitioned and sorted by length; the position in
  a partition and the counts of the partitions before give each piece its rank in
  its run. A hot length spans partitions, nothing is gathered.
* Superstep: the next run of pieces, longest first, sweeps to the successor of its
  length among the gaps (the smallest gap that holds it), then to the next larger
  gap, until its pieces are placed. Where more pieces than bins meet, rank decides:
  lower ranks get the bins, the rest sweep on. Pieces that no gap holds open bins.
  Then the gaps of the bins used are updated, and the next superstep begins.
* Placement: a superstep's outcome is a few rows (length, ranks from .. to, bins
  from .., offset). They are joined to the pieces by length and rank in parallel.

The sweeps run over the run table on the driver: it has at most ``capacity`` runs
of pieces, and its outcome depends on how many different fillings there are, not
on the number of documents. Reruns give the same packing.

Defined results: a null text is empty, its document is the end id alone; repeated
rows are documents of their own; null ids are kept; an empty table packs nothing.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_side

CAPACITY, END_ID = 2048, 0
CACHE_CHUNKS = 300_000      # chunks whose ids a Python worker keeps,
CACHE_LENGTH = 48           # of so many characters at most


def tokenizer_files() -> tuple[str, str]:
    """Default vocabulary: as a tokenizers file, and as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of a text as little-endian 32-bit integers, equal to those of ``tokenizers``.

    The vocabulary's pattern never joins characters across a single blank between
    two non-blanks, so a text without runs of white space is the concatenation of
    its blank-separated chunks, and a chunk's ids are computed once. Other texts are
    encoded whole, and those that hold a special token's string by ``tokenizers``.
    """

    _RUN = re.compile(r"\s\s")

    def __init__(self, files: tuple[str, str]):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(files[0])
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        with open(files[1], "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.fast.encode_ordinary(text)).tobytes()

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()
        if self._RUN.search(text) or text[0] == " " or text[-1] == " ":
            return self._whole(text)
        first, *rest = text.split(" ")
        known = self.known
        out = [self._whole(first)]
        for chunk in rest:
            ids = known.get(chunk)
            if ids is None:
                if len(known) >= CACHE_CHUNKS:
                    known.clear()
                ids = self._whole(" " + chunk)
                if len(chunk) <= CACHE_LENGTH:
                    known[chunk] = ids
            out.append(ids)
        return b"".join(out)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    head = n % capacity if n > capacity else n
    starts = [*([0] if head else []), *range(head, n, capacity)]
    return [(s, min(head, n) if s == 0 and head else capacity) for s in starts]


def pieces(docs: DataFrame, capacity: int = CAPACITY, files: tuple[str, str] | None = None,
           doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids) of every document's pieces."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        encoder = Encoder(files or tokenizer_files())
        end = array("I", [END_ID]).tobytes()
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                rows, out = [], []
                for r, body in enumerate(batch.column(1).to_pylist()):
                    ids = encoder.ids(body or "") + end
                    for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * s:4 * (s + n)]
                        rows.append(r)
                        out.append((k, s, n, zlib.crc32(part), part if with_ids else b""))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(columns[0], pa.int32()),
                     *(pa.array(c, pa.int64()) for c in columns[1:4]),
                     *([pa.array(columns[4], pa.binary())] if with_ids else [])],
                    names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, "
                             "ids_crc32 long" + (", ids binary" if with_ids else ""))


def ranked(items: DataFrame) -> DataFrame:
    """Written ``items`` range-sorted by length, with ``rank`` (from 0) among equal lengths."""
    order = ["length", "doc_id", "piece"]
    placed = saved(items.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("at", F.monotonically_increasing_id()), "pack-sorted")
    part = F.shiftright("at", 33)
    heads = placed.groupBy("length", part.alias("part")).agg(
        F.min("at").alias("head"), F.count("*").alias("n"))
    w = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per partition and length met there: partitions + capacity rows
    heads = saved(heads.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))), "pack-heads")
    near = small_side(heads, 200_000).select("length", "part", "head", "before")
    return placed.withColumn("part", part).join(near, ["length", "part"]).withColumn(
        "rank", F.col("at") - F.col("head") + F.col("before")).drop("at", "part", "head", "before")


def sweep(runs: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Supersteps over runs of (length, pieces): rows (length, from, to, bin, per_bin, offset).

    Ranks from .. to - 1 go to bins ``bin + (rank - from) // per_bin``, the k-th of a
    bin at ``offset + k * length``.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}     # size -> runs of bins (first, number)
    sizes: list[int] = []
    bins = 0

    def give(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    for length, left in sorted(runs, reverse=True):
        rank = 0
        updates: list[tuple[int, int, int]] = []
        while left:
            at = bisect.bisect_left(sizes, length)      # successor of the length
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            per_bin = gap // length
            used = min(left, n * per_bin)
            out.append((length, rank, rank + used, first, per_bin, capacity - gap))
            full, over = divmod(used, per_bin)
            updates.append((gap - per_bin * length, first, full))
            if over:
                updates.append((gap - over * length, first + full, 1))
            rest = n - full - (1 if over else 0)
            updates.append((gap, first + n - rest, rest))
            rank, left = rank + used, left - used
        for gap, first, n in updates:
            give(gap, first, n)
    return out


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written pieces (from :func:`pieces`) with sequence_id and offset."""
    runs = [(r[0], r[1]) for r in items.groupBy("length").count().collect()]   # <= capacity rows
    plan = sweep(runs, capacity)
    spark = items.sparkSession
    steps = spark.createDataFrame(
        [tuple(int(x) for x in row) for row in plan],
        "_len long, _from long, _to long, _bin long, _per long, _off long")
    rows = ranked(items)
    at = F.col("rank") - F.col("_from")
    # as many steps as there are different fillings of a bin's part by one length: a few per
    # length, whatever the number of documents
    joined = rows.join(F.broadcast(steps), (F.col("length") == F.col("_len"))
                       & (F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to")))
    return joined.withColumn("sequence_id", F.col("_bin") + F.floor(at / F.col("_per"))) \
        .withColumn("offset", F.col("_off") + F.pmod(at, F.col("_per")) * F.col("length")) \
        .select(*items.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, files: tuple[str, str] | None = None,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Where every piece of every document of ``docs`` goes; ids as their CRC-32."""
    return pack(saved(pieces(docs, capacity, files, doc_id, text), "pack-pieces"), capacity)


def token_sequences(docs: DataFrame, capacity: int = CAPACITY,
                    files: tuple[str, str] | None = None, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, n_ids, ids (32-bit little-endian).

    A sequence gathers at most ``capacity`` ids.
    """
    items = saved(pieces(docs, capacity, files, doc_id, text, with_ids=True), "pack-ids")
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return pack(items, capacity).groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(0).cast("long"),
                                   lambda a, p: a + p["length"]).alias("n_ids"),
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
