"""Phrase collocations: frequent n-grams by Misra-Gries summaries, exact counts, cohesion.

First pass. Every task counts the n-grams of 1 to ``max_words`` words it holds, some
millions at a time, by a 64-bit hash of language and words. The upper bits of the hash
name a hash partition; what a task knows of one partition is an exact summary (hashes
and counts), and these are shuffled and merged by partition. A merged summary holds at
most c counters, c being the partition's mass (its n-gram occurrences) divided by the
threshold: beyond that the (c+1)-th largest count is taken from all counters and the
emptied ones go. Each such step takes that count from more than c counters at once, so
all steps together take less than the threshold from any one, and every n-gram that
occurs ``min_count`` times or more survives. A survivor whose counter and all that was
taken together stay below the threshold goes too. Masses travel ahead of the summaries, so
c is known before the first merge.

Between the passes the survivors become a bit filter of fixed size
(``filter_bits``): each hash partition sets bits in its own slice. That is all the
driver ever sees; with more survivors the filter lets more n-grams pass, never fewer.

Second pass. N-grams that pass the filter, and whose parts pass, are counted exactly,
by their words, in every task; the counts of a hash partition of phrases meet in one
place and are summed; those below the threshold go.

Parts of a frequent phrase are at least as frequent as the phrase, so the counts that
scoring needs are in the same table. A cut of a phrase after k words scores
``floor(1000 * a * n / (l * r))`` in 38-digit decimals. Candidates that a longer
candidate contains and (nearly) always accompanies are dropped.

Defined results: null texts have no words; a null language is ``und``; texts without
blanks or punctuation are one word; repeated rows count again; no id is needed; an
empty table, or one without frequent phrases, gives an empty result; other columns,
whatever they are called, play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, small_side, text_slices

SLICE_BYTES = 3 << 20           # text counted at once inside a task: about 230 MB of arrays
PARTITION_BYTES = 1 << 20       # text per hash partition, about, up to
MOST_PART_BITS = 16             # so many partitions: a task's summaries stay long rows
HELD_KEYS = 2_000_000           # distinct n-grams that a task counts before it sends them
HELD_ROWS = 400_000             # the same of phrases, in the second pass
MAX_LANGUAGES = 100_000         # whose word counts may be broadcast
_ENDS, _BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(_BLANKS)], _CLASS[list(_ENDS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + (b >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class _Slice:
    """The words of a slice of documents: ids, languages, and words left in each one's piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        import xxhash

        blobs = [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]
        raw = _LOWER[np.frombuffer(b"".join(blobs), np.uint8)]
        offsets = np.cumsum([0, *map(len, blobs)])
        kind = _CLASS[raw]
        inside = kind == 0
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins = inside.copy()                              # texts do not run into each other
        begins[1:] &= ~inside[:-1]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        begins[:] = inside
        begins[:-1] &= ~inside[1:]
        begins[heads[1:] - 1] = inside[heads[1:] - 1]
        sizes = np.flatnonzero(begins) + 1 - starts
        flat = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)])), pa.py_buffer(raw[inside])])
        coded = flat.dictionary_encode()
        self.words = coded.dictionary.cast(pa.large_string())
        self.ids = coded.indices.to_numpy().astype(np.int64)
        doc = np.searchsorted(offsets, starts, "right") - 1

        n = len(starts)
        breaks = np.searchsorted(np.flatnonzero(kind == 2), starts)
        first = np.ones(n, bool)
        first[1:] = (breaks[1:] != breaks[:-1]) | (doc[1:] != doc[:-1])
        cuts = np.append(np.flatnonzero(first), n)
        self.left = np.repeat(cuts[1:], np.diff(cuts)) - np.arange(n)

        names = pc.fill_null(langs.cast(pa.string()), "und").dictionary_encode()
        self.langs = names.dictionary
        self.lang = names.indices.to_numpy().astype(np.int64)[doc]
        hashed = lambda values: np.array([xxhash.xxh3_64_intdigest(v) for v in values], np.uint64)
        self.hashes = _mix(hashed(coded.dictionary.to_pylist())[self.ids] if n else
                           np.zeros(0, np.uint64),
                           hashed(self.langs.to_pylist())[self.lang] if n else np.zeros(0, np.uint64))

    def grams(self, max_words: int):
        """(k, hash of the k words from each place on, places where there are k words)."""
        h = self.hashes.copy()
        for k in range(1, max_words + 1):
            if k > 1:
                n = max(0, len(h) - k + 1)
                h[:n] = _mix(h[:n], self.hashes[k - 1:])
            yield k, h, self.left >= k


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte by byte, compressed."""
    import zstandard

    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)


def _partitioned(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Sorted keys (partition, then 32 bits of the hash) as rows by partition: mass, summary."""
    part = (keys >> np.uint64(32)).astype(np.int64)
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    rows = []
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        mass = int(counts[a:b].sum())
        rows.append((int(part[a]), 0, mass, None, None))
        rows.append((int(part[a]), 1, mass, _pack(np.diff(low[a:b], prepend=0)), _pack(counts[a:b])))
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(
            zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
        names=["part", "kind", "mass", "keys", "counts"])


def _summarise(batches, max_words: int, part_bits: int):
    """(lang, text) -> per hash partition its mass (kind 0) and its summary (kind 1).

    Slices are counted together until ``HELD_KEYS`` distinct keys are held.
    """
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in text_slices(batches, 1, SLICE_BYTES):
        piece = _Slice(batch.column(0), batch.column(1))
        new = np.concatenate([h[fits] for _, h, fits in piece.grams(max_words)])
        new >>= np.uint64(32 - part_bits)
        new.sort()
        at = np.flatnonzero(np.append(True, new[1:] != new[:-1])) if len(new) else np.zeros(0, np.int64)
        keys, counts = _added(keys, counts, new[at], np.diff(np.append(at, len(new))))
        if len(keys) > HELD_KEYS:
            yield _partitioned(keys, counts)
            keys, counts = keys[:0], counts[:0]
    if len(keys):
        yield _partitioned(keys, counts)


def _added(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, number: np.ndarray):
    """Sum of two sorted summaries."""
    keys, counts = np.concatenate([keys, more]), np.concatenate([counts, number])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def merge(summaries: list[tuple[np.ndarray, np.ndarray]], capacity: int
          ) -> tuple[np.ndarray, np.ndarray, int]:
    """One summary of at most ``capacity`` counters from several (keys, counts), and what was
    taken from each counter."""
    keys = np.concatenate([k for k, _ in summaries])
    counts = np.concatenate([c for _, c in summaries])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, counts = keys[at], np.add.reduceat(counts, at) if len(at) else counts
    taken = 0
    if len(keys) > capacity:
        taken = np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
        left = counts > taken
        keys, counts = keys[left], counts[left] - taken
    return keys, counts, int(taken)


def _bits(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a key in a bit slice of ``width``, a power of two."""
    mixed = _mix(keys.astype(np.uint64), keys.astype(np.uint64))
    mask = np.uint64(width - 1)
    return (mixed & mask).astype(np.int64), ((mixed >> np.uint64(32)) & mask).astype(np.int64)


def _survivors(batches, min_count: int, width: int):
    """Rows ordered by (part, kind) -> per partition its bits of the survivors' filter."""
    part, mass, held, size, lost = None, 0, [], 0, 0

    def settled() -> pa.RecordBatch:
        keys, counts, taken = merge(held, mass // min_count)
        keys = keys[counts + (lost + taken) >= min_count]       # others cannot be frequent
        bits = np.zeros(width, bool)
        for places in _bits(keys, width):
            bits[places] = True
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()),
             pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())],
            names=["part", "survivors", "bits"])

    for batch in batches:
        parts, kinds, masses = (batch.column(i).to_numpy() for i in range(3))
        for r in range(batch.num_rows):
            if parts[r] != part:
                if part is not None:
                    yield settled()
                part, mass, held, size, lost = int(parts[r]), 0, [], 0, 0
            if kinds[r] == 0:
                mass += int(masses[r])
                continue
            keys = np.cumsum(_unpack(batch.column(3)[r].as_py()))
            held.append((keys, _unpack(batch.column(4)[r].as_py())))
            size += len(keys)
            if size > max(2 * (mass // min_count), 1 << 16):
                keys, counts, taken = merge(held, mass // min_count)
                held, size, lost = [(keys, counts)], len(keys), lost + taken
    if part is not None:
        yield settled()


def survivors(docs: DataFrame, min_count: int, max_words: int, filter_bits: int) -> tuple[np.ndarray, int]:
    """The filter of all n-grams that may occur ``min_count`` times, and the bits that name a partition.

    ``docs``: (lang, text). The filter has ``filter_bits`` bits, or 64 for each hash
    partition where that is more; it is what the driver collects.
    """
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part_bits = min(MOST_PART_BITS, max(4, math.ceil(math.log2(1 + n_bytes / PARTITION_BYTES))))
    width = max(64, filter_bits >> part_bits)
    found = (docs.mapInArrow(lambda b: _summarise(b, max_words, part_bits),
                             "part int, kind int, mass long, keys binary, counts binary")
             .repartition("part").sortWithinPartitions("part", "kind")
             .mapInArrow(lambda b: _survivors(b, min_count, width),
                         "part int, survivors long, bits binary"))
    bits = np.zeros((1 << part_bits) * width // 8, np.uint8)
    for row in saved(found, "phrase-survivors").select("part", "bits").toLocalIterator():
        at = row["part"] * width // 8
        bits[at:at + width // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits, part_bits


def _passes(hashes: np.ndarray, bits: np.ndarray, part_bits: int) -> np.ndarray:
    width = len(bits) * 8 >> part_bits
    keys = hashes >> np.uint64(32 - part_bits)
    base = (keys >> np.uint64(32)).astype(np.int64) * width
    out = np.ones(len(hashes), bool)
    for places in _bits((keys & np.uint64(0xFFFFFFFF)).astype(np.int64), width):
        at = base + places
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return out


def _summed(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """One row for each language and phrase of several (lang, k, phrase, f)."""
    return pa.Table.from_batches(held).group_by(["lang", "k", "phrase"]).aggregate(
        [("f", "sum")]).rename_columns({"f_sum": "f"}).select(["lang", "k", "phrase", "f"]) \
        .combine_chunks().to_batches()


def _dealt(rows: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """One row for each hash partition of the phrases, with columns of lists."""
    import xxhash

    part = np.array([xxhash.xxh3_64_intdigest(p) % parts for p in rows.column(2).to_pylist()], np.int64)
    order = np.argsort(part, kind="stable")
    part, rows = part[order], rows.take(pa.array(order))
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[cuts[:-1]].astype(np.int32)),
         *(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), c) for c in rows.columns)],
        names=["part", *rows.schema.names])


def _count(batches, max_words: int, bits: np.ndarray, part_bits: int, parts: int):
    """(lang, text) -> part and lists of lang, k, phrase, f: exact counts of what passes the filter.

    k 0: all words. Slices are summed until ``HELD_ROWS`` rows are held, so a task sends a
    phrase about once, and those of a hash partition as one row.
    """
    held, size = [], 0
    for rows in _slice_counts(batches, max_words, bits, part_bits):
        held.append(rows)
        size += rows.num_rows
        if size > HELD_ROWS:
            held = _summed(held)
            size = sum(b.num_rows for b in held)
            if size > HELD_ROWS // 2:
                yield from (_dealt(b, parts) for b in held)
                held, size = [], 0
    if held:
        yield from (_dealt(b, parts) for b in _summed(held))


def _frequent(batches, min_count: int):
    """Rows ordered by part -> lang, k, phrase, f of the phrases that are frequent, and k 0."""
    part, held, size, limit = None, [], 0, HELD_ROWS

    def settled():
        for b in _summed(held):
            yield b.filter(pc.or_(pc.equal(b.column(1), 0), pc.greater_equal(b.column(3), min_count)))

    for batch in batches:
        for r, p in enumerate(batch.column(0).to_pylist()):
            if p != part:
                if held:
                    yield from settled()
                part, held, size, limit = p, [], 0, HELD_ROWS
            held.append(pa.RecordBatch.from_arrays(
                [batch.column(i)[r].values for i in range(1, 5)], names=batch.schema.names[1:]))
            size += held[-1].num_rows
            if size > limit:
                held = _summed(held)
                size = sum(b.num_rows for b in held)
                limit = max(HELD_ROWS, 2 * size)
    if held:
        yield from settled()


def _slice_counts(batches, max_words: int, bits: np.ndarray, part_bits: int):
    """The rows of :func:`_count`, slice by slice."""
    for batch in text_slices(batches, 1, SLICE_BYTES):
        piece = _Slice(batch.column(0), batch.column(1))
        n = len(piece.ids)

        def rows(lang: np.ndarray, k: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [piece.langs.take(pa.array(lang)), pa.array(np.full(len(counts), k, np.int32)),
                 phrases.cast(pa.string()), pa.array(counts.astype(np.int64))],
                names=["lang", "k", "phrase", "f"])

        totals = np.bincount(piece.lang, minlength=len(piece.langs))
        yield rows(np.arange(len(totals)), 0, pa.array([""] * len(totals)), totals)
        alive = np.zeros(n + 1, bool)
        group = piece.lang                  # what the words so far are, exactly
        for k, hashes, fits in piece.grams(max_words):
            at = np.flatnonzero(fits if k == 1 else fits & alive[:-1] & alive[1:])
            at = at[_passes(hashes[at], bits, part_bits)]
            if not len(at):
                break
            _, heads, inverse, counts = np.unique(
                (group[at] << 32) | piece.ids[at + k - 1], return_index=True,
                return_inverse=True, return_counts=True)
            alive = np.zeros(n + 1, bool)
            alive[at] = True
            group = np.zeros(n, np.int64)
            group[at] = inverse
            places = at[heads]
            parts = [piece.words.take(pa.array(piece.ids[places + j])) for j in range(k)]
            yield rows(piece.lang[places], k,
                       pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if k > 1 else parts[0], counts)


def frequent_phrases(docs: DataFrame, min_count: int = 100, max_words: int = 5, lang: str = "lang",
                     text: str = "text", filter_bits: int = 1 << 27) -> DataFrame:
    """(lang, k, phrase, f): all phrases of k words that occur ``min_count`` times or more in a language.

    A written table; rows with k 0 hold the number of words of each language.
    """
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    bits, part_bits = survivors(rows, min_count, max_words, filter_bits)
    parts = 1 << max(4, part_bits - 3)
    counted = rows.mapInArrow(
        lambda b: _count(b, max_words, bits, part_bits, parts),
        "part int, lang array<string>, k array<int>, phrase array<string>, f array<long>")
    return saved(counted.repartition("part").sortWithinPartitions("part").mapInArrow(
        lambda b: _frequent(b, min_count), "lang string, k int, phrase string, f long"), "phrase-counts")


def collocations(docs: DataFrame, min_count: int = 100, max_words: int = 5, absorbed_percent: int = 100,
                 lang: str = "lang", text: str = "text", filter_bits: int = 1 << 27) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): phrases of 2 words or more with their weakest cut.

    Without those inside a longer one that occurs ``absorbed_percent`` % as often or more.
    """
    counts = frequent_phrases(docs, min_count, max_words, lang, text, filter_bits)
    totals = small_side(counts.filter("k = 0").select("lang", F.col("f").alias("n")), MAX_LANGUAGES)
    found = counts.filter("k >= 2").select("lang", "k", "phrase", F.col("f").alias("a"))
    cut_word = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    join = lambda start, size: F.array_join(
        F.slice(F.split("phrase", " "), start, size), " ")
    cuts = found.select("*", cut_word.alias("cut")).select(
        "*", join(F.lit(1), F.col("cut")).alias("head"),
        join(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    part = lambda name, count: counts.filter("k > 0").select(
        "lang", F.col("phrase").alias(name), F.col("f").alias(count))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = (cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
              .join(totals, "lang")
              .withColumn("above", (wide("a") * wide("n")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)"))
              .withColumn("below", (wide("l") * wide("r")).cast("decimal(38,0)"))
              .withColumn("score", F.expr("cast(above as decimal(38,0)) div below")))
    best = scored.groupBy("lang", "phrase", "k", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("cut"))

    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("k") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1),
                                 lambda start: F.struct(start.alias("start"), size.alias("size")))))
    inner = found.filter("k > 2").select("lang", "phrase", "a", F.explode(spans).alias("span")).select(
        "lang", join(F.col("span.start"), F.col("span.size")).alias("phrase"),
        F.col("a").alias("longer"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return (best.join(most, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < absorbed_percent * F.col("a")))
            .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                    F.col("cut.score").alias("score")))


def ranked(found: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` collocations: by score, frequency, then the phrase's bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
