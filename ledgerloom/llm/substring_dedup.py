"""Removal of word passages that an earlier document already holds.

Level-wise doubling. Windows of ``length`` words are looked for in two levels. At
the half level every window of ``half`` words, with ``2 * half > length``, is a
candidate, but only those that are the least of the half windows inside some full
window are listed: equal full windows list the same half window at the same
place, so each full window has one listed half (its anchor), and about one
position in four is listed. Half windows found in one document only are done
with. Those found in more are extended to the full length, and only these full
windows go on to the next level, where the documents of each are compared.

At each level the rows (hash, document) are range-partitioned by both, sorted,
and read as runs of equal hashes. A run may span partitions, so a passage held by
any number of documents is never gathered in one task; what a partition knows of
its first and last run is one row, and these rows settle the runs at the edges.
Full windows are compared by 128-bit hashes of their words.

Word sequences that are equal as a whole are settled first by their digest: all
but the least document of such a group are covered from end to end, so only that
one is extended.

Defined results: null and blank texts have no words; texts of fewer than
``length`` words lose none; a document without an id is compared with none and
loses none; rows with equal ids do not cover each other (neither is smaller);
an empty table gives an empty result. Removed words leave the others joined by
one space; a text that loses nothing is unchanged.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, saved, small_side

_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
ID_GROUPS = 1 << 16
SEVERAL_IDS = 500_000       # ids on several texts that may be broadcast
SLICE_BYTES = 2 << 20       # text worked on at once inside a task
BLOB_BYTES = 1 << 18        # the same of compressed texts, beside which their windows are held


def _slices(batch: pa.RecordBatch, column: int, n_bytes: int = SLICE_BYTES):
    """Row ranges of a batch that hold about ``n_bytes`` of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // n_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
            pa.default_memory_pool().release_unused()


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every word of every text (2 x words), and the texts' offsets."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not filled.all():
        offsets = np.concatenate([[0], np.cumsum(filled)])[offsets]
        flat = flat.filter(pa.array(filled))
    coded = flat.dictionary_encode()
    known = b"".join(xxhash.xxh3_128_digest(w) for w in
                     coded.dictionary.cast(pa.large_binary()).to_pylist())
    table = np.frombuffer(known, np.uint64).reshape(-1, 2)
    return table[coded.indices.to_numpy()].T.copy(), offsets


def _windows(words: np.ndarray, base: np.uint64, length: int) -> np.ndarray:
    """Polynomial hash of the window that starts at each word (wrong near the end)."""
    out = np.zeros(len(words), np.uint64)
    for j in range(length):
        out *= base
        if j < len(words):
            out[:len(words) - j] += words[j:]
    return out


def _anchors(hashes: np.ndarray, offsets: np.ndarray, length: int):
    """Starts of full windows, the place of each one's anchor, and the half windows' hashes."""
    half = length // 2 + 1
    n = hashes.shape[1]
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)    # words from here to the end
    starts = np.flatnonzero(left >= length)
    halves = _windows(hashes[0], _BASE[0], half)
    if not len(starts):
        return starts, starts, halves
    mixed = (halves ^ (halves >> np.uint64(29))) * _BASE[1]
    inside = length - half + 1
    least = np.lib.stride_tricks.sliding_window_view(
        np.pad(mixed, (0, inside)), inside)[starts].argmin(1)
    return starts, starts + least, halves


def _list_anchors(batches, length: int):
    """(doc_id, text, tid) -> doc_id, tid, digest of the word sequence, distinct anchors."""
    import xxhash

    for whole in batches:
        for batch in _slices(whole, 1):
            texts = batch.column(1)
            hashes, offsets = word_hashes(texts)
            _, at, halves = _anchors(hashes, offsets, length)
            at = np.unique(at)
            of = np.searchsorted(offsets, at, "right") - 1
            order = np.lexsort((halves[at], of))
            rows = np.stack([of[order].astype(np.uint64), halves[at][order]])
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
            rows = rows[:, new]
            cuts = np.searchsorted(rows[0], np.arange(batch.num_rows + 1).astype(np.uint64))
            digests = [xxhash.xxh3_128_digest(hashes[:, a:b].tobytes())
                       for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            long = np.diff(offsets) >= length
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(digests, pa.binary()), pa.array(long),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                         pa.array(rows[1].astype(np.int64)))],
                names=["doc_id", "tid", "digest", "long", "anchors"])


def _read_runs(batches, n_keys: int, later: bool):
    """Sorted rows (keys, doc, more) -> the rows of runs with two or more documents.

    kind 0: settled, ``first`` is the run's least document. kind 1: a row of the
    partition's first run, or of a last run with one document. kind 2: what this
    partition knows of its first or last run: least and greatest document.
    ``later``: of settled runs only the rows after the least document.
    """
    names, key, least, most, held = None, None, None, None, []
    first = True                        # the current run is the partition's first

    def out(batch: pa.RecordBatch, least, kind: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.broadcast_to(least, batch.num_rows), pa.int64()),
             pa.array(np.full(batch.num_rows, kind), pa.int32())], names=[*names, "first", "kind"])

    def summary() -> pa.RecordBatch:
        more = [pa.array([0], pa.int64())] * (len(names) - n_keys - 1)
        return out(pa.RecordBatch.from_arrays(
            [*(pa.array([k], pa.int64()) for k in key), pa.array([least], pa.int64()), *more],
            names=names), most, 2)

    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        cells = np.stack([c.to_numpy() for c in batch.columns])
        again = (cells[:, 1:] == cells[:, :-1]).all(0)      # rows that say nothing new
        if again.any():
            batch = batch.filter(pa.array(np.append(True, ~again)))
        keys = np.stack([batch.column(i).to_numpy() for i in range(n_keys)])
        docs = batch.column(n_keys).to_numpy()
        new = np.ones(batch.num_rows, bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
        starts = np.append(np.flatnonzero(new), batch.num_rows)
        low, high = docs[starts[:-1]], docs[starts[1:] - 1]

        head = batch.slice(0, int(starts[1]))
        if tuple(keys[:, 0].tolist()) == key:
            most = int(high[0])
        else:
            if key is not None:
                if first:
                    yield summary()
                first = False
            key, least, most, held = tuple(keys[:, 0].tolist()), int(low[0]), int(high[0]), []
        if first:
            yield out(head, least, 1)
        elif least < most:
            for b in [] if later else held:
                yield out(b, least, 0)
            held = []
            yield out(head.filter(pa.array(docs[:starts[1]] > least)) if later else head, least, 0)
        else:
            held.append(head)           # equal rows of one document
        if len(low) == 1:
            continue

        if first:
            yield summary()
        first, held = False, []
        run, multi = np.cumsum(new) - 1, low < high
        multi[0] = False
        picked = multi[run] & (docs > low[run]) if later else multi[run]
        if picked.any():
            yield out(batch.filter(pa.array(picked)), low[run][picked], 0)
        key, least, most = tuple(keys[:, -1].tolist()), int(low[-1]), int(high[-1])
        if not multi[-1]:
            held = [batch.slice(int(starts[-2]))]
    if key is not None:
        yield summary()
        for b in held:
            yield out(b, least, 1)


def repeats(rows: DataFrame, keys: list[str], later: bool = False) -> DataFrame:
    """The rows whose key occurs with two or more doc_id, with ``first``, the least of them.

    ``later``: without the rows of that least document.
    ``rows``: a written table of bigint columns keys, doc_id and others.
    """
    names = [*keys, "doc_id", *(c for c in rows.columns if c not in (*keys, "doc_id"))]
    ordered = (rows.select(*names).repartitionByRange(*keys, "doc_id")
               .sortWithinPartitions(*names))
    schema = ", ".join(f"{c} long" for c in [*names, "first"]) + ", kind int"
    n_keys = len(keys)
    read = saved(ordered.mapInArrow(lambda b: _read_runs(b, n_keys, later), schema), "substring-runs")
    edges = (read.filter("kind = 2").groupBy(*keys)
             .agg(F.min("doc_id").alias("low"), F.max("first").alias("high"))
             .filter("low < high").drop("high"))      # two rows a partition at most
    at_edges = read.filter("kind = 1").join(F.broadcast(edges), keys).withColumn("first", F.col("low"))
    out = read.filter("kind = 0").select(*names, "first").unionByName(
        at_edges.select(*names, "first"))
    return out.filter("doc_id > first") if later else out


def _text_id(text: Column) -> Column:
    return F.xxhash64(text)


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the text compressed for the way through a shuffle."""
    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            at = batch.schema.names.index(text)
            blobs = [None if t is None else pack.compress(t)
                     for t in batch.column(at).cast(pa.binary()).to_pylist()]
            yield batch.set_column(at, text, pa.array(blobs, pa.binary()))

    schema = ", ".join(f"`{f.name}` " + ("binary" if f.name == text else f.dataType.simpleString())
                       for f in docs.schema)
    return docs.mapInArrow(run, schema)


def _unpack(blobs: pa.Array) -> list[bytes | None]:
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    return [None if b is None else unpack.decompress(b) for b in blobs.to_pylist()]


def _full_windows(hashes: np.ndarray, length: int) -> np.ndarray:
    return np.stack([_windows(hashes[k], _BASE[k], length) for k in (0, 1)])


def _extend(batches, length: int):
    """(doc_id, tid, text, anchors) -> distinct full windows over the given anchors."""
    for whole in batches:
        for batch in _slices(whole, 2, BLOB_BYTES):
            hashes, offsets = word_hashes(pa.array(_unpack(batch.column(2)), pa.binary())
                                          .cast(pa.string()))
            starts, at, halves = _anchors(hashes, offsets, length)
            full = _full_windows(hashes, length)
            found = batch.column(3)
            of = np.searchsorted(offsets, starts, "right") - 1
            bounds = np.searchsorted(of, np.arange(batch.num_rows + 1))
            parts = []
            for r in range(batch.num_rows):
                s = slice(bounds[r], bounds[r + 1])
                listed = np.array(found[r].values.to_numpy(), np.int64).view(np.uint64)
                hit = starts[s][np.isin(halves[at[s]], listed)]
                pairs = full[:, hit].view(np.int64)
                if len(hit) > 1:
                    pairs = np.unique(pairs, axis=1)
                parts.append((r, pairs))
            rows = np.repeat([r for r, _ in parts], [p.shape[1] for _, p in parts]).astype(np.int64)
            pairs = np.concatenate([p for _, p in parts], axis=1)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[0]), pa.array(pairs[1]),
                 batch.column(0).take(take), batch.column(1).take(take)],
                names=["h1", "h2", "doc_id", "tid"])


def covered_windows(docs: DataFrame, length: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, tid, whole, h1, h2): per row key the full windows an earlier document holds.

    ``tid`` tells apart rows that share an id. ``whole``: the document repeats
    another's whole word sequence.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"),
                       _text_id(docs[text]).alias("tid")) \
        .filter("doc_id is not null and text is not null")
    listed = saved(rows.mapInArrow(
        lambda b: _list_anchors(b, length),
        "doc_id long, tid long, digest binary, long boolean, anchors array<long>"),
        "substring-anchors")

    long = listed.filter("long").select("doc_id", "tid", "digest")
    # written, so that the join below has exchanges of its own, which AQE splits where a
    # digest is hot
    equal = saved(long.groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most"),
        "substring-equal")
    state = saved(long.join(equal, "digest", "left").select(
        "doc_id", "tid", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).alias("copy")),
        "substring-copies")
    whole = state.filter("copy").select("doc_id", "tid").distinct()
    settled = state.groupBy("doc_id").agg(F.min("copy").alias("all")).filter("all").select("doc_id")

    # an id on several texts is dealt into groups by text; all others have group 0
    several = saved(listed.groupBy("doc_id").agg(F.min("tid").alias("a"), F.max("tid").alias("b"))
                    .filter("a < b").select("doc_id", F.lit(True).alias("several")), "substring-ids")
    group = F.when(F.col("several"), F.pmod("tid", F.lit(ID_GROUPS))).otherwise(F.lit(0)).alias("deal")
    dealt = lambda df: df.join(small_side(several, SEVERAL_IDS), "doc_id", "left")
    if several.limit(1).count():
        half = repeats(dealt(listed).select(F.explode("anchors").alias("h"), "doc_id", group), ["h"])
    else:                   # the column would be all zeros on the way through the shuffle
        half = repeats(listed.select(F.explode("anchors").alias("h"), "doc_id"), ["h"]).withColumn(
            "deal", F.lit(0))
    anchors = half.groupBy("doc_id", "deal").agg(F.collect_list("h").alias("anchors")).join(
        settled, "doc_id", "left_anti")
    packed = _packed(dealt(rows).select("doc_id", "tid", group, "text"), "text")
    windows = saved(packed.join(anchors, ["doc_id", "deal"]).select("doc_id", "tid", "text", "anchors")
                    .mapInArrow(lambda b: _extend(b, length),
                                "h1 long, h2 long, doc_id long, tid long"), "substring-windows")
    full = repeats(windows, ["h1", "h2"], later=True).join(
        whole, ["doc_id", "tid"], "left_anti")
    found = full.groupBy("doc_id", "tid").agg(
        F.collect_list(F.struct("h1", "h2")).alias("pairs")).select(
        "doc_id", "tid", F.lit(False).alias("whole"),
        F.col("pairs.h1").alias("h1"), F.col("pairs.h2").alias("h2"))
    none = F.array().cast("array<bigint>")
    return saved(found.unionByName(whole.select(
        "doc_id", "tid", F.lit(True).alias("whole"), none.alias("h1"), none.alias("h2"))),
        "substring-covered")


def _rewrite(batches, length: int, at: int, added: list[str]):
    """Drops covered words; adds n_words, n_removed and the digest of the kept words.

    The last three columns say what is covered.
    """
    for whole in batches:
        names = whole.schema.names
        w, a, b = range(len(names) - 3, len(names))
        for batch in _slices(whole, at, BLOB_BYTES):
            texts, columns = [], (batch.column(w).to_pylist(), batch.column(a), batch.column(b))
            n_words, n_removed, digests = [], [], []
            for r, body in enumerate(_unpack(batch.column(at))):
                words = (body or b"").split()
                n, kept = len(words), words
                if columns[0][r] and n >= length:
                    kept = []
                elif columns[1][r].is_valid and len(columns[1][r].values):
                    kept = _uncovered(body, words, length,
                                      *(c[r].values.to_numpy() for c in columns[1:]))
                joined = b" ".join(kept)
                texts.append(body if len(kept) == n else joined)
                n_words.append(n)
                n_removed.append(n - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
            keep = [i for i in range(len(names)) if i not in (w, a, b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.binary()).cast(pa.string()) if i == at else batch.column(i)
                 for i in keep] + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                   pa.array(digests, pa.string())],
                names=[names[i] for i in keep] + added)


def _uncovered(body: bytes, words: list[bytes], length: int, h1: np.ndarray, h2: np.ndarray):
    hashes, _ = word_hashes(pa.array([body], pa.binary()).cast(pa.string()))
    full = _full_windows(hashes, length)[:, :len(words) - length + 1].astype(np.int64)
    order = np.argsort(h1)
    h1, h2 = h1[order], h2[order]
    i = np.minimum(np.searchsorted(h1, full[0]), len(h1) - 1)
    starts = np.flatnonzero((h1[i] == full[0]) & (h2[i] == full[1]))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    return [x for x, g in zip(words, gone.tolist()) if not g]


def dedup(docs: DataFrame, length: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, without covered words; adds _sub_n_words, _sub_n_removed, _sub_sha256.

    Where ``docs`` has a column of such a name, the added one takes underscores.
    """
    found = covered_windows(docs, length, doc_id, text)
    names = {c: fresh(docs.columns, f"_sub_{c}")
             for c in ("key", "text", "id", "tid", "whole", "h1", "h2", "n_words", "n_removed", "sha256")}
    found = found.select(F.col("doc_id").alias(names["id"]),
                         *(F.col(c).alias(names[c]) for c in ("tid", "whole", "h1", "h2")))
    tagged = docs.select(*(docs[c].cast("string").alias(c) if c == text else docs[c]
                           for c in docs.columns),
                         docs[doc_id].cast("long").alias(names["key"]),
                         _text_id(docs[text]).alias(names["text"]))
    joined = _packed(tagged, text).join(
        found, (F.col(names["key"]) == F.col(names["id"])) & (F.col(names["text"]) == F.col(names["tid"])),
        "left").drop(*(names[c] for c in ("key", "text", "id", "tid")))
    added = [names[c] for c in ("n_words", "n_removed", "sha256")]
    schema = ", ".join([f"`{f.name}` " + ("string" if f.name == text else f.dataType.simpleString())
                        for f in docs.schema]
                       + [f"`{c}` {kind}" for c, kind in zip(added, ("long", "long", "string"))])
    at = docs.columns.index(text)
    return joined.mapInArrow(lambda b: _rewrite(b, length, at, added), schema)
