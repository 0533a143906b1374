"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are 64-bit SimHashes of word shingles. Equal fingerprints are one
node from the start (combined map-side), so copies are never paired.

Index. Distinct fingerprints are range-partitioned and sorted by Gray rank, which
puts codes that differ in few bits near each other, and cut into blocks. Every
node of the tree keeps the bits its members share: ``lo`` (the AND of the codes)
and ``hi`` (the OR); a bit is masked out where they differ. Blocks are the
leaves; a range partition is the node above its blocks, and every ``FAN``
partitions have a node above them, up to one root.

Search. The tree is joined with itself from the root down, level by level. A pair
of nodes has a difference in every shared bit in which the two disagree; going
down a level can only add differences, and a pair whose accumulated differences
exceed the limit is dropped with all pairs of codes below it. Pairs of blocks
that remain are compared exactly, first by sub-blocks with the same bound, then
code by code.

Links inside a block, and between two blocks, leave as a spanning forest only, so
a group of copies of any size gives at most one row for each code and block. The
components are found by contraction rounds over written tables.

Defined results: null, empty and blank texts have fingerprint zero, linked like
any other; fewer words than a shingle are one shingle; repeated rows of one id
share their component; a component is named by its smallest id, nulls ignored
(null if all ids are null); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, saved

BLOCK = 4096            # codes of a leaf block
SUB = 32                # codes of a sub-block inside a comparison
FAN = 64                # children of an upper node
RANGE = 1 << 20         # codes of a range partition, at most about


def _fingerprint(text: bytes | None, shingle: int) -> int:
    import xxhash

    words = text.lower().split() if text else ()     # ASCII only, both
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, 42) for s in shingles), np.uint64, len(shingles))
    ones = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id",
                 text: str = "text", row: Column | None = None) -> DataFrame:
    """(doc_id, fp): the SimHash of every whole text as a signed 64-bit integer; ``row`` is kept."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fps = [_fingerprint(t.as_py(), shingle) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]],
                names=["doc_id", "fp", *batch.schema.names[2:]])

    more = [] if row is None else [row.alias("row")]
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"), *more)
    return narrow.mapInArrow(run, f"doc_id {kind}, fp long" + (", row long" if more else ""))


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit code in Gray order, as a signed integer that sorts the same way."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


class _Forest:
    """Union-find over small integers, smaller root wins."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        a, b = self.up[left], self.up[right]
        open_ = a != b
        if not open_.any():
            return
        pairs = np.unique(np.minimum(a, b)[open_] * len(self.up) + np.maximum(a, b)[open_])
        for i, j in zip(*(x.tolist() for x in np.divmod(pairs, len(self.up)))):
            i, j = sorted((self.root(i), self.root(j)))
            self.up[j] = i
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]


def _padded(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.pad(codes, (0, -len(codes) % SUB), mode="edge").reshape(-1, SUB)
    return rows, np.bitwise_and.reduce(rows, 1), np.bitwise_or.reduce(rows, 1)


def _linked(left: np.ndarray, right: np.ndarray, bits: int, same: bool):
    """Index arrays (i, j) of codes at ``bits`` or fewer differences, in bounded portions."""
    a, a_lo, a_hi = _padded(left)
    b, b_lo, b_hi = (a, a_lo, a_hi) if same else _padded(right)
    apart = (a_lo[:, None] & ~b_hi[None, :]) | (b_lo[None, :] & ~a_hi[:, None])
    near = np.bitwise_count(apart) <= bits
    if same:
        near = np.triu(near)
    ai, bi = np.nonzero(near)
    for k in range(0, len(ai), 1024):
        p, q = ai[k:k + 1024], bi[k:k + 1024]
        hit = np.bitwise_count(a[p][:, :, None] ^ b[q][:, None, :]) <= bits
        m, x, y = np.nonzero(hit)
        i, j = p[m] * SUB + x, q[m] * SUB + y
        real = (i < len(left)) & (j < len(right))
        yield i[real], j[real]


def _blocks(batches, bits: int, block: int):
    """Sorted codes -> blocks: pattern, codes, and each code's root inside the block."""
    from pyspark import TaskContext

    pid, no, held = TaskContext.get().partitionId(), 0, []

    def emit(codes: np.ndarray, no: int) -> pa.RecordBatch:
        forest = _Forest(len(codes))
        for i, j in _linked(codes, codes, bits, same=True):
            forest.join(i, j)
        roots = codes[forest.up]
        lo, hi = np.bitwise_and.reduce(codes), np.bitwise_or.reduce(codes)
        return pa.RecordBatch.from_arrays([
            pa.array([pid], pa.int64()), pa.array([no], pa.int64()),
            pa.array([lo.astype(np.int64)], pa.int64()), pa.array([hi.astype(np.int64)], pa.int64()),
            pa.array([codes.tobytes()], pa.binary()), pa.array([roots.tobytes()], pa.binary())],
            names=["part", "no", "lo", "hi", "codes", "roots"])

    for batch in batches:
        held.append(batch.column(0).to_numpy().view(np.uint64))
        codes = np.concatenate(held)
        while len(codes) >= block:
            yield emit(codes[:block], no)
            codes, no = codes[block:], no + 1
        held = [codes]
    if held and len(held[0]):
        yield emit(held[0], no)


def _cross_links(batches, bits: int):
    """Pairs of blocks -> a spanning forest of the links between their roots."""
    for batch in batches:
        for row in batch_rows(batch):
            codes = [np.frombuffer(row[c], np.uint64) for c in ("a_codes", "b_codes")]
            roots = [np.frombuffer(row[c], np.uint64) for c in ("a_roots", "b_roots")]
            names, at = np.unique(np.concatenate(roots), return_inverse=True)
            left, right = at[:len(codes[0])], at[len(codes[0]):]
            forest = _Forest(len(names))
            for i, j in _linked(*codes, bits, same=False):
                forest.join(left[i], right[j])
            moved = np.nonzero(forest.up != np.arange(len(names)))[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[x].astype(np.int64), pa.int64())
                 for x in (moved, forest.up[moved])], names=["u", "v"])


def _members(batches):
    for batch in batches:
        for row in batch_rows(batch):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(row[c], np.int64), pa.int64()) for c in ("codes", "roots")],
                names=["fp", "root"])


def index(codes: DataFrame, bits: int, block: int = BLOCK) -> DataFrame:
    """The written leaf blocks of the index over distinct ``fp`` of a written table."""
    spark = codes.sparkSession
    n = codes.count()
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // block))
    parts = max(1, parts, -(-n // RANGE))
    ordered = (codes.select("fp", gray_rank(F.col("fp")).alias("rank"))
               .repartitionByRange(parts, "rank").sortWithinPartitions("rank").select("fp"))
    return saved(ordered.mapInArrow(
        lambda b: _blocks(b, bits, block),
        "part long, no long, lo long, hi long, codes binary, roots binary"), "simhash-blocks")


def _apart(a_lo, a_hi, b_lo, b_hi) -> Column:
    """Shared bits of two nodes in which they disagree."""
    one = a_lo.bitwiseAND(F.bitwise_not(b_hi))
    return one.bitwiseOR(b_lo.bitwiseAND(F.bitwise_not(a_hi)))


def block_pairs(blocks: DataFrame, bits: int) -> DataFrame:
    """Pairs of blocks (a before b) left after descending the index: a_part, a_no, b_part, b_no."""
    leaves = blocks.select("part", "no", "lo", "hi")
    level = leaves.groupBy("part").agg(F.bit_and("lo").alias("lo"), F.bit_or("hi").alias("hi")) \
        .select(F.col("part").alias("node"), "lo", "hi")
    levels = [saved(level, "simhash-nodes")]
    while levels[-1].limit(2).count() > 1:
        up = levels[-1].groupBy(F.floor(F.col("node") / FAN).alias("node")).agg(
            F.bit_and("lo").alias("lo"), F.bit_or("hi").alias("hi"))
        levels.append(saved(up, "simhash-nodes"))
    root = levels.pop()
    pairs = root.select(F.col("node").alias("a"), F.col("node").alias("b"),
                        F.lit(0).cast("long").alias("apart"), F.lit(0).alias("differences"))

    def descend(pairs: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
        """children: up (the parent), keys, lo, hi."""
        side = lambda s: children.select(F.col("up").alias(s), *(
            F.col(c).alias(f"{s}_{c}") for c in [*keys, "lo", "hi"]))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        now = _apart(*(F.col(c) for c in ("a_lo", "a_hi", "b_lo", "b_hi")))
        seen = F.col("apart")
        both = both.withColumn("differences", F.col("differences")
                               + F.bit_count(now.bitwiseAND(F.bitwise_not(seen)))) \
            .withColumn("apart", now)
        ordered = F.struct(*(f"a_{k}" for k in keys)) <= F.struct(
            *(F.col(f"b_{k}").alias(f"a_{k}") for k in keys))
        return both.filter((F.col("differences") <= bits) & ((F.col("a") != F.col("b")) | ordered))

    for children in reversed(levels):
        kids = children.withColumn("up", F.floor(F.col("node") / FAN))
        pairs = saved(descend(pairs, kids, ["node"]).select(
            F.col("a_node").alias("a"), F.col("b_node").alias("b"), "apart", "differences"),
            "simhash-pairs")
    found = descend(pairs, leaves.withColumn("up", F.col("part")), ["part", "no"])
    return found.select("a_part", "a_no", "b_part", "b_no").filter(
        (F.col("a_part") != F.col("b_part")) | (F.col("a_no") != F.col("b_no")))


def contract(edges: DataFrame) -> DataFrame:
    """Components of written undirected edges (u, v): (node, component) of every node.

    Each round every node moves to the neighbour (or itself) of least hash under
    that round's seed; edges between moved nodes make the next round's graph,
    which has fewer nodes by a constant factor.
    """
    moves = []
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(len(moves))).alias("h"),
                                   F.col(c).alias("x"))
        least = both.groupBy("u").agg(F.min(order("v")).alias("least"))
        move = saved(least.select(F.col("u").alias("node"),
                                  F.least(order("u"), F.col("least"))["x"].alias("component")),
                     "simhash-moves")
        moves.append(move)
        to = lambda c: move.select(F.col("node").alias(c),
                                   F.col("component").alias(f"{c}2"))
        edges = saved(edges.join(to("u"), "u").join(to("v"), "v")
                      .filter("u2 != v2")
                      .select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v"))
                      .distinct(), "simhash-edges")
    if not moves:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = moves[0]
    for later in moves[1:]:
        step = later.select(F.col("node").alias("component"), F.col("component").alias("next"))
        out = out.join(step, "component", "left").select(
            "node", F.coalesce("next", "component").alias("component"))
    return out


def components(codes: DataFrame, bits: int, block: int = BLOCK) -> DataFrame:
    """(fp, component) for written distinct codes (fp): linked at ``bits`` or fewer bits."""
    blocks = index(codes, bits, block)
    side = lambda s: blocks.select(F.col("part").alias(f"{s}_part"), F.col("no").alias(f"{s}_no"),
                                   F.col("codes").alias(f"{s}_codes"),
                                   F.col("roots").alias(f"{s}_roots"))
    pairs = saved(block_pairs(blocks, bits), "simhash-blockpairs")
    joined = pairs.join(side("a"), ["a_part", "a_no"]).join(side("b"), ["b_part", "b_no"])
    edges = saved(joined.select("a_codes", "a_roots", "b_codes", "b_roots").mapInArrow(
        lambda b: _cross_links(b, bits), "u long, v long").distinct(), "simhash-links")
    members = blocks.select("codes", "roots").mapInArrow(_members, "fp long, root long")
    return members.join(contract(edges).withColumnRenamed("node", "root"), "root", "left").select(
        "fp", F.coalesce("component", "root").alias("component"))


def _with_component(rows: DataFrame, bits: int, block: int) -> DataFrame:
    """Written rows of :func:`fingerprints` with component_id and, if they have ``row``, ``first``.

    ``first`` is the component's first row by id (nulls last), fingerprint and ``row``.
    """
    found = {"component_id": F.min("doc_id")}
    if "row" in rows.columns:
        found["first"] = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp", "row"))
    codes = saved(rows.groupBy("fp").agg(*(v.alias(k) for k, v in found.items())), "simhash-codes")
    named = components(codes, bits, block).join(codes, "fp")
    least = named.groupBy("component").agg(*(F.min(k).alias(k) for k in found))
    by_fp = named.select("fp", "component").join(least, "component").drop("component")
    return rows.join(by_fp, "fp")


def near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3, doc_id: str = "doc_id",
                    text: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    rows = saved(fingerprints(docs, shingle, doc_id, text), "simhash-rows")
    return _with_component(rows, bits, block).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, bits: int = 3, shingle: int = 3, doc_id: str = "doc_id",
             text: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` with exactly one row of each component, all columns.

    The row that stays is the first by id (nulls last), fingerprint and a hash of
    the row, so rows without an id go like others, and of different texts under
    one id each is judged in its own component.
    """
    cells = [docs[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]
    row = F.xxhash64(*cells, *(c.isNull() for c in cells))     # the hash itself skips nulls
    rows = saved(fingerprints(docs, shingle, doc_id, text, row), "simhash-rows")
    found = saved(_with_component(rows, bits, block).select(
        F.col("doc_id").alias("_keep_id"), F.col("row").alias("_keep_row"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
         & (F.col("row") == F.col("first.row"))).alias("stays")), "simhash-found")
    gone = found.filter("not stays").select("_keep_id", "_keep_row").distinct()
    same = docs[doc_id].eqNullSafe(F.col("_keep_id")) & (row == F.col("_keep_row"))
    out = docs.join(gone, same, "left_anti")
    equal = found.filter("stays").groupBy("_keep_id", "_keep_row").count().filter("count > 1")
    if equal.limit(1).count():      # rows alike in all columns: one of them
        equal = saved(equal.drop("count"), "simhash-equal")
        one = out.join(equal, same, "left_semi").withColumn("_keep_row", row).dropDuplicates(
            [doc_id, "_keep_row"]).drop("_keep_row")
        out = out.join(equal, same, "left_anti").unionByName(one)
    return out


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
