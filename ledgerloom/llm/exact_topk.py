"""Exact top-k search by inner product with vector-approximation files.

Equal vectors are one entry that stands for its k + 1 smallest ids (more can never
be needed: k answers, and the query's own row), so a vector that most rows share
is combined map-side and searched once.

File. Entries are dealt by hash into groups of bounded size. A group holds, per
entry, one byte per component: its cell in a uniform grid over that component's
range (the approximation), and the exact integers.

Search, a block of queries at a time (``chunk`` queries at most, so what the tasks are
sent is bounded), each pass reading the groups where they lie: nothing of the file is
shuffled or copied.

1. Scan the cells only. The centre of a cell and its half width give every entry
   a lower and an upper bound of its score (as a distance: an upper and a lower
   bound). A query's k + 1 best lower bounds of all groups give its limit.
2. Scan the cells again; entries whose upper bound reaches the limit are read
   exactly, best bound first, until the kth exact score is certain: better than
   the next bound. What a task found in earlier groups raises the limit for later ones.

A task sends at most k + 1 bounds or answers of a query, whatever the number of its
groups; they are merged by (score, smaller id).

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part; vectors are compared with those of equal dimension;
repeated rows of one id and vector are one; rows with a null id take no part; ties
go to the smaller id; fewer candidates than k are all returned. Scores must fit
a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path

from .common import batch_rows, saved

GROUP = 16_384          # entries of a group, about
CHUNK = 16_384          # queries of a block, about
SLICE = 256             # queries multiplied at once
BITS = 6                # of a cell number


def integer_components(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def _entries(batches, keep: int):
    """(id, integers, is_query) -> distinct vectors of a batch with their smallest ids."""
    for batch in batches:
        found: dict[bytes, list] = {}
        lists = batch.column(1)
        flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        for i, (vec_id, query) in enumerate(zip(batch.column(0).to_pylist(),
                                                batch.column(2).to_pylist())):
            entry = found.setdefault(flat[offsets[i]:offsets[i + 1]].tobytes(), [set(), False])
            entry[0].add(vec_id)
            entry[1] |= query
        yield pa.RecordBatch.from_arrays([
            pa.array([len(v) // 8 for v in found], pa.int32()), pa.array(list(found), pa.binary()),
            pa.array([sorted(e[0])[:keep] for e in found.values()], pa.list_(pa.int64())),
            pa.array([e[1] for e in found.values()], pa.bool_())],
            names=["dim", "vec", "ids", "query"])


def _ranges(batches):
    for batch in batches:
        dims = batch.column(0).to_numpy()
        vecs = batch.column(1).to_pylist()
        for d in np.unique(dims):
            v = np.frombuffer(b"".join(vecs[i] for i in np.flatnonzero(dims == d)), np.int64)
            v = v.reshape(-1, d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()),
                 pa.array(v.min(0)), pa.array(v.max(0))], names=["dim", "at", "low", "high"])


def _group_rows(batches, grids: dict[int, tuple[np.ndarray, np.ndarray]]):
    """One row a group: its entries' cells, exact integers and ids as blocks of bytes."""
    for batch in batches:
        for row in batch_rows(batch):
            d = row["dim"]
            exact = np.frombuffer(b"".join(row["vecs"]), np.int64).reshape(-1, d)
            low, step = grids[d]
            cells = ((exact - low) // step).astype(np.uint8)
            small = np.int16 if np.abs(exact).max() < 1 << 15 else np.int64
            ids = [np.asarray(x, np.int64) for x in row["ids"]]
            yield pa.RecordBatch.from_arrays([
                pa.array([d], pa.int32()), pa.array([row["grp"]], pa.int64()),
                pa.array([cells.tobytes()], pa.binary()),
                pa.array([exact.astype(small).tobytes()], pa.binary()),
                pa.array([np.dtype(small).itemsize], pa.int32()),
                pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                pa.array([np.array([len(x) for x in ids], np.int16).tobytes()], pa.binary())],
                names=["dim", "grp", "cells", "exact", "width", "ids", "counts"])


def _bounds(cells: bytes, queries: np.ndarray, grid):
    """Centre scores (queries x entries) by slices, and each query's error bound."""
    low, step = (x.astype(np.float64) for x in grid)
    codes = np.frombuffer(cells, np.uint8).reshape(-1, len(low))
    centre = low + codes * step + (step - 1) / 2
    reach = np.abs(queries).astype(np.float64)
    error = reach @ ((step - 1) / 2)
    # beyond 2^52 products are rounded; widen the bounds accordingly
    size = reach @ np.abs(centre).max(0)
    error = error + np.where(size < 2.0 ** 52, 0.0, size * 2.0 ** -45)
    for a in range(0, len(queries), SLICE):
        part = slice(a, a + SLICE)
        yield part, queries[part].astype(np.float64) @ centre.T, error[part]


def _group(batch: pa.RecordBatch, row: int, names: list[str]) -> list:
    return [batch.column(n)[row].as_py() for n in names]


def _limits(batches, queries: dict[int, np.ndarray], grids, keep: int):
    """(dim, at, lows): each query's best lower bounds over all groups of a task."""
    best: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in range(batch.num_rows):
            d, cells = _group(batch, row, ["dim", "cells"])
            if d not in queries:
                continue
            held = best.setdefault(d, np.full((len(queries[d]), keep), -np.inf))
            for part, score, error in _bounds(cells, queries[d], grids[d]):
                k = min(keep, score.shape[1])
                low = np.partition(score, -k, axis=1)[:, -k:] - error[:, None]
                both = np.concatenate([held[part], low], axis=1)
                held[part] = np.partition(both, -keep, axis=1)[:, -keep:]
    for d, held in best.items():
        for a in range(0, len(held), 4096):
            part = held[a:a + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), d), pa.int32()),
                 pa.array(np.arange(a, a + len(part)), pa.int32()),
                 pa.array(list(part), pa.list_(pa.float64()))], names=["dim", "at", "lows"])


def _answers(batches, queries: dict[int, np.ndarray], limits: dict[int, np.ndarray], grids, keep: int):
    """(dim, at, score, vec_id): each query's best of a task's groups, read in the bounds' order."""
    best: dict[tuple[int, int], list[tuple[int, int]]] = {}          # (-score, id), sorted
    limits = {d: x.copy() for d, x in limits.items()}
    for batch in batches:
        for row in range(batch.num_rows):
            d, cells, raw, width, ids, counts = _group(
                batch, row, ["dim", "cells", "exact", "width", "ids", "counts"])
            if d not in queries:
                continue
            q, limit = queries[d], limits[d]
            exact = np.frombuffer(raw, np.int16 if width == 2 else np.int64).reshape(-1, d)
            ids = np.split(np.frombuffer(ids, np.int64), np.cumsum(np.frombuffer(counts, np.int16))[:-1])
            for part, centre, error in _bounds(cells, q, grids[d]):
                upper = centre + error[:, None]
                for i in np.flatnonzero((upper >= limit[part, None]).any(1)).tolist():
                    at = part.start + i
                    order = np.flatnonzero(upper[i] >= limit[at])
                    order = order[np.argsort(-upper[i][order], kind="stable")]
                    mine = best.get((d, at), [])
                    for a in range(0, len(order), 64):
                        if len(mine) >= keep and -mine[keep - 1][0] > upper[i][order[a]]:
                            break
                        take = order[a:a + 64]
                        got = exact[take].astype(np.int64) @ q[at]
                        mine = sorted(mine + [(-int(s), int(x)) for s, e in zip(got, take)
                                              for x in ids[e]])[:keep]
                    best[d, at] = mine
                    if len(mine) == keep:
                        limit[at] = max(limit[at], float(-mine[-1][0]))
    rows = [(d, at, -s, x) for (d, at), found in best.items() for s, x in found]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
            names=["dim", "at", "score", "vec_id"])


def top_k(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id",
          embedding: str = "embedding", scale: int = 256, bits: int = BITS,
          group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best among all other rows.

    ``queries`` is a condition on the columns of ``vectors``. Blocks of queries are dealt
    by hash, so that they have about ``chunk`` each.
    """
    if not 1 <= bits <= 8:
        raise ValueError("a cell number has 1 to 8 bits")
    keep = k + 1
    rows = vectors.select(vectors[vec_id].cast("long").alias("id"), vectors[embedding].alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("query")) \
        .filter(F.col("id").isNotNull() & valid(F.col("v")))
    rows = rows.select("id", integer_components(F.col("v"), scale).alias("v"), "query")
    partial = rows.mapInArrow(lambda b: _entries(b, keep),
                              "dim int, vec binary, ids array<long>, query boolean")
    # a batch sends at most k + 1 ids of a vector
    entries = saved(partial.groupBy("dim", "vec").agg(
        F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"),
        F.bool_or("query").alias("query")), "topk-entries")

    grids = {}
    edges = entries.select("dim", "vec").mapInArrow(_ranges, "dim int, at int, low long, high long") \
        .groupBy("dim", "at").agg(F.min("low"), F.max("high")).orderBy("dim", "at").collect()
    for d in {r[0] for r in edges}:                     # a row for each component
        low, high = (np.array([r[i] for r in edges if r[0] == d], np.int64) for i in (2, 3))
        grids[d] = (low, np.maximum(1, -((low - high - 1) // (1 << bits))))

    n, n_queries = entries.agg(F.count("*"), F.count_if("query")).first()
    groups, chunks = max(1, -(-n // group)), max(1, -(-(n_queries or 0) // chunk))
    dealt = entries.withColumn("grp", F.pmod(F.xxhash64("vec"), F.lit(groups)))
    files = saved(dealt.groupBy("dim", "grp").agg(
        F.collect_list("vec").alias("vecs"), F.collect_list("ids").alias("ids")).mapInArrow(
        lambda b: _group_rows(b, grids), "dim int, grp long, cells binary, exact binary, width int, "
        "ids binary, counts binary"), "topk-files")
    asked = saved(entries.filter("query").select("dim", "vec").withColumn(
        "chunk", F.pmod(F.xxhash64(F.lit(1), "vec"), F.lit(chunks))), "topk-queries")
    path = scratch_path(vectors.sparkSession, "llm-topk-found")
    for number in range(chunks):            # a block that is written is done with
        part = _block_answers(asked.filter(F.col("chunk") == number), files, grids, keep)
        part.write.parquet(f"{path}/block={number}")
    by_vec = vectors.sparkSession.read.schema(part.schema).parquet(path)

    mine = rows.filter("query").select("id", "v").distinct().mapInArrow(
        _vec_bytes, "query_id long, vec binary")
    others = F.filter("best", lambda b: b["vec_id"] != F.col("query_id"))
    return mine.join(by_vec, "vec").select("query_id", F.posexplode(F.slice(others, 1, k))) \
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"),
                F.col("col.vec_id").alias("vec_id"), (-F.col("col.s")).alias("score"))


def _block_answers(asked: DataFrame, files: DataFrame, grids, keep: int) -> DataFrame:
    """(vec, best): the answers to one block of queries; the block is bounded and sent to all tasks."""
    spark = asked.sparkSession
    by_dim: dict[int, list[bytes]] = {}
    for d, vec in sorted(tuple(r) for r in asked.select("dim", "vec").collect()):
        by_dim.setdefault(d, []).append(bytes(vec))
    queries = {d: np.frombuffer(b"".join(v), np.int64).reshape(-1, d) for d, v in by_dim.items()}
    lows = files.select("dim", "cells").mapInArrow(
        lambda b: _limits(b, queries, grids, keep), "dim int, at int, lows array<double>")
    limit = F.get(F.sort_array(F.flatten(F.collect_list("lows")), asc=False), F.lit(keep - 1))
    limits = {d: np.full(len(q), -np.inf) for d, q in queries.items()}
    for d, at, low in lows.groupBy("dim", "at").agg(limit.alias("limit")).toLocalIterator():
        limits[d][at] = low             # a number a query of the block
    answers = files.mapInArrow(lambda b: _answers(b, queries, limits, grids, keep),
                               "dim int, at int, score long, vec_id long")
    best = answers.groupBy("dim", "at").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("s"), F.col("vec_id")))), 1, keep).alias("best"))
    placed = spark.createDataFrame([(d, at, v) for d, vecs in by_dim.items() for at, v in enumerate(vecs)],
                                   "dim int, at int, vec binary")
    return placed.join(best, ["dim", "at"]).select("vec", "best")


def _vec_bytes(batches):
    for batch in batches:
        vecs = [np.array(v, np.int64).tobytes() for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vecs, pa.binary())],
                                         names=["query_id", "vec"])
