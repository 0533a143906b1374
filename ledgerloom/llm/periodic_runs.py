"""Periodic runs of words: where a text repeats a passage of any length again and again.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) and a length of at least ``max(min_length, min_exponent * q)`` that no
neighbouring word extends with that period.

Periods are proposed by string synchronising sets. At the dyadic scale t (4, 8, 16,
...) a position is synchronising if, of the hashes of the t-word windows at it and
the t next positions, the least is the first or the last. Whether it is depends on
its 2t words only, so equal contexts choose alike. A run of period q, t <= q < 2t,
with four or more repetitions holds a synchronising position in its first t words,
and the next position with the same context of 2t words is exactly q further: were
it nearer, q would not be the smallest period (Fine and Wilf). So neighbours among
the positions with equal contexts propose all periods, about 2n/t candidates a
scale, and each proposal is extended by comparing the words themselves.

Windows with a period of at most t/4 are left out of the choice, otherwise every
position of such a region would be chosen. These highly periodic regions are known
from smaller scales; periods below the first scale are found by themselves, from the
stretches of words equal to the word 1, 2 or 3 places on, and supply the runs that
the synchronising sets omit.

A slice of texts is worked on as one array, positions of texts that are too short
for a scale are dropped from it. Memory is a few numbers a word of the slice. Rows
are independent: no shuffle.

Defined results: null and blank texts have no words, no runs and an empty collapsed
text; repeated rows are judged alike; no id is needed; an empty table gives an empty
result; other columns are kept, and added names give way to theirs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_slices

FIRST_SCALE = 4             # periods below it are looked for directly
SLICE_BYTES = 4 << 20
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and where those of each text begin and end."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    filled = pc.not_equal(flat, "")
    if not pc.all(filled, min_count=0).as_py():
        seen = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
        flat, offsets = flat.filter(filled), seen[offsets]
    return flat, offsets


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a window from those of its halves; not linear, so no text is special."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + (b >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _direct(ids: np.ndarray, left: np.ndarray, period: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the stretches of a small prime period, or 1, at least fourfold."""
    same = np.zeros(len(ids) + 1, bool)
    same[:len(ids) - period] = (ids[:-period] == ids[period:]) & (left[:-period] > period)
    edges = np.flatnonzero(np.diff(same, prepend=False))
    starts, ends = edges[::2], edges[1::2] + period
    fit = ends - starts >= 4 * period
    starts, ends = starts[fit], ends[fit]
    if period > 1:                      # all words equal: the smallest period is 1
        apart = np.zeros(len(starts), bool)
        for k in range(1, period):
            apart |= ids[starts] != ids[starts + k]
        starts, ends = starts[apart], ends[apart]
    return [(s, e, period) for s, e in zip(starts.tolist(), ends.tolist())]


def _equal_ahead(ids: np.ndarray, a: int, b: int, most: int) -> int:
    """How many words from places ``a`` and ``b`` on are equal, up to ``most``."""
    done, step = 0, 32
    while done < most:
        n = min(step, most - done)
        differ = ids[a + done:a + done + n] != ids[b + done:b + done + n]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + n, 2 * step
    return most


def _equal_behind(ids: np.ndarray, a: int, b: int, most: int) -> int:
    """How many words just before places ``a`` and ``b`` are equal, up to ``most``."""
    done, step = 0, 32
    while done < most:
        n = min(step, most - done)
        differ = (ids[a - done - n:a - done] != ids[b - done - n:b - done])[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + n, 2 * step
    return most


def _synchronising(hashes: np.ndarray, left: np.ndarray, regions: np.ndarray | None,
                   scale: int) -> np.ndarray:
    """Synchronising positions; ``regions``: starts of windows with a period of scale / 4 at most."""
    key = hashes if regions is None else np.where(regions, _TOP, hashes)
    least = key.copy()
    width = 1
    while width < scale:
        np.minimum(least[:-width], least[width:], out=least[:-width])
        width *= 2
    n = len(key) - scale
    least = np.minimum(least[:n], least[1:n + 1])       # of the scale + 1 windows from here on
    return np.flatnonzero((left[:n] >= 2 * scale) & (least != _TOP)
                          & ((key[:n] == least) | (key[scale:] == least)))


def find_runs(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all stretches of a smallest period, at least fourfold.

    ``ids`` are the words of several texts, one after the other; ``offsets`` where each
    begins, and the end. No run crosses from one text to the next.
    """
    sizes = np.diff(offsets)
    ends = np.repeat(offsets[1:], sizes)
    left = ends - np.arange(len(ids))
    found = [r for p in range(1, FIRST_SCALE) if p < len(ids) for r in _direct(ids, left, p)]

    size = np.repeat(sizes, sizes)
    at = np.arange(len(ids))
    hashes, width, scale = _mix(ids.astype(np.uint64), ids.astype(np.uint64)), 1, FIRST_SCALE
    while True:
        long = size >= 4 * scale
        hashes, left, at, size = hashes[long], left[long], at[long], size[long]
        if not len(at):
            break
        while width < scale:            # those near the end of a text are never used
            hashes[:-width] = _mix(hashes[:-width], hashes[width:])
            width *= 2
        small = [(s, e) for s, e, p in found if 4 * p <= scale <= e - s]
        regions = None
        if small:
            marks = np.zeros(len(ids) + 1, np.int32)
            s, e = np.array(small).T
            np.add.at(marks, s, 1)
            np.add.at(marks, e - scale + 1, -1)
            regions = np.cumsum(marks)[at] > 0
        chosen = _synchronising(hashes, left, regions, scale)
        context = _mix(hashes[chosen], hashes[chosen + scale])
        order = np.argsort(context, kind="stable")
        context, place = context[order], at[chosen[order]]
        apart = np.diff(place)
        near = np.flatnonzero((context[1:] == context[:-1]) & (apart >= scale) & (apart < 2 * scale))
        proposed = np.stack([apart[near], place[near]])
        last = (0, 0, 0)
        for period, i in proposed[:, np.lexsort(proposed[::-1])].T.tolist():
            if period == last[2] and last[0] <= i < last[1] - period:
                continue                # of the same run
            text = np.searchsorted(offsets, i, "right") - 1
            low, high = int(offsets[text]), int(offsets[text + 1])
            start = i - _equal_behind(ids, i, i + period, i - low)
            end = i + period + _equal_ahead(ids, i, i + period, high - i - period)
            last = (start, end, period)
            if end - start >= 4 * period:
                found.append(last)
        scale *= 2
    return np.array(found, np.int64).reshape(-1, 3)


def _annotate(batches, text: int, min_exponent: int, min_length: int, added: list[str]):
    """The rows with their runs (by start, then period) and their collapsed text."""
    for batch in text_slices(batches, text, SLICE_BYTES):
        flat, offsets = split_words(batch.column(text))
        coded = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
        runs = find_runs(coded, offsets)
        length = runs[:, 1] - runs[:, 0]
        runs = runs[length >= np.maximum(min_length, min_exponent * runs[:, 2])]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        start, end, period = runs.T
        of = np.searchsorted(offsets, start, "right") - 1
        cuts = np.searchsorted(of, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(
            pa.array(cuts, pa.int32()),
            pa.StructArray.from_arrays([pa.array(start - offsets[of]), pa.array(end - start),
                                        pa.array(period)], names=["start", "length", "period"]))

        gone = np.zeros(len(coded) + 1, np.int64)
        np.add.at(gone, start + period, 1)
        np.add.at(gone, end, -1)
        kept = np.cumsum(gone[:-1]) == 0
        upto = np.concatenate([[0], np.cumsum(kept)])[offsets]
        words = flat if kept.all() else flat.filter(pa.array(kept))
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words),
                                   pa.scalar(" ", pa.large_string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists, collapsed.cast(pa.string())],
                                         names=[*batch.schema.names, *added])


def annotate(docs: DataFrame, text: str = "text", min_exponent: int = 4, min_length: int = 6,
             runs: str = "_runs", collapsed: str = "_collapsed") -> DataFrame:
    """All columns of ``docs``, the runs of each text, and the text without what they repeat.

    ``runs``: array of (start, length, period) by start, then period; starts count words
    from 0. ``collapsed``: the words joined by one space, without those that a run
    contains after its first ``period`` words. A column of either name in ``docs`` makes
    the added one take underscores (``common.fresh``).
    """
    if min_exponent < 4:
        raise ValueError("runs of fewer than four repetitions are not proposed")
    added = [fresh(docs.columns, runs), fresh(docs.columns, collapsed)]
    rows = docs.select(*(F.col(f"`{c}`").cast("string").alias(c) if c == text else F.col(f"`{c}`")
                         for c in docs.columns))
    at = docs.columns.index(text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema),
                        f"`{added[0]}` array<struct<start: bigint, length: bigint, period: bigint>>",
                        f"`{added[1]}` string"])
    return rows.mapInArrow(lambda b: _annotate(b, at, min_exponent, min_length, added), schema)
