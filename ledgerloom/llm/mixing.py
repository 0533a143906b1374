"""Mixing sources to target weights by capped water-filling.

Targets. Every source has a weight and a size. The mix has a budget (a share of
all sizes). Each round gives the open sources ``weight * rate`` with one common
rate that spends what the closed sources left; a source above its cap
(``max_epochs`` times its size) is clamped to it and closed, and its excess goes
to the others by weight in the next round, until none is above.

Repetitions. A source of size S and target T gives ``floor(T / S)`` copies of all
its documents, and one more of a seeded fraction that fills the rest: documents
stand in the order of ``md5(seed:id:md5(text))``, and the prefix that comes nearest to
the rest is taken. The cut is found without sorting a source: sizes are summed by
the first three hex digits of the key, then, inside the one bucket that holds the
cut, by the next three, and only the documents of that cell (one in 16.7 million
of a source) are ordered. So a source that holds most of the rows is aggregated
map-side and never gathered, and reruns give the same mix.

Defined results: null or blank text has size 0 and takes 0 words; a null source
is a source of its own; rows equal in id and text are drawn together (their keys tie),
rows that share an id, or have none, each for themselves; an empty table gives an empty mix; sources without a
weight get target 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_side, word_count

#: Sources up to this many are broadcast to the documents; beyond, the join shuffles.
MAX_BROADCAST_SOURCES = 20_000


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _draw_key(doc_id: Column, text: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"),
                          F.coalesce(F.md5(text.cast("string").cast("binary")), F.lit("null"))).cast("binary"))


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """Weights dealt in turn to the sources in code point order, null last.

    ``sources`` has one row per source, so the window orders sources, not rows.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.pmod(F.row_number().over(w) - 1, F.lit(len(cycle)))
    return sources.select("source", F.element_at(F.array(*map(F.lit, cycle)),
                                                 (at + 1).cast("int")).alias("weight"))


def water_fill(sizes: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """(source_key, source_size, weight) -> the same with ``target``.

    Clamping rounds over the written per-source table; a round reads one row to
    the driver. Ends after as many rounds as sources get clamped in turn.
    """
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * F.lit(float(max_epochs))
    state = sizes.withColumn("closed", F.lit(False))
    rate, rounds = 0.0, 0
    while True:
        open_weight, spent = state.agg(
            F.sum(F.when(~F.col("closed"), F.col("weight"))),
            F.sum(F.when(F.col("closed"), cap))).first()
        if not open_weight:
            break
        rate = (budget * total - (spent or 0.0)) / open_weight
        above = ~F.col("closed") & (F.col("weight") * F.lit(rate) > cap)
        if not state.filter(above).limit(1).count():
            break
        state, rounds = state.withColumn("closed", F.col("closed") | above), rounds + 1
        if rounds % 8 == 0:         # keeps the plan short
            state = saved(state, "mix-rounds")
    return state.withColumn(
        "target", F.when(F.col("closed"), cap)
        .otherwise(F.col("weight") * F.lit(rate)).cast("double")).drop("closed")


def _cell_with_cut(cells: DataFrame, cell: str) -> DataFrame:
    """Per source the cell whose sizes, in cell order, first exceed ``rest``.

    Keeps ``rest`` reduced by the cells before it. Cells are at most 4096 a source.
    """
    w = (Window.partitionBy("source_key").orderBy(cell)
         .rowsBetween(Window.unboundedPreceding, 0))
    run = cells.withColumn("upto", F.sum("cell_size").over(w))
    before = F.col("upto") - F.col("cell_size")
    return (run.filter((before <= F.col("rest")) & (F.col("rest") < F.col("upto")))
            .select("source_key", cell, (F.col("rest") - before).alias("rest")))


def sized(docs: DataFrame, doc_id: Column, source: Column, size: Column, text: Column,
          seed: str = "mix") -> DataFrame:
    """The written narrow table the plan is made from: id, source, size, keys."""
    return saved(docs.select(
        doc_id.alias("doc_id"), source.alias("source"), _source_key(source).alias("source_key"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        _draw_key(doc_id, text, seed).alias("draw")), "mix-sizes")


def mixing_plan(base: DataFrame, weights: DataFrame | Callable[[DataFrame], DataFrame],
                budget: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """One row per source: source_size, target, whole copies and the draw's cut.

    ``base`` comes from :func:`sized`. ``weights`` has (source, weight), or makes
    that from the table of sources.
    """
    cell = F.substring("draw", 1, 3)
    cells = saved(base.groupBy("source", "source_key", cell.alias("c1"))
                  .agg(F.sum("size").alias("cell_size")), "mix-cells")
    sizes = cells.groupBy("source", "source_key").agg(F.sum("cell_size").alias("source_size"))
    if callable(weights):
        weights = weights(sizes.select("source"))
    weights = weights.select(_source_key(F.col("source")).alias("source_key"), "weight")
    sizes = saved(sizes.drop("source").join(weights, "source_key", "left")
                  .withColumn("weight", F.coalesce("weight", F.lit(0))), "mix-sources")
    ratio = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = saved(water_fill(sizes, budget, max_epochs).withColumn("whole", ratio.cast("long"))
                 .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
                 "mix-plan")
    near = small_side(plan, MAX_BROADCAST_SOURCES)

    first = saved(_cell_with_cut(
        cells.join(near.select("source_key", "rest"), "source_key"), "c1"), "mix-cut1")
    inside = base.withColumn("c1", cell).join(
        small_side(first, MAX_BROADCAST_SOURCES), ["source_key", "c1"])
    draws = saved(inside.groupBy("source_key", "c1", "rest", "draw")
                  .agg(F.sum("size").alias("cell_size")), "mix-cell")
    second_cells = draws.groupBy("source_key", "c1", "rest", F.substring("draw", 4, 3).alias("c2")) \
        .agg(F.sum("cell_size").alias("cell_size"))
    second = _cell_with_cut(second_cells, "c2").withColumnRenamed("rest", "rest2")
    last = draws.withColumn("c2", F.substring("draw", 4, 3)).join(second, ["source_key", "c2"])
    w = (Window.partitionBy("source_key").orderBy("draw")
         .rowsBetween(Window.unboundedPreceding, 0))
    last = last.withColumn("upto", F.sum("cell_size").over(w))
    taken = F.col("upto") - F.col("cell_size") / 2 <= F.col("rest2")
    cut = last.groupBy("source_key").agg(F.coalesce(
        F.max(F.when(taken, F.col("draw"))),
        F.min(F.concat("c1", "c2"))).alias("cut"))
    return saved(plan.join(cut, "source_key", "left").select(
        "source_key", "source_size", "target", "whole", F.coalesce("cut", F.lit("")).alias("cut")),
        "mix-cuts")


def with_copies(rows: DataFrame, plan: DataFrame, source_key: Column, draw: Column) -> DataFrame:
    """``rows`` with their source's plan and ``copies``, without a shuffle of the rows."""
    near = small_side(plan, MAX_BROADCAST_SOURCES)
    p = near.select(*(F.col(c).alias(f"_mix_{c}") for c in near.columns))
    out = rows.withColumn("_mix_key", source_key).join(
        p, F.col("_mix_key") == F.col("_mix_source_key"), "left")
    extra = F.when(draw <= F.col("_mix_cut"), 1).otherwise(0)
    return out.withColumn("_mix_copies", F.col("_mix_whole") + extra)


def mix(docs: DataFrame, weights, budget: float = 1.5, max_epochs: float = 2.0,
        seed: str = "mix", doc_id: str = "doc_id", source: str = "source",
        text: str = "text") -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (0 times: gone).

    Keeps all columns of ``docs``, whatever they are called.
    """
    base = sized(docs, docs[doc_id], docs[source], word_count(docs[text]), docs[text], seed)
    plan = mixing_plan(base, weights, budget, max_epochs)
    rows = docs.select(F.struct("*").alias("row"), _source_key(docs[source]).alias("source_key"),
                       _draw_key(docs[doc_id], docs[text], seed).alias("draw"))
    out = with_copies(rows, plan, F.col("source_key"), F.col("draw"))
    repeats = F.array_repeat(F.lit(1), F.col("_mix_copies").cast("int"))
    return out.select("row", F.explode(repeats)).select("row.*")


def mix_report(docs: DataFrame, weights, budget: float = 1.5, max_epochs: float = 2.0,
               seed: str = "mix", doc_id: str = "doc_id", source: str = "source",
               text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, source, size, its source's size and target, copies, taken words."""
    base = sized(docs, docs[doc_id], docs[source], word_count(docs[text]), docs[text], seed)
    plan = mixing_plan(base, weights, budget, max_epochs)
    out = with_copies(base, plan, F.col("source_key"), F.col("draw"))
    return out.select(
        "doc_id", "source", "size", F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), F.col("_mix_copies").alias("copies"),
        (F.col("size") * F.col("_mix_copies")).alias("taken"))
