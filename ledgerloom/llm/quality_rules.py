"""Learned quality rules: text statistics and decision lists.

Statistics are array expressions over the whole text of a row: no Python, no
shuffle. Repeated 3-word windows are found by sorting the windows' 64-bit hashes
inside the row (only rows that have a repeat get sorted at all).

The decision list is learned by sequential covering. Labelled rows are split
into a growing and a pruning part by a hash of their id. A rule is grown
literal by literal (``feature >= t`` or ``feature < t``) by information gain,
cut back to the prefix that does best on the pruning part, and accepted if it is
precise there; the rows it covers are then set aside and the next rule is
learned, until no precise rule is left. Thresholds are the edges of a fixed
logarithmic grid, so a step needs only counts by (feature, grid cell), at most a
few hundred rows however many labels there are, and gives the same list for any
partitioning. The list becomes one ordered ``CASE WHEN`` column.

Defined results: null, empty and blank texts have all statistics 0 and fail the
base rule; repeated rows are judged alike; labels that are null or belong to no
document are not learned from, nor counted when labels are drawn; rows that share
an id and the text are learned from once; without labels, or with one class only,
the list is empty and only the base rule rejects; an empty table gives an empty
result; added columns take underscores where the table has one of their name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_draw, fresh, let, saved, small_side, words

MAX_BROADCAST_LABELS = 500_000
_STATS = "_quality"      # the statistics struct, beside the columns of a table
_GRID_SCALE, _GRID_STEPS = 1024.0, 8     # cells per doubling of 1 + 1024 * value


def _repeat_words(hashes: Column) -> Column:
    """Number of words inside windows whose hash occurs twice or more."""
    def marked(by_hash: Column) -> Column:
        last = F.size(by_hash) - 1

        def twin(x: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(by_hash, j - 1)["h"] == x["h"]).otherwise(F.lit(False))
            after = F.when(j < last, F.get(by_hash, j + 1)["h"] == x["h"]).otherwise(F.lit(False))
            return before | after

        starts = F.sort_array(F.transform(F.filter(by_hash, twin), lambda x: x["i"]))
        # windows start at sorted places; each adds the words after the one before it
        return F.aggregate(
            starts, F.struct(F.lit(-3).alias("prev"), F.lit(0).alias("n")),
            lambda a, i: F.struct(i.alias("prev"),
                                  (a["n"] + F.least(F.lit(3), i - a["prev"])).alias("n")),
            lambda a: a["n"])

    sorted_windows = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        let(sorted_windows, marked))


def _word_statistics(w: Column) -> Column:
    windows = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))
    return F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        let(windows, _repeat_words).cast("long").alias("n_repeat_words"))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def statistics(text: Column) -> Column:
    """Struct of the five statistics and ``base_failed`` of a text."""
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    raw = F.struct(let(words(text), _word_statistics).alias("w"),
                   F.coalesce(symbols, F.lit(0)).cast("long").alias("n_symbols"),
                   F.coalesce(_dup_lines(text), F.lit(0)).cast("long").alias("n_dup_lines"))
    return let(raw, lambda r: F.struct(
        r["w"]["n_words"].alias("n_words"), r["w"]["word_chars"].alias("word_chars"),
        r["n_symbols"].alias("n_symbols"), r["n_dup_lines"].alias("n_dup_lines"),
        r["w"]["n_repeat_words"].alias("n_repeat_words"),
        ((r["w"]["n_words"] < 50)
         | (100 * r["w"]["n_repeat_words"] > 50 * r["w"]["n_words"])).alias("base_failed")))


def features(stats: str = _STATS) -> dict[str, Column]:
    """Size-free features of a statistics struct, by name."""
    of = lambda c: F.col(f"{stats}.{c}")
    per_word = lambda c: of(c) / F.greatest(of("n_words"), F.lit(1))
    return {"symbols_per_word": per_word("n_symbols"), "repeat_share": per_word("n_repeat_words"),
            "dup_lines_per_word": per_word("n_dup_lines"), "chars_per_word": per_word("word_chars"),
            "n_words": of("n_words").cast("double")}


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    threshold: float

    def column(self, stats: str = _STATS) -> Column:
        value = features(stats)[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.4f}"


@dataclass
class DecisionList:
    """Ordered rules; the first that holds rejects, a row that none covers is kept."""

    rules: list[tuple[Literal, ...]] = field(default_factory=list)

    def verdict(self, stats: str = _STATS) -> Column:
        case = F
        for rule in self.rules:
            case = case.when(_all(rule, stats), F.lit(False))
        return F.lit(True) if case is F else case.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "; ".join("reject if " + " and ".join(map(str, r)) for r in self.rules) or "keep all"


def _all(rule: tuple[Literal, ...], stats: str = _STATS) -> Column:
    out = F.lit(True)
    for literal in rule:
        out = out & literal.column(stats)
    return out


def _edge(cell: int) -> float:
    return (2.0 ** (cell / _GRID_STEPS) - 1) / _GRID_SCALE


def _cell(value: Column) -> Column:
    return F.floor(F.log2(1 + value * _GRID_SCALE) * _GRID_STEPS).cast("int")


def _best_literal(rows: DataFrame) -> tuple[Literal | None, int]:
    """The literal of most information gain over ``rows``, and how many bad rows there are."""
    cells = F.array(*(F.struct(F.lit(name).alias("f"), _cell(value).alias("c"))
                      for name, value in features().items()))
    counts = (rows.select("bad", F.explode(cells).alias("x"))
              .groupBy("x.f", "x.c").agg(F.sum(F.col("bad").cast("long")).alias("p"),
                                         F.sum((~F.col("bad")).cast("long")).alias("n"))
              .collect())          # at most features x grid cells
    by_feature: dict[str, dict[int, tuple[int, int]]] = {}
    for f, c, p, n in counts:
        by_feature.setdefault(f, {})[c] = (p, n)
    best, best_gain = None, 1e-9
    all_p = all_n = 0
    for name in sorted(by_feature):
        cells_of = by_feature[name]
        all_p, all_n = (sum(v[i] for v in cells_of.values()) for i in (0, 1))
        if not all_p:
            return None, 0
        base = math.log2(all_p / (all_p + all_n))
        below_p = below_n = 0
        for c in sorted(cells_of)[1:] if len(cells_of) > 1 else []:
            below_p = sum(v[0] for k, v in cells_of.items() if k < c)
            below_n = sum(v[1] for k, v in cells_of.items() if k < c)
            for at_least, p, n in ((True, all_p - below_p, all_n - below_n),
                                   (False, below_p, below_n)):
                gain = p * (math.log2(p / (p + n)) - base) if p else 0.0
                if gain > best_gain:
                    best, best_gain = Literal(name, at_least, _edge(c)), gain
    return best, all_p


def learn(labelled: DataFrame, min_precision: float = 0.95, min_cover: int = 2) -> DecisionList:
    """Sequential covering over a written table of statistics, ``doc_id`` and ``bad``.

    A rule is accepted if, of the labelled rows it covers, at least
    ``min_precision`` are bad, on the pruning part and overall, and at least
    ``min_cover`` bad rows are covered; so there are at most as many rules as that
    allows. A rule grows while a literal gains, each time to fewer rows.
    """
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                  F.lit(3))
    rows = labelled.withColumn("grow", part > 0)
    out, left = DecisionList(), rows
    while True:
        rule: list[Literal] = []
        growing = left.filter("grow")
        while True:
            literal, n_bad = _best_literal(growing)
            if literal is None or n_bad < min_cover:
                break
            rule.append(literal)
            growing = growing.filter(literal.column())
        if not rule:
            break
        heads = [tuple(rule[:k]) for k in range(1, len(rule) + 1)]
        count = lambda head, grow, bad: F.sum(
            (_all(head) & (F.col("grow") == grow) & (F.col("bad") == bad)).cast("long"))
        found = left.agg(*(count(h, g, b) for h in heads
                           for g in (True, False) for b in (True, False))).first()
        scored = []
        for k, head in enumerate(heads):
            gp, gn, pp, pn = (x or 0 for x in found[4 * k:4 * k + 4])
            worth = (pp - pn) / (pp + pn) if pp + pn else -1.0
            precise = (gp + pp >= min_cover and gp + pp >= min_precision * (gp + gn + pp + pn)
                       and pp >= min_precision * (pp + pn))
            scored.append((precise, worth, -k, head))
        precise, _, _, head = max(scored, key=lambda x: x[:3])
        if not precise:
            break
        out.rules.append(head)
        left = left.filter(~_all(head))
        if len(out.rules) % 16 == 0:        # keeps the plan short
            left = saved(left, "quality-left")
    return out


def learn_from(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               max_labelled: int = 50_000, **how) -> DecisionList:
    """Learn from ``max_labelled`` labelled documents at most, drawn by hash of id and text.

    ``labels`` has (doc_id, quality): 0 is bad, 1 good; of several labels of one
    document the lowest counts. They are joined to the documents first, so labels of
    other documents take no part in the draw, and an id on many rows gives one row for
    each of its texts. The drawn keys are bounded, so they are broadcast.
    """
    marks = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.min("quality") == 0).alias("bad")))
    marks = small_side(saved(marks, "quality-labels"), MAX_BROADCAST_LABELS)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"),
                       F.xxhash64(docs[text]).alias("tid"))
    known = saved(rows.select("doc_id", "tid").join(marks, "doc_id").distinct(), "quality-known")
    drawn = saved(bounded_draw(known, max_labelled, "doc_id", "tid"), "quality-drawn")
    stats = (rows.join(F.broadcast(drawn), ["doc_id", "tid"]).dropDuplicates(["doc_id", "tid"])
             .select("doc_id", "bad", statistics(F.col("text")).alias(_STATS)))
    return learn(saved(stats, "quality-labelled").filter(f"not {_STATS}.base_failed"), **how)


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """All columns of ``docs``, the statistics struct ``_quality`` and ``_kept``; no shuffle.

    Where ``docs`` has columns of these names, the added ones take underscores.
    """
    stats, kept = fresh(docs.columns, _STATS), fresh(docs.columns, "_kept")
    out = docs.select("*", statistics(F.col(f"`{text}`")).alias(stats))
    return out.withColumn(kept, ~F.col(f"{stats}.base_failed") & rules.verdict(stats))


def filter_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
                     text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that the base rule and a learned list keep, all columns."""
    rules = learn_from(docs, labels, doc_id, text, **how)
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))
    return judge(rows, rules).filter("_kept").select("row.*")
