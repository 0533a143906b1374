"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` writes one posting (term, document, position) for every word of the
documents that occurs in a test window, and for every document one posting of the
empty term at the position after its last word, which gives its length. Every task
writes a segment of its own, ordered by term; no word is shuffled.

``phrase_matches`` starts from each window's rarest term. Its postings, moved back by
the term's place in the window, are the places where the window may begin; they are
intersected with the second rarest term's postings, moved likewise, and what is left
with those of all others. A window with a term that no document holds ends at once.
Postings are joined by (document, position), so a frequent term or a hot document is
spread over many tasks.

``proximity_matches`` finds documents that hold all words of a window within ``span``
words in any order, in the same steps, with postings joined by blocks of positions.

The test side (windows, terms) is broadcast after a check of its size and joined by
shuffle beyond ``TEST_ROWS`` rows. All steps are DataFrame functions.

Defined results: null, empty and wordless texts have no words and no hits; a null
``doc_id`` is a document as any other; repeated rows are documents of their own; an
item without words has no window; rows with equal item_id are one item; an item
without an id hits words but is counted by no name; an empty table of documents gives
an empty report, an empty table of items a report without hits; other columns, whatever
they are called, play no part.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, small_side

TEST_ROWS = 2_000_000       # rows of the test side that may be broadcast
ALIVE_ROWS = 500_000        # documents with candidates that may be broadcast
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAPS = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased: runs of digits, letters and anything beyond ASCII."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    trimmed = F.btrim(low, F.lit(_GAPS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, _GAP)).otherwise(
        F.array().cast("array<string>"))


@dataclass
class Tests:
    """Written tables of a test set.

    ``windows``: (win, length), one row for each different sequence of words;
    ``items``: (win, item_id); ``slots``: (win, off, word); ``terms``: (word, term).
    """

    windows: DataFrame
    items: DataFrame
    slots: DataFrame
    terms: DataFrame


def tests_of(items: DataFrame, length: int, item_id: str = "item_id", text: str = "text") -> Tests:
    """The windows of ``length`` consecutive words of every item; shorter items are one window."""
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"),
                        words(F.col(f"`{text}`").cast("string")).alias("ws")).filter("size(ws) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - length + 1, F.lit(1)))
    parts = rows.select("item_id", "ws", F.explode(starts).alias("at")).select(
        "item_id", F.slice("ws", F.col("at"), length).alias("ws")).distinct()
    parts = saved(parts, "decon-windows")
    wins = saved(parts.select("ws").distinct().withColumn("win", F.monotonically_increasing_id()),
                 "decon-numbered")
    slots = wins.select("win", F.posexplode("ws").alias("off", "word"))
    terms = slots.select("word").distinct().withColumn("term", F.monotonically_increasing_id() + 1)
    end = items.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(0).cast("long").alias("term"))
    return Tests(wins.select("win", F.size("ws").alias("length")),
                   saved(parts.join(wins, "ws").select("win", "item_id"), "decon-items"),
                   slots, saved(terms.unionByName(end), "decon-terms"))


def build_index(docs: DataFrame, tests: Tests, doc_id: str = "doc_id", text: str = "text"
                ) -> DataFrame:
    """Written postings (term, row, doc_id, pos); term 0 is the end of the document.

    ``row`` is a number of its own for every row of ``docs``.
    """
    marked = F.concat(words(F.col(f"`{text}`").cast("string")), F.array(F.lit("")))
    tokens = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                         F.coalesce(marked, F.array(F.lit(""))).alias("ws")).select(
        "doc_id", "row", F.posexplode("ws").alias("pos", "word"))
    postings = tokens.join(small_side(tests.terms, TEST_ROWS), "word").select(
        "term", "row", "doc_id", "pos")
    return saved(postings.sortWithinPartitions("term", "row", "pos"), "decon-index")


def documents_of(index: DataFrame) -> DataFrame:
    """(row, doc_id, n_words) of every indexed document."""
    return index.filter("term = 0").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))


def ranked_slots(index: DataFrame, tests: Tests, distinct: bool = False) -> DataFrame:
    """(win, off, term, rank, n): the terms of each window from the rarest on.

    Windows with a term that the index does not hold are left out. ``distinct``: each
    word of a window once.
    """
    counts = saved(index.groupBy("term").agg(F.count(F.lit(1)).alias("occurs")), "decon-counts")
    slots = tests.slots.join(small_side(tests.terms, TEST_ROWS), "word")
    if distinct:
        slots = slots.groupBy("win", "term").agg(F.min("off").alias("off"))
    slots = slots.join(small_side(counts, TEST_ROWS), "term", "left")
    mine = Window.partitionBy("win")
    ranked = slots.select(
        "win", "off", "term",
        F.row_number().over(mine.orderBy("occurs", "off")).alias("rank"),
        F.count(F.lit(1)).over(mine).alias("n"),
        F.min(F.coalesce("occurs", F.lit(0))).over(mine).alias("rarest"))
    return saved(ranked.filter("rarest > 0").drop("rarest"), "decon-slots")


def _of_terms(index: DataFrame, slots: DataFrame) -> DataFrame:
    """The postings of the terms in ``slots``."""
    terms = saved(slots.select("term").distinct(), "decon-some-terms")
    return index.join(small_side(terms, TEST_ROWS), "term", "left_semi")


def _of_rows(index: DataFrame, found: DataFrame) -> DataFrame:
    """The postings of the documents in ``found``."""
    rows = saved(found.select("row").distinct(), "decon-alive")
    return index.join(small_side(rows, ALIVE_ROWS), "row", "left_semi")


def phrase_matches(index: DataFrame, tests: Tests) -> DataFrame:
    """Written (win, row, start): every place where the words of a window stand in order."""
    slots = ranked_slots(index, tests)
    at = lambda condition: small_side(slots.filter(condition), TEST_ROWS)
    begin = F.col("pos") - F.col("off")
    found = (index.join(at("rank = 1"), "term").select("win", "row", begin.alias("start"), "n")
             .filter("start >= 0"))
    found = saved(found, "decon-rarest")

    second = found.filter("n > 1").drop("n").join(at("rank = 2"), "win").withColumn(
        "pos", F.col("start") + F.col("off"))
    lists = _of_terms(index, slots.filter("rank = 2")).select("row", "pos", "term")
    both = saved(second.join(lists, ["row", "pos", "term"], "left_semi")
                 .select("win", "row", "start", "n"), "decon-second")

    rest = both.filter("n > 2").drop("n").join(at("rank > 2"), "win").withColumn(
        "pos", F.col("start") + F.col("off"))
    lists = _of_rows(index, both.filter("n > 2")).select("row", "pos", "term")
    whole = (rest.join(lists, ["row", "pos", "term"], "left_semi")
             .groupBy("win", "row", "start", "n").agg(F.count(F.lit(1)).alias("hits"))
             .filter("hits = n - 2"))
    key = ["win", "row", "start"]
    return saved(found.filter("n = 1").select(*key).unionByName(both.filter("n = 2").select(*key))
                 .unionByName(whole.select(*key)), "decon-matches")


def proximity_matches(index: DataFrame, tests: Tests, span: int) -> DataFrame:
    """Written (win, row, start): documents with all words of a window within ``span`` words.

    Repeated words of a window count once. ``start`` is where the first such stretch
    begins, at one of the words. A stretch holds an occurrence of the rarest word, so
    only the ``2 * span`` words around each of these are looked at.
    """
    slots = ranked_slots(index, tests, distinct=True)
    at = lambda condition: small_side(slots.filter(condition), TEST_ROWS)
    blocked = lambda rows: rows.select(
        "row", "term", F.col("pos").alias("other"), F.floor(F.col("pos") / span).alias("block"))
    anchors = saved(index.join(at("rank = 1"), "term").select("win", "row", F.col("pos").alias("here"), "n"),
                    "decon-anchors")

    def beside(rows: DataFrame, condition: str, postings: DataFrame) -> DataFrame:
        """(win, row, here, n, term, other): postings of the windows' terms near the anchors."""
        near = rows.join(at(condition).select("win", "term"), "win").withColumn(
            "block", F.explode(F.sequence(F.floor((F.col("here") - span + 1) / span),
                                          F.floor((F.col("here") + span - 1) / span))))
        return near.join(blocked(postings), ["row", "term", "block"]).filter(
            F.abs(F.col("other") - F.col("here")) < span)

    second = beside(anchors.filter("n > 1"), "rank = 2", _of_terms(index, slots.filter("rank = 2")))
    alive = saved(anchors.filter("n = 1").unionByName(
        second.select("win", "row", "here", "n").distinct()), "decon-near")
    others = beside(alive.filter("n > 1"), "rank > 1", _of_rows(index, alive))
    own = alive.select("win", "row", "here", "n", F.lit(0).cast("long").alias("term"),
                       F.col("here").alias("other"))
    key = ["win", "row", "here", "n"]
    around = own.unionByName(others.select(*own.columns)).groupBy(*key).agg(    # at most 2 * span
        F.sort_array(F.collect_set(F.struct("other", "term"))).alias("around"))
    begins = F.filter("around", lambda p: (p["other"] <= F.col("here")) & (
        F.size(F.array_distinct(F.transform(
            F.filter("around", lambda x: (x["other"] >= p["other"])
                     & (x["other"] < p["other"] + span) & (F.col("here") < p["other"] + span)),
            lambda x: x["term"]))) == F.col("n")))
    found = around.select("win", "row", F.get(begins, 0)["other"].alias("start")).filter(
        "start is not null")
    return saved(found.groupBy("win", "row").agg(F.min("start").alias("start")), "decon-proximity")


def report(index: DataFrame, tests: Tests, matches: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, n_hit, item_ids) of every document.

    ``item_ids``: the items with a window in ``matches``, sorted as strings; at most the
    test set's items.
    """
    placed = matches.join(small_side(tests.windows, TEST_ROWS), "win")
    hit = (placed.select("row", "start", "length").distinct()
           .select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1))
                   .alias("pos")).distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit")))
    named = (matches.select("win", "row").distinct()
             .join(small_side(tests.items.filter("item_id is not null"), TEST_ROWS), "win")
             .select("row", "item_id").distinct()
             .groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids")))
    return documents_of(index).join(hit, "row", "left").join(named, "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def decontaminate(docs: DataFrame, items: DataFrame, length: int = 10, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """``report`` of the exact matches of all items' windows of ``length`` words."""
    tests = tests_of(items, length)
    index = build_index(docs, tests, doc_id, text)
    return report(index, tests, phrase_matches(index, tests))
