"""Samples and their bounds, labels of other documents, hot ids, clashing names, plain re-computations."""
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from ledgerloom.llm import (common, cotraining, exact_topk, language_id, mixing, queries, quality_rules,
                            substring_dedup, subwords, url_filters)

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").persist()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").persist()
    foreign = spark.range(10 ** 9, 10 ** 9 + 200_000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    return docs, labels, labels.unionByName(foreign)


def test_labels_of_other_documents_change_nothing(small):
    docs, own, more = small
    few = 300
    assert quality_rules.learn_from(docs, own, max_labelled=few).rules == \
        quality_rules.learn_from(docs, more, max_labelled=few).rules != []
    scored = [{r.doc_id: (round(r.score, 9), r.kept) for r in cotraining.classify(
        docs, marks, max_labelled=few, rounds=1).collect()} for marks in (own, more)]
    assert scored[0] == scored[1]
    assert {kept for _, kept in scored[0].values()} == {True, False}


def test_an_id_on_many_rows_does_not_break_the_bounds(spark):
    """Half of the rows share an id: some alike, most with texts of their own."""
    base = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("some words of text "), F.col("id") - F.pmod("id", F.lit(3))).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(9).alias("n_chars"))
    marks = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    table = cotraining.features(base.select("doc_id", "text", *cotraining.metadata_columns(
        *(F.col(c) for c in ("lang", "source", "n_chars")))))
    drawn = cotraining.sample(table, cotraining.known_labels(marks), 150)
    assert len(drawn) == 150 == len({(r["doc_id"], r["key"]) for r in drawn})
    found = language_id.sample(base, 120, "doc_id", "text", "lang", 64)
    assert len(found) == 120
    known = base.select("doc_id", F.xxhash64("text").alias("tid")).distinct()
    known = common.saved(known, "test-known")
    assert common.bounded_draw(known, 77, "doc_id", "tid").count() == 77
    assert common.bounded_draw(known, 10 ** 6, "doc_id", "tid").count() == known.count()


def test_an_id_on_many_texts_in_substring_dedup(spark):
    import random
    rng = random.Random(2)
    shared = [" ".join(f"p{k}x{i}" for i in range(20)) for k in range(6)]
    rows = [(7 if i % 3 else i, f"{rng.choice(shared)} own {i} " + rng.choice(shared)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted((d, " ".join(k)) for (d, _), k in zip(rows, brute.substring_dedup(rows, 13)))
    assert sorted((r.doc_id, r.text) for r in substring_dedup.dedup(docs, 13).collect()) == want


def test_clashing_names(spark):
    names = ["_mix_copy", "_mix_key", "source_key", "draw", "row", "_quality", "_kept", "_sub_key", "_sub_id",
             "_sub_n_words", "_sub_h1", "tid", "Text2"]
    rows = [(i, f"word{i % 5} " * 60 if i % 4 else None, f"s{i % 3}", *([i + 11] * len(names)))
            for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, "
                                 + ", ".join(f"`{n}` int" for n in names))
    weights = lambda s: mixing.cyclic_weights(s, (3, 1, 2))
    mixed = mixing.mix(docs, weights)
    assert mixed.columns == docs.columns
    assert all(set(r[3:]) == {r.doc_id + 11} for r in mixed.collect())
    none = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality_rules.filter_documents(docs, none)
    assert kept.columns == docs.columns and kept.count() == 0      # all repeat themselves
    judged = quality_rules.judge(docs, quality_rules.DecisionList())
    assert judged.columns == [*docs.columns, "_quality_", "_kept_"]
    out = substring_dedup.dedup(docs, 13)
    assert out.columns == [*docs.columns, "_sub_n_words_", "_sub_n_removed", "_sub_sha256"]
    assert {r["_sub_n_words"] - 11 == r.doc_id for r in out.collect()} == {True}


def test_op6_statement_splits_words_at_every_blank(spark):
    """CR, VT and FF part words in the SQL as in the operator."""
    text = "\r".join(f"a{i}" for i in range(14))
    rows = [(1, text), (2, "x " + text.replace("\r", "\x0b")), (3, text.replace("\r", "\x0c") + "\ty")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = {r[0]: r[1:3] for r in con.execute(queries.OP6_SQL).fetchall()}
    got = substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), 13).collect()
    assert {r.doc_id: (r._sub_n_words, r._sub_n_removed) for r in got} == want
    assert want == {1: (14, 0), 2: (15, 14), 3: (15, 14)}


def test_op8_scores_by_plain_recomputation(small):
    """Both views, their calibration and the sum, from the fitted model, one document at a time."""
    docs, labels, _ = small
    table = cotraining.features(docs.select("doc_id", "text", *cotraining.metadata_columns(
        *(F.col(c) for c in ("lang", "source", "n_chars")))))
    marks = cotraining.known_labels(labels)
    model = cotraining.fit(cotraining.sample(table, marks, 200), rounds=1,
                           pool=cotraining.Unlabelled(table, marks))
    got = {r.doc_id: r for r in cotraining.score(table, model).collect()}
    meta = {r.doc_id: r for r in table.collect()}
    log = lambda z: 1 / (1 + np.exp(-z))
    for r in docs.limit(60).collect():
        counts = np.zeros(cotraining.BUCKETS)
        for found, _ in subwords.buckets([r.text.encode()], cotraining.BUCKETS):
            for b in found:
                counts[b] += 1
        stats = cotraining.text_statistics(pa.array([r.text]))[0]
        w = brute.words(r.text)
        assert stats[0] == pytest.approx(np.log1p(len(w))) and stats[6] == (len(w) < 50)
        assert stats[3] == pytest.approx(len(set(w)) / len(w) if w else 1)
        x = np.concatenate([counts / max(1, counts.sum()), stats])
        x = np.clip((x - model.mean) / model.spread, -10, 10)
        x[:cotraining.BUCKETS] /= np.sqrt(cotraining.BUCKETS)
        row = meta[r.doc_id]
        text_raw = float(x @ model.weights[0][:-1].astype(float) + model.weights[0][-1])
        m = model.weights[1].astype(float)
        meta_raw = m[row.m_lang] + m[cotraining.META_BUCKETS + row.m_source] \
            + m[-3] * max(row.m_chars, 0) / 8 + m[-2] * (row.m_chars < 0) + m[-1]
        odds = [a * v + b for v, (a, b) in zip((text_raw, meta_raw), model.scale)]
        a, b = model.last
        assert got[r.doc_id].text_score == pytest.approx(log(odds[0]), abs=1e-6)
        assert got[r.doc_id].meta_score == pytest.approx(log(odds[1]), abs=1e-6)
        assert got[r.doc_id].score == pytest.approx(log(a * (odds[0] + odds[1] - model.prior) + b), abs=1e-6)


def test_op9_scores_by_plain_recomputation(small):
    """The mean of the folded table's rows over a text's subwords, then the softmax."""
    docs, _, _ = small
    model = language_id.fit(language_id.sample(docs, 40, "doc_id", "text", "lang", 1 << 10), 1 << 10)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    for r in docs.limit(80).collect():
        total, n = np.zeros(len(model.languages)), 0
        for found, _ in subwords.buckets([r.text.encode()], 1 << 10):
            for b in found:
                total += model.table[b]
                n += 1
        logits = total / max(1, n) / model.temperature
        p = np.exp(logits - logits.max())
        p /= p.sum()
        if got[r.doc_id].lang_pred == "und":
            assert not any(c.isalpha() for c in r.text)
            continue
        assert got[r.doc_id].lang_pred == model.languages[int(p.argmax())]
        assert got[r.doc_id].score == pytest.approx(p.max(), abs=1e-4)
        assert got[r.doc_id].accepted == (got[r.doc_id].score >= model.least_score)


def test_pipeline_on_odd_rows_and_an_empty_table(spark, small, tmp_path):
    docs, labels, _ = small
    odd = [(None, None, None, None, None), (10 ** 6, None, "en", "s", 0), (10 ** 6, "", "en", None, 0),
           (None, "word " * 70, None, "s", 3), (10 ** 6 + 1, " ".join(f"q{i}" for i in range(30_000)), "en", "s", 9)]
    rows = spark.createDataFrame(odd + odd, docs.schema)
    extra = [F.lit(1).alias(c) for c in ("_mix_copy", "_quality", "_sub_key", "fp", "draw")]
    table = docs.limit(150).unionByName(rows).select("*", *extra)
    for name, part in (("odd", table), ("empty", table.limit(0))):
        sf = str(tmp_path / name)
        part.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        current = spark.read.parquet(f"{sf}/documents.parquet")
        for step, (stage, f) in enumerate(corpus_pipeline.STAGES):
            before, current = current.columns, common.saved(f(spark, current, sf), f"test-{stage}")
            assert step == 4 or current.columns == before
        lengths = current.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
        assert all(r.n <= 2048 for r in lengths) and bool(lengths) == (name == "odd")
        if name == "odd":
            assert 10 ** 6 + 1 in {r.doc_id for r in current.select("doc_id").distinct().collect()}


def test_hot_keys_and_urls_are_split(spark):
    """Home pages of many hosts of one domain, and one url on a third of all pages."""
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    rows = [(i, "https://hot.example.com/en/x" if i % 3 == 0 else f"http://h{i}.com/" if i % 3 == 1
             else f"http://h{i % 40}.net/es/{i % 11}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(6)
    got = url_filters.judge(pages, rules)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan                          # both sides of the join are written tables
    found = {r.page_id: (r._url_rule, r._url_verdict) for r in got.collect()}
    want = {0: ("example.com/en/", "block"), 1: ("com/", "allow"), 2: ("net/es/", "block")}
    assert found == {i: want[i % 3] for i in range(3000)}
    # a key that many pairs share is one row of the sweep
    ends = spark.createDataFrame([(b"com#/", "com/"), (b"com#/\xff", "")], "key binary, top string")
    keys = spark.createDataFrame([(b"com#/",), (b"com#/a",), (b"a",), (b"net#/",)], "key binary")
    tops = {bytes(r.key): r.top for r in url_filters.last_at_or_before(ends, keys).collect()}
    assert tops == {b"com#/": "com/", b"com#/a": "com/", b"a": "", b"net#/": ""}


def test_top_k_over_many_blocks_and_groups(spark):
    """Several query blocks against several groups, at sizes near the defaults' shape; ties; one hot vector."""
    rng = np.random.default_rng(12)
    d, n = 12, 2500
    v = rng.integers(-300, 300, (n, d))
    v[n // 2:n // 2 + 700] = v[3]
    rows = [(i, [float(x) / 256 for x in v[i]]) for i in range(n)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    out = exact_topk.top_k(table, F.col("vec_id") % 3 == 0, 7, group=300, chunk=90).collect()
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    scores = v @ v.T
    assert len(got) == len(range(0, n, 3))
    for q in range(0, n, 3):
        order = sorted((-int(s), i) for i, s in enumerate(scores[q]) if i != q)[:7]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(order)]


def test_rows_that_share_an_id_are_drawn_for_themselves(spark):
    """One id, or none, on a third of a source's rows: the mix still comes near its target."""
    rows = [(1 if i % 3 == 0 else None if i % 7 == 0 else i, " ".join(["w"] * (5 + i % 9)) + f" {i}", f"s{i % 2}")
            for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mixing.mix_report(docs, lambda s: mixing.cyclic_weights(s, (3, 1))).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(out) == 2 and all(abs(r.taken - r.target) <= 20 for r in out)
