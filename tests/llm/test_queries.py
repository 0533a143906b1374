"""The opN queries on the smallest tables: DuckDB where SQL can say it, else brute force."""
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
import brute
from ledgerloom.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_all_and_the_pipeline_are_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(map(repr, cur.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want


def test_op3_statistics_and_verdicts(spark):
    texts = _texts(spark)
    rows = E.queries()["op3_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    bad = {r.doc_id: r.quality == 0 for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = 0
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute.quality_statistics(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
        wrong += not r.base_failed and r.doc_id in bad and bad[r.doc_id] == r.kept
    assert wrong <= 0.02 * len(bad)


def test_op10_components(spark):
    texts = _texts(spark)
    fps = {d: brute.fingerprint(t) for d, t in texts.items()}
    want = brute.components(fps, 3)
    rows = E.queries()["op10_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        d: (f"{fps[d]:016x}", want[d]) for d in texts}


def test_op6_by_brute_force(spark):
    docs = sorted(_texts(spark).items())
    kept = brute.substring_dedup(docs, 13)
    rows = {r.doc_id: r for r in E.queries()["op6_substring_dedup"](spark, SF).collect()}
    for (d, text), k in zip(docs, kept):
        assert rows[d].n_removed == rows[d].n_words - len(k)
        assert rows[d].kept_sha256 == hashlib.sha256(" ".join(k).encode()).hexdigest()


def test_op8_and_op9_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = [r for r in E.queries()["op9_language_id"](spark, sf).collect()]
    assert len(found) == len(langs) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)
    good = {r.doc_id: r.quality == 1 for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = E.queries()["op8_quality_classifier"](spark, sf).collect()
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in good]
    assert sum(r.kept == good[r.doc_id] for r in held) >= 0.95 * len(held)
