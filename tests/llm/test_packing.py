"""Packing: ids equal to the tokenizer's, pieces as cut, gapless sequences, few of them."""
import functools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import packing as K

SF = "/root/testdata/sf0.001"


@functools.cache
def _encoder():
    return K.Encoder(K.tokenizer_files())


@pytest.fixture(scope="module")
def encoder():
    return _encoder()


def _ids(encoder, text):
    return np.frombuffer(encoder.ids(text), np.uint32).tolist()


@settings(max_examples=200, deadline=None)
@given(text=st.one_of(st.text(), st.text(alphabet="ab' \n\té1²<|endoftext|>"),
                      st.lists(st.text(alphabet="we'll é,.ß12")).map(" ".join)))
def test_ids_equal_tokenizer(text):
    enc = _encoder()
    text = text.encode("utf-8", "ignore").decode()
    assert _ids(enc, text) == enc.full.encode(text, add_special_tokens=False).ids


def test_ids_odd_texts(encoder):
    for text in ["a <|endoftext|> b", "  x  y ", "x\n y", "a b\n\nc d", "\x1c a\x85b   c",
                 "日本 語 テキ スト", "", " ", "it's we'll"]:
        assert _ids(encoder, text) == encoder.full.encode(text, add_special_tokens=False).ids


def test_cut():
    assert K.cut(5, 8) == [(0, 5)]
    assert K.cut(8, 8) == [(0, 8)]
    assert K.cut(16, 8) == [(0, 8), (8, 8)]
    assert K.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def _check(rows, capacity):
    """Every sequence is filled without a gap and within the capacity; returns their number."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_on_small_table(spark, encoder):
    import __spark_entry__ as E

    rows = E.queries()["op2_packing"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {}
    for d, text in docs.items():
        ids = encoder.full.encode(text or "", add_special_tokens=False).ids + [0]
        raw = np.array(ids, "<u4").tobytes()
        for k, (s, n) in enumerate(K.cut(len(ids), 2048)):
            want[d, k] = (s, n, zlib.crc32(raw[4 * s:4 * (s + n)]))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    total = sum(n for _, n, _ in want.values())
    assert len(rows) == len(want)
    assert _check(rows, 2048) <= -(-total // 2048) + 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_sweep_is_best_fit_decreasing(lengths):
    """The runs' outcome has as many bins as best fit decreasing item by item."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(20 - n)
    runs = [(n, lengths.count(n)) for n in set(lengths)]
    plan = K.sweep(runs, 20)
    used = {}
    for length, lo, hi, first, per, offset in plan:
        for r in range(lo, hi):
            used.setdefault(first + (r - lo) // per, []).append(
                (offset + (r - lo) % per * length, length))
    for parts in used.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 20
    assert len(used) == len(gaps)
    assert sum(map(len, used.values())) == len(lengths)


def test_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows, clashing column names, empty table."""
    rows = [(1, None, 1), (None, "a b", 2), (None, "a b", 2), (3, "", 3), (4, "word " * 9000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank long")
    out = K.pack_documents(docs, 64).collect()
    assert sum(r.length == 1 for r in out if r.doc_id in (1, 3)) == 2
    assert sum(r.doc_id is None for r in out) == 2
    assert sum(r.length for r in out if r.doc_id == 4) >= 9000
    _check(out, 64)
    assert K.pack_documents(docs.limit(0), 64).count() == 0


def test_hot_length_and_sequences(spark):
    """Most documents have one length; the sequences hold all ids."""
    docs = spark.range(400).selectExpr(
        "id as doc_id", "case when id % 3 > 0 then 'one two three' else repeat('x ', int(id)) end as text")
    out = K.pack_documents(docs.repartition(7), 50).collect()
    n = _check(out, 50)
    seqs = K.token_sequences(docs, 50).collect()
    assert len(seqs) == n and sum(s.n_ids for s in seqs) == sum(r.length for r in out)
    assert all(len(s.ids) == 4 * s.n_ids <= 200 for s in seqs)
