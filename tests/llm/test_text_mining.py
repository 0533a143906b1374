"""Decontamination, collocations and periodic runs against brute force; odd rows; hot keys."""
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
import brute
from ledgerloom.llm import collocations, decontamination, periodic_runs

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
TEXTS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four " * 40),
         (5, "one two three four " * 40), (None, "one two three four " * 40), (7, LONG),
         (8, "ONE two\x0bthree\x85four É z # * $ a.b,c"), (9, "x" * 70_000), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en" if i % 2 else None, i, i, i, i, i) for i, (d, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, row int, _runs int, "
                                 "term int, phrase int, `a b` int")


# ---- periodic runs ------------------------------------------------------------------

def test_find_runs_by_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(0, 4)):
            n, k = rng.randint(0, 220), rng.choice([1, 2, 2, 3, 60])
            w = [rng.randrange(k) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n > 8 else 0):
                a = rng.randrange(n)
                p, m = rng.randint(1, max(1, (n - a) // 4)), rng.randint(a, n)
                for i in range(a, m):
                    w[i] = w[a + (i - a) % p]
            texts.append(w)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = periodic_runs.find_runs(np.array([x for t in texts for x in t], np.int64), offsets)
        want = [(s + o, s + n + o, q) for t, o in zip(texts, offsets.tolist())
                for s, n, q in brute.runs(t, 4, 4)]
        assert sorted(map(tuple, got.tolist())) == sorted(want)


@pytest.mark.parametrize("text", [
    [bin(i).count("1") & 1 for i in range(1200)],                       # overlap-free
    ([0, 1, 0, 0, 1, 0, 1, 0, 0, 1, 0, 0, 1] * 3 + [7]) * 9,              # runs inside runs
    [0] * 500 + [1] + [0] * 500, [0, 1] * 300 + [0, 2] * 300, list(range(130)) * 5])
def test_find_runs_in_structured_texts(text):
    got = periodic_runs.find_runs(np.array(text), np.array([0, len(text)]))
    assert sorted((s, e - s, q) for s, e, q in got.tolist()) == sorted(brute.runs(text, 4, 4))


def test_annotate_odd_rows(spark, docs):
    out = periodic_runs.annotate(docs)
    assert out.columns == [*docs.columns, "_runs_", "_collapsed"]
    rows = out.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        w = brute.words(r.text)
        want = [(0, 160, 4)] if len(w) == 160 else []
        assert [tuple(x) for x in r._runs_] == want
        assert r._collapsed == brute.collapsed(w, want)
    assert periodic_runs.annotate(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.annotate(docs, min_exponent=3)


def _made_periodic(doc_id, text):
    w, h = brute.words(text), zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def test_op13_by_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = E.queries()["op13_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(texts)
    assert any(r.n_runs for r in rows) and any(not r.n_runs for r in rows)
    for r in rows:
        w = _made_periodic(r.doc_id, texts[r.doc_id])
        if len(w) > 3000 and r.n_runs == 0:
            continue                                    # too long for the plain version
        found = brute.runs(w)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (r.start, r.length, r.period, r.exponent_milli) == want and r.n_runs == len(found)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute.collapsed(w, found).encode()).hexdigest()


# ---- collocations -------------------------------------------------------------------

def test_merged_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(2)
    stream = rng.zipf(1.3, 60_000) % 9_000
    least = 100
    held, lost = [], 0
    for part in np.array_split(stream, 37):
        keys, counts = np.unique(part, return_counts=True)
        held.append((keys, counts))
        if len(held) == 3:
            keys, counts, taken = collocations.merge(held, len(stream) // least)
            held, lost = [(keys, counts)], lost + taken
    keys, counts, taken = collocations.merge(held, len(stream) // least)
    lost += taken
    assert len(keys) <= len(stream) // least
    full = dict(zip(*np.unique(stream, return_counts=True)))
    assert {k for k, n in full.items() if n >= least} <= set(keys.tolist())
    assert 0 < lost < least
    assert all(full[k] - lost <= c <= full[k] for k, c in zip(keys.tolist(), counts.tolist()))
    sure = {k for k, c in zip(keys.tolist(), counts.tolist()) if c + lost >= least}
    assert {k for k, n in full.items() if n >= least} <= sure


@pytest.mark.parametrize("least,percent,bits", [(5, 100, 1 << 16), (3, 80, 64), (2, 100, 1 << 20)])
def test_collocations_by_brute_force(spark, least, percent, bits):
    rng = random.Random(least)
    vocabulary = [f"Wo{i}" for i in range(25)] + ["la", "la", "de", "Été"]
    rows = [(rng.choice(["en", "fr", None, "und"]),
             "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "; "])
                     for _ in range(rng.randint(0, 60))) + "New York city hall") for _ in range(60)]
    rows += [("en", None), (None, None), ("en", ""), ("fr", " . ,")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    got = collocations.collocations(docs, least, 5, percent, filter_bits=bits)
    assert {tuple(r) for r in got.collect()} == brute.collocations(rows, least, 5, percent)


def test_slices_of_a_batch_count_alike(monkeypatch):
    """Slices that begin inside a batch, with texts that end and begin in a word."""
    rng = random.Random(1)
    rows = [(rng.choice(["en", None, "fr"]), None if i % 9 == 0 else "A".join(
        rng.choice(["x y", "x. y ", "É z", "", "\t"]) for _ in range(rng.randint(0, 9)))) for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])],
                                       names=["lang", "text"])
    want, total = brute.phrases(rows, 4)
    for size, held in ((1 << 20, 10 ** 6), (300, 50), (7, 1)):
        monkeypatch.setattr(collocations, "SLICE_BYTES", size)
        monkeypatch.setattr(collocations, "HELD_ROWS", held)
        got, words = {}, {}
        sent = sorted((b.slice(i, 1) for b in collocations._count(
            [batch], 4, np.full(1 << 10, 255, np.uint8), 4, 8) for i in range(b.num_rows)),
            key=lambda b: b.column(0)[0].as_py())
        for out in collocations._frequent(sent, 1):
            for lang, k, phrase, f in zip(*(c.to_pylist() for c in out.columns)):
                into, key = (got, (lang, tuple(phrase.split(" ")))) if k else (words, lang)
                into[key] = into.get(key, 0) + f
        assert got == want and {k: n for k, n in words.items() if n} == {k: n for k, n in total.items() if n}
        mass = sum(r for out in collocations._summarise([batch], 4, 6)
                   for r, kind in zip(out.column(2).to_pylist(), out.column(1).to_pylist()) if kind == 0)
        assert mass == sum(want.values())


def test_collocations_odd_rows(spark, docs):
    got = {tuple(r) for r in collocations.collocations(docs, 3).collect()}
    assert got == brute.collocations([(r.lang, r.text) for r in docs.collect()], 3, 5, 100)
    assert collocations.collocations(docs.limit(0)).count() == 0
    top = collocations.ranked(collocations.collocations(docs, 3), 2).collect()
    assert {r["rank"] for r in top} <= {1, 2}


def test_frequent_phrases_over_many_slices(spark, monkeypatch):
    """Summaries of many small slices; a phrase on every document is hot."""
    rng = random.Random(9)
    rows = [("en", "every time " + " ".join(f"v{rng.randrange(300)}" for _ in range(200)))
            for _ in range(300)]
    monkeypatch.setattr(collocations, "PARTITION_BYTES", 1 << 10)
    got = collocations.frequent_phrases(spark.createDataFrame(rows, "lang string, text string")
                                        .repartition(40), 40, 3).collect()
    counts, total = brute.phrases(rows, 3)
    want = {(lang, len(w), " ".join(w), n) for (lang, w), n in counts.items() if n >= 40}
    assert {(r.lang, r.k, r.phrase, r.f) for r in got if r.k} == want
    assert [r.f for r in got if not r.k] == [total["en"]]


# ---- decontamination -------------------------------------------------------------------

def _corpus(rng, n):
    vocabulary = [f"T{i}" for i in range(40)] + ["the"] * 10
    return [(i if rng.random() > .1 else None, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 90))))
            for i in range(n)]


def test_decontamination_by_brute_force(spark, docs):
    rng = random.Random(4)
    rows = _corpus(rng, 120) + TEXTS
    items = [(f"i{i}", text) for i, (_, text) in enumerate(_corpus(rng, 12))]
    items += [("short", "T1 the"), ("word", "T7"), ("none", None), ("blank", " .. "), ("none", ""),
              (None, "one two three four one two three four one"), ("dup", "the the the the"),
              ("absent", "nowhere the the"), ("i3", "the the the"), ("dup", "the the the the")]
    items += [(f"part{k}", " ".join(rows[k][1].split()[5:19])) for k in (3, 8, 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    tests = spark.createDataFrame(items, "item_id string, text string")
    got = decontamination.decontaminate(frame, tests, 6).collect()
    known = brute.windows([(i, brute.test_words(t)) for i, t in items], 6)
    want = []
    for d, text in rows:
        w, hit, named = brute.test_words(text), set(), set()
        for length in {len(k) for k in known}:
            for i in range(len(w) - length + 1):
                if (found := known.get(tuple(w[i:i + length]))) is not None:
                    hit |= set(range(i, i + length))
                    named |= found - {None}
        want.append((d, len(w), len(hit), sorted(named)))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=str) == sorted(want, key=str)
    assert any(h for _, _, h, _ in want) and any(not h for _, _, h, _ in want)


def test_decontamination_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0
    rows = decontamination.decontaminate(docs, items.limit(0)).collect()
    assert len(rows) == len(TEXTS) and not any(r.n_hit or r.item_ids for r in rows)
    rows = decontamination.decontaminate(docs, items, 3).collect()
    assert sorted(r.item_ids for r in rows if r.n_hit) == [["1"]] * 3


def test_proximity_by_brute_force(spark):
    rng = random.Random(8)
    rows = _corpus(rng, 60)
    items = [("a", "T1 T2 T3"), ("b", "the T9 the"), ("c", "T5"), ("d", "T1 nowhere"), ("e", "T11 T12")]
    span = 9
    tests = decontamination.tests_of(spark.createDataFrame(items, "item_id string, text string"), 6)
    index = decontamination.build_index(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5), tests)
    got = (decontamination.proximity_matches(index, tests, span).join(tests.items, "win")
           .join(decontamination.documents_of(index), "row").collect())
    want = []
    for d, text in rows:
        w = brute.test_words(text)
        for item, phrase in items:
            need = set(brute.test_words(phrase))
            starts = [i for i in range(len(w)) if w[i] in need and need <= set(w[i:i + span])]
            if starts:
                want.append((d, len(w), item, min(starts)))
    assert want and sorted(((r.doc_id, r.n_words, r.item_id, r.start) for r in got), key=str) == \
        sorted(want, key=str)


def test_summaries_of_a_task_add_up(monkeypatch):
    """Slices counted together, sent in several parts: masses and counts are those of all n-grams."""
    rng = random.Random(3)
    rows = [("en", " ".join(f"v{rng.randrange(60)}" for _ in range(50))) for _ in range(80)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])],
                                       names=["lang", "text"])
    monkeypatch.setattr(collocations, "SLICE_BYTES", 700)
    found = []
    for held in (10 ** 9, 2000, 1):
        monkeypatch.setattr(collocations, "HELD_KEYS", held)
        counts = {}
        for out in collocations._summarise([batch], 3, 5):
            for part, kind, mass, keys, number in zip(*(c.to_pylist() for c in out.columns)):
                if kind == 1:
                    ks, ns = np.cumsum(collocations._unpack(keys)), collocations._unpack(number)
                    assert ns.sum() == mass and (np.diff(ks) > 0).all()
                    for k, n in zip(ks.tolist(), ns.tolist()):
                        counts[part, k] = counts.get((part, k), 0) + n
        found.append(counts)
    assert found[0] == found[1] == found[2]
    full, _ = brute.phrases(rows, 3)
    assert sorted(found[0].values()) == sorted(full.values())
