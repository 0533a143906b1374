"""The pipeline's stages, each on its own input, against plain versions."""
import corpus_pipeline as P
import brute
from ledgerloom.llm.common import saved

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (name, stage) in enumerate(P.STAGES):
        kept.append(docs)
        docs = saved(stage(spark, docs, SF), f"test-{name}")
        if i + 1 < len(P.STAGES):
            assert docs.columns == columns
    kept.append(docs)
    raw, good, single, short, mixed, packed = (x.collect() for x in kept)

    text = {r.doc_id: r.text for r in raw}
    base = {d for d, t in text.items()
            if (s := brute.quality_statistics(t))[0] >= 50 and 100 * s[4] <= 50 * s[0]}
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in good}
    assert ids <= base
    assert sum(marks.get(d) == 1 for d in base - ids) == 0      # clean documents stay
    assert all(r.text == text[r.doc_id] for r in good)

    want = brute.components({r.doc_id: brute.fingerprint(r.text) for r in good}, 3)
    assert {r.doc_id for r in single} == set(want.values())

    rows = [(r.doc_id, r.text) for r in single]
    left = {d: k for (d, t), k in zip(rows, brute.substring_dedup(rows, 13))}
    assert {r.doc_id for r in short} == {d for d, k in left.items() if k}
    for r in short:
        assert brute.words(r.text) == left[r.doc_id]
        assert len(left[r.doc_id]) != len(brute.words(text[r.doc_id])) or r.text == text[r.doc_id]
        assert r.n_chars == len(r.text)

    size = {}
    for r in short:
        size[r.source] = size.get(r.source, 0) + len(brute.words(r.text))
    taken, copies = dict.fromkeys(size, 0), {}
    for r in mixed:
        taken[r.source] += len(brute.words(r.text))
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2
    assert all(taken[s] <= 2 * size[s] for s in size)
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 0.1 * sum(size.values())

    assert {r.doc_id for r in packed if r.piece == 0} == set(copies)
    assert sum(r.piece == 0 for r in packed) == len(mixed)
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
