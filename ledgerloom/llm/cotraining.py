"""Quality classifier by co-training two views of a document.

Views. The text view sees only the content: frequencies of hashed subwords of the
whole text, and a few statistics of its words and lines. The metadata view sees
only the other columns: hashed language and source, and the stated length.

Co-training. Each view has a logistic classifier, fitted on the labelled documents
of a bounded sample (``max_labelled``). In every round each classifier is
calibrated, scores all unlabelled documents, and hands those of either class that
it is most confident of (``max_handed`` of a class at most), with the label it
gives them, to the other one's training rows; then both are fitted again. A view
that is never confident hands over nothing. Only the training rows are bounded:
every unlabelled document is a candidate in every round. Documents that are alike
in both views are one candidate. At the end each view is calibrated (Platt scaling) on labelled
documents that neither was fitted on, and the calibrated log-odds are added, the
prior counted once; a last scaling on the same documents corrects the sum, as
views are never quite independent.

The whole texts are read once, in parallel; what the views see of them is written
as a table (counts of subwords and the statistics), which the rounds and the last
scoring read. Documents whose checksum puts them in the held-out quarter are never
learned from.

Defined results: a null or blank text has no subwords and statistics 0; null
metadata is a value of its own; documents without an id are scored, not learned
from; rows alike in id, text and metadata are learned from once; labels of documents
that are not there play no part; of several labels of one document the lowest counts, null labels are none;
with labels of one class, or none, the score is that class's share (0.5 without
labels); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import subwords
from .common import bounded_draw, saved, small_side
from .language_id import held_out
from .substring_dedup import word_hashes

BUCKETS = 512
STATISTICS = 7
META_BUCKETS = 128
MAX_BROADCAST_LABELS = 500_000
#: Gradient steps of the first fit: so many that rows times steps is about WORK.
LEAST_STEPS, MOST_STEPS, WORK = 120, 1500, 1_500_000


def _share_distinct(keys: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
    """Distinct keys of each text by its number of keys (1 where it has none)."""
    order = np.lexsort((keys, of))
    k, o = keys[order], of[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    number = np.bincount(of, minlength=n_texts)
    return np.where(number > 0, np.bincount(o[first], minlength=n_texts) / np.maximum(number, 1), 1.0)


def text_statistics(texts: pa.Array) -> np.ndarray:
    """n x STATISTICS: length, word length, symbols, and shares of repeats of words and lines."""
    raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    hashes, offsets = word_hashes(texts)
    n = np.diff(offsets)
    of = np.repeat(np.arange(len(raw)), n)
    words = hashes[0]
    windows = (words[:-2] * np.uint64(31) + words[1:-1]) * np.uint64(37) + words[2:] \
        if len(words) > 2 else words[:0]
    inside = (of[:-2] == of[2:]) if len(words) > 2 else np.zeros(0, bool)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in raw]
    chars = np.array([len(t) for t in raw], float)
    symbols = np.array([sum(map(t.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
                        for t in raw], float)
    per_word = np.maximum(n, 1)
    return np.stack([
        np.log1p(n), chars / per_word, np.minimum(symbols / per_word, 1.0),
        _share_distinct(words, of, len(raw)),
        _share_distinct(windows[inside], of[:-2][inside] if len(words) > 2 else of[:0], len(raw)),
        np.array([len(set(x)) / len(x) if x else 1.0 for x in lines]),
        (n < 50).astype(float)], axis=1)


def metadata_columns(lang: Column, source: Column, n_chars: Column) -> list[Column]:
    """Two hashed categories and a number: what the metadata view sees."""
    bucket = lambda c, seed: F.pmod(F.xxhash64(F.lit(seed), F.coalesce(
        F.concat(F.lit("="), c.cast("string")), F.lit(""))), F.lit(META_BUCKETS)).cast("int")
    return [bucket(lang, "lang").alias("m_lang"), bucket(source, "source").alias("m_source"),
            F.coalesce(F.log1p(F.greatest(n_chars.cast("double"), F.lit(0.0))), F.lit(-1.0)).alias("m_chars")]


def _metadata(rows: dict) -> np.ndarray:
    n = len(rows["m_lang"])
    out = np.zeros((n, 2 * META_BUCKETS + 2))
    out[np.arange(n), rows["m_lang"]] = 1
    out[np.arange(n), META_BUCKETS + np.asarray(rows["m_source"])] = 1
    chars = np.asarray(rows["m_chars"], float)
    out[:, -2], out[:, -1] = np.maximum(chars, 0) / 8, chars < 0
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray | None, steps: int, rate: float = 0.5,
             penalty: float = 1e-4) -> np.ndarray:
    """Weights and intercept by gradient descent with momentum, from ``w``; classes weigh alike."""
    good = y == 1
    weight = np.where(good, 0.5 / max(1, good.sum()), 0.5 / max(1, (~good).sum())).astype(x.dtype)
    w = np.zeros(x.shape[1] + 1, x.dtype) if w is None else w.copy()
    speed = np.zeros_like(w)
    for _ in range(steps):
        error = (sigmoid(x @ w[:-1] + w[-1]) - y) * weight
        grad = np.append(error @ x, error.sum()).astype(x.dtype) + penalty * w
        speed = 0.9 * speed - rate * grad
        w = w + speed
    return w


def platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a score to log-odds: damped Newton steps on smoothed targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    size = raw.std() + 1e-9
    x = np.stack([raw / size, np.ones(len(raw))], 1).astype(float)

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - target @ z

    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = sigmoid(x @ w)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (p - target))
        now = loss(w)
        while loss(w - step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return float(w[0] / size), float(w[1])


@dataclass
class Model:
    mean: np.ndarray            # of the text view's columns
    spread: np.ndarray
    weights: list[np.ndarray]   # text view, metadata view
    scale: list[tuple[float, float]]
    prior: float                # log-odds of good
    last: tuple[float, float]
    exchanged: list[int]        # pseudo-labels handed over in each round

    def standard(self, text: np.ndarray) -> np.ndarray:
        """The text view's columns as its classifier takes them.

        Clipped, as a column that is constant among the labelled rows may not be elsewhere.
        """
        out = np.clip((text - self.mean) / self.spread, -10, 10)
        out[:, :BUCKETS] /= np.sqrt(BUCKETS)
        return out

    def raws(self, text: np.ndarray, meta: dict) -> list[np.ndarray]:
        """Both views' raw scores of frequencies and statistics, and of metadata columns."""
        return [x @ w[:-1].astype(float) + float(w[-1])
                for x, w in zip((self.standard(text), _metadata(meta)), self.weights)]

    def log_odds(self, raws: list[np.ndarray]) -> list[np.ndarray]:
        return [a * r + b for r, (a, b) in zip(raws, self.scale)]

    def combined(self, raws: list[np.ndarray]) -> np.ndarray:
        views = self.log_odds(raws)
        a, b = self.last
        return sigmoid(a * (views[0] + views[1] - self.prior) + b)


def _features(batches):
    """Text view of every row: subword counts in the least type that holds them, statistics."""
    for whole in batches:
        for part in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
            texts, n = pc.fill_null(part.column(0), ""), part.num_rows
            counts = np.zeros(n * BUCKETS, np.int64)
            for found, bounds in subwords.buckets(texts.cast(pa.binary()).to_pylist(), BUCKETS):
                of = np.repeat(np.arange(n), np.diff(bounds))
                counts += np.bincount(of * BUCKETS + found, minlength=n * BUCKETS)
            packed = [c.astype(np.min_scalar_type(c.max())).tobytes() for c in counts.reshape(n, BUCKETS)]
            stats = [x.tobytes() for x in text_statistics(texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed, pa.binary()), pa.array(stats, pa.binary()), *part.columns[1:]],
                names=["counts", "stats", *part.schema.names[1:]])


def _text_view(counts: list[bytes], stats: list[bytes]) -> np.ndarray:
    """n x (BUCKETS + STATISTICS): frequencies of the subwords, then the statistics."""
    out = np.empty((len(counts), BUCKETS + STATISTICS))
    for i, (c, s) in enumerate(zip(counts, stats)):
        out[i, :BUCKETS] = np.frombuffer(c, f"u{len(c) // BUCKETS}")
        out[i, BUCKETS:] = np.frombuffer(s)
    out[:, :BUCKETS] /= np.maximum(out[:, :BUCKETS].sum(1, keepdims=True), 1)
    return out


_META = ("m_lang", "m_source", "m_chars")


def features(docs: DataFrame) -> DataFrame:
    """The written table of what both views see of every row; ``key`` is equal where that is."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("text", "doc_id", *_META, F.xxhash64("text", *_META).alias("key"))
    return saved(rows.mapInArrow(
        _features, f"counts binary, stats binary, doc_id {kind}, m_lang int, m_source int, "
                   "m_chars double, key long"), "cotrain-features")


def _learnable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def _collected(rows: DataFrame, *more: str) -> list[dict]:
    """Bounded rows of the features as :func:`fit` takes them."""
    found = rows.select("counts", "stats", "doc_id", "key", *_META, *more).collect()
    return [{**{c: r[c] for c in ("doc_id", "key", *_META, *more)},
             "view": _text_view([r["counts"]], [r["stats"]])[0].astype(np.float32).tobytes()}
            for r in found]


def known_labels(labels: DataFrame) -> DataFrame:
    """The written label of every labelled id."""
    return saved(labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
                 .groupBy("doc_id").agg(F.min("quality").alias("label")), "cotrain-labels")


def sample(rows: DataFrame, marks: DataFrame, max_labelled: int) -> list[dict]:
    """The two views of ``max_labelled`` labelled documents at most, drawn by hash of the row.

    Only documents that are there and not held out are drawn from. An id on many rows
    gives one row for each of its texts and metadata.
    """
    learnable = _learnable(rows)
    known = saved(learnable.select("doc_id", "key").join(
        small_side(marks, MAX_BROADCAST_LABELS), "doc_id").distinct(), "cotrain-known")
    drawn = saved(bounded_draw(known, max_labelled, "doc_id", "key"), "cotrain-drawn")
    found = _collected(learnable.join(F.broadcast(drawn), ["doc_id", "key"])
                       .dropDuplicates(["doc_id", "key"]), "label")
    return sorted(found, key=lambda r: (r["doc_id"], r["view"]))


class Listed:
    """Candidates for pseudo-labels that are rows in memory."""

    def __init__(self, rows: list):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def surest(self, model: Model, edge: float, most: int, taken: list[set]) -> list[tuple]:
        if not self.rows:
            return []
        text = np.stack([np.frombuffer(r["view"], np.float32) for r in self.rows])
        odds = model.log_odds(model.raws(text, {c: [r[c] for r in self.rows] for c in _META}))
        out = []
        for mine, label in ((0, 0), (0, 1), (1, 0), (1, 1)):
            z = odds[mine] if label else -odds[mine]
            order = [i for i in np.argsort(-z, kind="stable") if z[i] >= edge and i not in taken[1 - mine]]
            out += [(1 - mine, label, int(i), self.rows[i]) for i in order[:most]]
        return out


class Unlabelled:
    """All documents of the features that are not held out and have no label, as candidates."""

    def __init__(self, rows: DataFrame, marks: DataFrame):
        self.rows, self.marks = _learnable(rows), marks.select("doc_id")

    def __len__(self) -> int:
        return self.rows.select("doc_id").join(self.marks, "doc_id", "left_anti").count()

    def surest(self, model: Model, edge: float, most: int, taken: list[set]) -> list[tuple]:
        """(receiving view, label, key, row) of the ``most`` surest of either view and class."""
        kind = self.rows.schema["doc_id"].dataType.simpleString()

        def run(batches):       # narrow rows, and only those that a view is sure of
            for batch, raws in _view_raws(batches, model):
                z = [np.round(x, 6) for x in model.log_odds(raws)]
                sure = np.flatnonzero((np.abs(z[0]) >= edge) | (np.abs(z[1]) >= edge))
                take = pa.array(sure)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("key").take(take),
                     *(pa.array(x[sure]) for x in z)], names=["doc_id", "key", "z0", "z1"])

        scored = self.rows.select("counts", "stats", "doc_id", *_META, "key").mapInArrow(
            run, f"doc_id {kind}, key long, z0 double, z1 double")
        scored = saved(scored.join(self.marks, "doc_id", "left_anti").groupBy("key").agg(
            F.max("z0").alias("z0"), F.max("z1").alias("z1")), "cotrain-sure")
        picked = []
        for mine, label in ((0, 0), (0, 1), (1, 0), (1, 1)):
            z, known = F.col(f"z{mine}") * F.lit(2 * label - 1), taken[1 - mine]
            best = (scored.filter(z >= edge).orderBy(z.desc(), "key").limit(most + len(known))
                    .select("key").collect())       # bounded; every partition gives its best
            keys = [r["key"] for r in best if r["key"] not in known][:most]
            picked += [(1 - mine, label, k) for k in keys]
        if not picked:
            return []
        wanted = self.rows.sparkSession.createDataFrame(
            [(k,) for k in sorted({k for _, _, k in picked})], "key long")
        found = _collected(self.rows.join(F.broadcast(wanted), "key").dropDuplicates(["key"]))
        by_key = {r["key"]: r for r in found}
        return [(view, label, k, by_key[k]) for view, label, k in picked]


def fit(rows: list, rounds: int = 4, per_round: float = 0.1, confident: float = 0.98,
        steps: int | None = None, pool: Listed | Unlabelled | None = None,
        max_handed: int = 600) -> Model | None:
    """Co-train on the sample's labelled rows; None without both classes.

    ``pool`` holds the candidates for pseudo-labels; without one they are the rows
    that have no label. A view hands over at most ``max_handed`` rows of a class in
    a round, and at most ``per_round`` of all candidates. ``steps``: of the first fit,
    a quarter of it in later rounds; by default ``WORK`` steps times rows, but between
    ``LEAST_STEPS`` and ``MOST_STEPS``: a small sample needs more passes to converge.
    """
    if pool is None:
        pool = Listed([r for r in rows if r["label"] is None])
    rows = [r for r in rows if r["label"] is not None]
    y = np.array([r["label"] for r in rows], int)
    if not ((y == 0).sum() >= 2 and (y == 1).sum() >= 2):
        return None
    text = np.stack([np.frombuffer(r["view"], np.float32) for r in rows])
    mean, spread = text.mean(0), text.std(0) + 1e-3
    model = Model(mean, spread, [], [], float(np.log((y == 1).sum() / (y == 0).sum())), (1.0, 0.0), [])

    def views(some: list) -> list[np.ndarray]:
        seen = np.stack([np.frombuffer(r["view"], np.float32) for r in some])
        return [model.standard(seen).astype(np.float32),
                _metadata({c: [r[c] for r in some] for c in _META}).astype(np.float32)]

    held = np.zeros(len(rows), bool)
    for label in (0, 1):        # every fourth labelled row of either class calibrates
        held[np.flatnonzero(y == label)[3::4]] = True
    if not all(((y == k) & held).any() for k in (0, 1)):
        held[:] = False
    check = np.flatnonzero(held if held.any() else ~held)
    own = views(rows)
    checked = [x[check] for x in own]
    train, known = [x[~held] for x in own], [y[~held], y[~held]]
    taken: list[set] = [set(), set()]
    steps = steps or max(LEAST_STEPS, min(MOST_STEPS, WORK // len(rows)))
    most = max(1, min(max_handed, int(per_round * len(pool))))
    edge = float(np.log(confident / (1 - confident)))
    before = [None, None]
    for turn in range(rounds + 1):
        model.weights = [logistic(x, labels, w, steps if turn == 0 else steps // 4)
                         for x, labels, w in zip(train, known, before)]
        raws = [x @ w[:-1] + w[-1] for x, w in zip(checked, model.weights)]
        model.scale = [platt(raw, y[check]) for raw in raws]
        before = model.weights
        if turn == rounds:
            break
        handed = pool.surest(model, edge, most, taken)
        for to in (0, 1):
            new = [(label, key, row) for view, label, key, row in handed if view == to]
            if new:
                train[to] = np.concatenate([train[to], views([row for _, _, row in new])[to]])
                known[to] = np.append(known[to], [label for label, _, _ in new])
                taken[to].update(key for _, key, _ in new)
        model.exchanged.append(len(handed))
    odds = model.log_odds(raws)
    model.last = platt(odds[0] + odds[1] - model.prior, y[check])
    return model


def _view_raws(batches, model: Model):
    """Batches of the features and both views' raw scores of their rows."""
    for whole in batches:
        for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
            text = _text_view(batch.column("counts").to_pylist(), batch.column("stats").to_pylist())
            yield batch, model.raws(text, {c: batch.column(c).to_numpy() for c in _META})


def score(rows: DataFrame, model: Model | None, share: float = 0.5) -> DataFrame:
    """doc_id, score and both views' calibrated probabilities, for every row of the features."""
    if model is None:
        return rows.select("doc_id", *(F.lit(float(share)).alias(c)
                                       for c in ("score", "text_score", "meta_score")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch, raws in _view_raws(batches, model):
            seen = [sigmoid(x) for x in model.log_odds(raws)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.float64()) for x in
                                           (model.combined(raws), *seen))],
                names=["doc_id", "score", "text_score", "meta_score"])

    return rows.select("counts", "stats", "doc_id", *_META).mapInArrow(
        run, f"doc_id {kind}, score double, text_score double, meta_score double")


def classify(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000, threshold: float = 0.5,
             doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             source: str = "source", n_chars: str = "n_chars", **how) -> DataFrame:
    """doc_id, held_out, score, text_score, meta_score and kept for every row of ``docs``.

    ``labels``: (doc_id, quality), 1 good, 0 bad.
    """
    rows = features(docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"),
                                *metadata_columns(docs[lang], docs[source], docs[n_chars])))
    marks = known_labels(labels)
    drawn = sample(rows, marks, max_labelled)
    known = [r["label"] for r in drawn]
    model = fit(drawn, pool=Unlabelled(rows, marks), **how)
    out = score(rows, model, sum(known) / len(known) if known else 0.5)
    return out.withColumn("held_out", held_out(F.col("doc_id"))).withColumn(
        "kept", F.col("score") >= threshold)
