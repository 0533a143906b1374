"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the average of the embeddings of its hashed subwords, a linear layer and
a softmax follow; both are trained by stochastic gradient descent in numpy. The
fit uses a bounded sample: at most ``per_language`` documents of each language,
drawn by hash of id and text; their whole texts are reduced to bucket counts by the
executors. Every tenth of the sample calibrates: a temperature that minimises the
log loss, and the score below which a prediction is rejected so that the accepted
ones reach ``precision``. A sample of under ten documents has no tenth and
calibrates on what it was trained on.

Prediction covers whole texts in parallel. The two layers are folded into one
table (bucket -> a logit for each language), so a text is the mean of table rows.

Defined results: texts that are null or hold no letter are ``und`` with score 0
and are not learned from; documents without an id are predicted, not learned from;
repeated rows are predicted alike and learned from once; without anything to learn from all are
``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import subwords
from .common import saved

UNKNOWN = "und"
BUCKETS, DIMENSIONS = 1 << 13, 16


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray           # buckets x languages: logits, at temperature 1
    temperature: float
    least_score: float          # below it a prediction is rejected

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        total = np.zeros((len(texts), len(self.languages)))
        number = np.zeros(len(texts))
        for found, bounds in subwords.buckets(texts, len(self.table)):
            number += np.diff(bounds)
            for c in range(len(self.languages)):
                total[:, c] += subwords.sums(self.table[found, c], bounds)
        return softmax(total / np.maximum(number, 1)[:, None] / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    """Every fourth document by checksum of its id; not learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2,
                      F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _bucket_counts(batches, n_buckets: int):
    for batch in batches:
        for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            found = [subwords.counts(t, n_buckets)
                     for t in part.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2),
                 pa.array([b.astype(np.int32).tobytes() for b, _ in found], pa.binary()),
                 pa.array([n.astype(np.float32).tobytes() for _, n in found], pa.binary())],
                names=["lang", "draw", "buckets", "counts"])


def sample(docs: DataFrame, per_language: int, doc_id: str, text: str, lang: str,
           n_buckets: int) -> list:
    """Bucket counts of the drawn documents, in a fixed order (bounded rows).

    At most ``per_language`` of each language; an id on many rows gives one for each of
    its texts.
    """
    rows = docs.select(docs[text].cast("string").alias("text"), docs[lang].cast("string").alias("lang"),
                       docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("tid")).filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
        & has_letter(F.col("text")))
    key = ["lang", "doc_id", "tid"]
    known = saved(rows.select(*key).distinct(), "language-known")
    sizes = known.groupBy("lang").count()                   # a row a language
    draw = F.xxhash64(F.col("doc_id").cast("string"), "tid", F.lit("draw"))
    near = known.join(F.broadcast(sizes), "lang").withColumn("draw", draw).filter(
        F.pmod("draw", F.lit(1 << 40)) * F.col("count")
        < F.lit((1.1 * per_language + 100) * (1 << 40)))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "tid"))
    drawn = saved(near.withColumn("place", first).filter(F.col("place") <= per_language)
                  .select(*key, "draw"), "language-drawn")
    found = (rows.join(F.broadcast(drawn), key).dropDuplicates(key).select("text", "lang", "draw")
             .mapInArrow(lambda b: _bucket_counts(b, n_buckets),
                         "lang string, draw long, buckets binary, counts binary").collect())
    return sorted(found, key=lambda r: (r["draw"], r["lang"], r["buckets"]))


def fit(rows: list, n_buckets: int = BUCKETS, dimensions: int = DIMENSIONS, epochs: int = 6,
        rate: float = 4.0, batch: int = 32, precision: float = 0.99, seed: int = 0) -> Model | None:
    """Train on the sample's rows; every tenth calibrates."""
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    x = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.float32)) for r in rows]
    y = np.array([languages.index(r["lang"]) for r in rows])
    held = np.arange(len(rows)) % 10 == 9
    train = np.flatnonzero(~held)
    embed = rng.uniform(-1 / dimensions, 1 / dimensions, (n_buckets, dimensions)).astype(np.float32)
    out = np.zeros((dimensions, len(languages)), np.float32)
    steps, done = epochs * -(-len(train) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(train)
        for a in range(0, len(order), batch):
            picked = order[a:a + batch]
            bag = np.zeros((len(picked), n_buckets), np.float32)
            for i, d in enumerate(picked):
                bag[i, x[d][0]] = x[d][1] / max(1.0, x[d][1].sum())
            mean = bag @ embed
            error = softmax(mean @ out)
            error[np.arange(len(picked)), y[picked]] -= 1
            error = (error / len(picked)).astype(np.float32)
            speed = rate * (1 - done / steps)
            used = np.flatnonzero(bag.any(0))
            step = bag[:, used].T @ (error @ out.T)
            out -= speed * (mean.T @ error)
            embed[used] -= speed * dimensions * step
            done += 1
    table = (embed @ out).astype(np.float32)
    check = np.flatnonzero(held) if held.any() else train
    logits = np.array([(table[x[d][0]] * x[d][1][:, None]).sum(0) / max(1.0, x[d][1].sum())
                       for d in check])
    # smoothed targets keep the temperature finite where all of the sample is right
    spread = 1 / (len(check) + 2)
    target = np.full((len(check), len(languages)), spread / max(1, len(languages) - 1))
    target[np.arange(len(check)), y[check]] = 1 - spread
    grid = np.geomspace(0.002, 20, 80)
    loss = [-(target * np.log(softmax(logits / t) + 1e-12)).sum(1).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    scores = softmax(logits / temperature)
    right = scores.argmax(1) == y[check]
    by_score = np.argsort(-scores.max(1), kind="stable")
    good = np.cumsum(right[by_score]) / np.arange(1, len(check) + 1)
    reach = np.flatnonzero(good >= precision)
    least = float(scores.max(1)[by_score][reach[-1]]) if len(reach) else 1.0
    return Model(languages, table, temperature, least)


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, accepted for every row of ``docs``; only the text is looked at."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"),
                       has_letter(docs[text]).alias("letters"))
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"),
                           F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                letters = batch.column(2).to_numpy(zero_copy_only=False)
                texts = batch.column(1).cast(pa.binary()).to_pylist()
                scores = model.scores([t if ok else None for t, ok in zip(texts, letters)])
                best = np.where(letters, scores.max(1), 0.0)
                names = [model.languages[k] if ok else UNKNOWN
                         for k, ok in zip(scores.argmax(1), letters)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(names, pa.string()), pa.array(best, pa.float64()),
                     pa.array(letters & (best >= model.least_score))],
                    names=["doc_id", "lang_pred", "score", "accepted"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def identify(docs: DataFrame, per_language: int = 1000, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang", n_buckets: int = BUCKETS, **how) -> DataFrame:
    """Learn from the documents that are not held out, predict all: :func:`predict`'s columns."""
    model = fit(sample(docs, per_language, doc_id, text, lang, n_buckets), n_buckets, **how)
    out = predict(docs, model, doc_id, text)
    return out.withColumn("held_out", held_out(F.col("doc_id")))
