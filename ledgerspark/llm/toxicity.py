"""Toxicity scores by non-negative positive-unlabelled learning, in numpy.

Confirmed toxic texts are the positives; all other training texts count as unlabelled, never as
clean. With class prior pi the risk is pi * R+(positive) + max(0, R-(unlabelled) - pi *
R-(positive)); where the second part turns negative, the step goes the other way on it, so a
flexible model cannot drive it below zero. The model is linear over the hashed words of a text
and the first bytes of its words (inflected forms share them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.hashing import PUNCTUATION, row_of, slices, utf8, word_hashes
from ledgerspark.session import written

#: Hashed features: 2 ** BITS weights of 4 bytes, which is all that is broadcast.
BITS = 20
HEADS = (4, 5, 6)
#: Bounds of the training sample, taken by a hash of the id: confirmed and unlabelled texts.
POSITIVES, UNLABELLED = 3_000, 12_000
STEPS, RATE, DECAY = 500, 1.0, 1e-5
#: A feature is learnt if its share of texts differs between the two samples by so many standard errors, and
#: by so many per square root of a confirmed text (the same difference is clearer in a larger sample), ...
CLEAR, EFFECT = 5.0, 0.28
#: ... and if this share of the confirmed texts has it: a word of a few texts may be there by chance.
SHARE = 0.02
#: Decision level of ``predicted``.
LEVEL = 0.7


def features(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each text, row after row, and where each row's begin."""
    hashes, bounds = word_hashes(*utf8(batch.column(text)), PUNCTUATION, HEADS)
    kinds = np.arange(1, hashes.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    buckets = ((hashes ^ kinds) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    rows = row_of(bounds).astype(np.uint64)
    keys = np.unique((rows[:, None] << np.uint64(BITS)) | buckets)
    starts = np.searchsorted(keys, np.arange(batch.num_rows + 1, dtype=np.uint64) << np.uint64(BITS))
    return (keys & np.uint64((1 << BITS) - 1)).astype(np.int64), starts


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, batch: pa.RecordBatch, text: str) -> np.ndarray:
        found, starts = features(batch, text)
        return sigmoid(row_sums(self.weights[found], starts) + self.bias)


def fit(found: np.ndarray, starts: np.ndarray, positive: np.ndarray, prior: float, kept: np.ndarray) -> Model:
    """AdaGrad on the non-negative risk with logistic loss, over the features ``kept``.

    ``found`` numbers a text's features by their place in ``kept``. Without positives every score
    is near zero, without unlabelled texts near the prior.
    """
    weights = np.zeros(1 << BITS, np.float32)
    bias, bias_square = float(np.log(prior / (1 - prior))), 1e-4
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    if not n_p:
        return Model(weights, -10.0)
    if not n_u:
        return Model(weights, bias)
    owners = row_of(starts)
    w, squares = np.zeros(len(kept)), np.full(len(kept), 1e-4)
    for _ in range(STEPS):  # over the whole sample: in small batches the clamp sets in by chance
        score = sigmoid(np.bincount(owners, w[found], len(positive)) + bias)
        sp, su = score[positive], score[~positive]
        as_clean = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        clean, toxic = np.empty(len(positive)), np.zeros(len(positive))
        clean[positive], clean[~positive] = -prior * sp / n_p, su / n_u
        toxic[positive] = prior * (sp - 1) / n_p
        slope = toxic + clean if as_clean >= 0 else -clean
        step = np.bincount(found, slope[owners], len(w)) + DECAY * w
        squares += step ** 2
        w -= RATE * step / np.sqrt(squares)
        bias_square += slope.sum() ** 2
        bias -= RATE * slope.sum() / np.sqrt(bias_square)
    weights[kept] = w
    return Model(weights, float(bias))


def telling(sample: DataFrame, text: str) -> np.ndarray:
    """Features that tell the two samples apart, by counts merged per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for rows in slices(batch, text):
                found, starts = features(rows, text)
                side = np.array(rows.column("positive"), bool)[row_of(starts)]
                for k in (0, 1):
                    counts[k] += np.bincount(found[side == bool(k)], minlength=1 << BITS)
        seen = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[1][seen]), pa.array(counts[0][seen])], ["feature", "p", "u"])

    sizes = sample.groupBy("positive").count().collect()
    n_p, n_u = (max(1, sum(r["count"] for r in sizes if r["positive"] is side)) for side in (True, False))
    counted = sample.select("positive", text).mapInArrow(run, "feature int, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share = (F.col("p") + F.col("u") + 1) / (n_p + n_u + 2)
    error = F.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    clear = F.abs(F.col("p") / n_p - F.col("u") / n_u) >= max(CLEAR, EFFECT * n_p ** 0.5) * error
    # At most as many as texts can have: each is in a share of the confirmed ones.
    return np.array(sorted(r[0] for r in counted.where(clear & (F.col("p") >= max(3, SHARE * n_p))).select("feature").collect()), np.int64)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fits on a bounded sample of the rows for which ``allowed`` (of the id column) holds.

    ``labels``: id and ``toxic`` (1 confirmed). A null or unknown label, or a null id, confirms
    nothing; of several labels of an id one 1 is enough. The class prior is the share of toxic
    among the labelled ids that may be used.
    """
    usable = allowed & F.col(id_col).isNotNull()
    marked = labels.select(F.col(id_col), F.col("toxic")).where(usable & F.col("toxic").isNotNull()).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    share = marked.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    prior = min(max(share or 0.0, 0.001), 0.9)
    order = F.xxhash64(id_col)
    known = marked.where("toxic = 1").orderBy(order, id_col).limit(positives).select(id_col, F.lit(True).alias("positive"))
    # Drawn from all texts, the confirmed ones too: the risk takes it for the whole mixture.
    others = docs.select(id_col).where(usable).distinct().orderBy(order, id_col).limit(unlabelled).select(id_col, F.lit(False).alias("positive"))
    sample = written(docs.select(id_col, text_col).join(F.broadcast(known.unionByName(others)), id_col))  # bounded by the two limits
    kept = telling(sample, text_col)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text_col):
                found, starts = features(rows, text_col)
                at = np.minimum(np.searchsorted(kept, found), max(len(kept) - 1, 0))
                known = kept[at] == found if len(kept) else np.zeros(len(found), bool)
                begins = np.concatenate([[0], np.cumsum(known)])[starts]
                yield pa.RecordBatch.from_arrays([rows.column("positive"), rows.column(id_col).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(at[known], pa.int32()))], ["positive", "id", "found"])

    got = sample.mapInArrow(extract, "positive boolean, id long, found array<int>").toArrow().sort_by([("id", "ascending"), ("positive", "ascending")]).combine_chunks()
    lists = got["found"].combine_chunks()
    sizes = np.array(lists.value_lengths(), np.int64)
    return fit(np.array(lists.flatten(), np.int64), np.concatenate([[0], np.cumsum(sizes)]), np.array(got["positive"], bool), prior, kept)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text as a further column; null counts as empty."""
    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(shared.value.score(rows, text_col), pa.float64())], [*rows.schema.names, name])

    return docs.mapInArrow(run, schema)


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def toxicity(docs: DataFrame, labels: DataFrame, fold: int = 3, held: int = 1) -> DataFrame:
    """Scores of all documents by a model that never sees labels of the held-out fold."""
    model = train(docs, labels, remainder("doc_id", fold) != held)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (remainder("doc_id", fold) == held).alias("held_out"), "score", (F.col("score") >= LEVEL).cast("int").alias("predicted"))
