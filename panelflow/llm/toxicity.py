"""Toxicity: FTRL-proximal logistic regression on hashed word n-grams (operator 3).

Features are hashed words, pairs of neighbours and pairs with one word
between them (skip-grams), each counted once per text. FTRL-proximal gives
every coordinate its own learning rate and, by its L1 term, leaves most
weights at exactly zero, so the model that is broadcast is a short sorted
list. Training takes at most SAMPLE labelled rows (those whose hashed ids
are smallest) in one task, whose size that bound fixes; their features wait
in a temporary file, so that the task holds one slice of texts and the model.
Positive rows, the rarer ones, weigh POSITIVE times as much.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm.common import fresh, in_fold, lower, slices, small_batches, text_bytes, word_hashes, word_spans

BITS = 20                        # weights are looked up by the low bits of a feature's hash
SAMPLE, EPOCHS, POSITIVE = 24_000, 3, 2.0
ALPHA, BETA, L1, L2 = 4.0, 1.0, 8.0, 1.0
FOLDS = 5
LEARN_BYTES = 1 << 18            # text bytes of a slice in the one training task

_APART = np.zeros(256, bool)     # ASCII that is neither letter nor digit separates words
_APART[[c for c in range(128) if not chr(c).isalnum()]] = True


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text number) of all words, neighbours and skip-grams, repeats included."""
    data, offsets = text_bytes(column)
    data = lower(data)
    starts, ends, first = word_spans(data, offsets, _APART)
    h = word_hashes(data, starts, ends)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out, where = [h], [text]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        same = text[:-gap] == text[gap:] if len(h) > gap else np.zeros(0, bool)
        pair = (h[:-gap] * np.uint64(salt) ^ (h[gap:] >> np.uint64(7))) * np.uint64(0xD6E8FEB86659FD93) if len(h) > gap else h[:0]
        out.append(pair[same] ^ (pair[same] >> np.uint64(32)))
        where.append(text[gap:][same] if len(h) > gap else text[:0])
    return (np.concatenate(out) & np.uint64((1 << bits) - 1)).astype(np.int64), np.concatenate(where)


class Ftrl:
    """FTRL-proximal state; coordinate 2**BITS is the bias, free of L1."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.l1 = np.full(size + 1, l1)
        self.l1[size] = 0.0

    def weights(self, at) -> np.ndarray:
        z, l1 = self.z[at], self.l1[at]
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        g *= POSITIVE if label else 1.0
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, labels, ends = Ftrl(1 << BITS, ALPHA, BETA, L1, L2), [], [0]
    with tempfile.TemporaryFile() as kept:
        for b in slices(batches, "text", LEARN_BYTES):
            f, where = features(b.column("text"))
            pairs = np.unique(where << 32 | f)
            kept.write((pairs & 0xFFFFFFFF).astype(np.int32).tobytes())
            ends += (ends[-1] + np.searchsorted(pairs >> 32, np.arange(1, b.num_rows + 1))).tolist()
            labels += b.column("toxic").to_pylist()
        kept.flush()
        f = np.asarray(np.memmap(kept, np.int32, "r")) if ends[-1] else np.zeros(0, np.int32)
        rng = np.random.default_rng(7)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(labels)):
                model.learn(np.append(f[ends[i]:ends[i + 1]], np.int32(1 << BITS)), labels[i])
    w = model.weights(slice(None))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["at", "weight"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Positions (ascending; the last may be the bias) and weights, learnt from rows out of the held-out fold."""
    small_batches(docs.sparkSession)
    marks = (labels.select(labels["doc_id"].alias("id"), labels["toxic"].cast("int").alias("toxic"))
             .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold(F.col("id"), FOLDS, 0))
             .groupBy("id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("id"), "id").limit(SAMPLE))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(marks), "id")
    learnt = rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "text").mapInArrow(_train, "at long, weight double").collect()
    return np.array([r.at for r in learnt], np.int64), np.array([r.weight for r in learnt])


def _score(model, out: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = model.value
        full = np.zeros((1 << BITS) + 1)
        full[at] = w
        some = full != 0
        for b in slices(batches, text_col):
            f, where = features(b.column(text_col))
            used = some[f]
            pairs = np.unique(where[used] << 32 | f[used])
            total = np.bincount(pairs >> 32, full[pairs & 0xFFFFFFFF], b.num_rows) + full[1 << BITS]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], [*b.schema.names, out])
    return run


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a score column (0 to 1), and that column's name, which avoids those of ``docs``.

    Only the text enters a score: null and empty texts get the model's bias.
    Labels that are null or neither 0 nor 1 teach nothing; of a document's
    several labels the largest counts. Without usable labels every score is
    0.5. Repeated rows each come back; an empty table stays empty.
    """
    out = fresh("score", docs.columns)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_score(model, out, text_col), f"{schema}{', ' if schema else ''}`{out}` double"), out


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored, out = score(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), labels)
    return scored.select("doc_id", in_fold(F.col("doc_id"), FOLDS, 0).alias("held_out"), F.col(out).alias("score"),
                         (F.col(out) >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more; all columns kept."""
    scored, out = score(docs, labels, id_col, text_col)
    return scored.where(F.col(out) < 0.5).drop(out)
