"""Bigram language model with interpolated modified Kneser-Ney smoothing (operator 7).

Counting, in Spark:

1. Words: every task sums the hashes of its words and sends one packed blob
   per shard; a shard's blobs are merged into sorted hashes with counts.
   A word's id is its place in all shards.
2. Word pairs, as pairs of ids, in the same way; shards follow the first
   word, but for the few words with a large share of all tokens, whose pairs
   are spread by both words.
3. From each shard of pairs, how often a word continues different words and
   how many words follow it once, twice or more, again summed by shard.

All of it lies in the shared folder as sorted arrays (hashes or ids, and
counts), which workers map to score texts; no part of the model passes
through the driver but its totals and a list of the largest words.

p(w|h) = (c(hw) - D) / c(h) + g(h) p'(w), with D by count (1, 2, 3 and more)
and p' the same over the number of different words before w, interpolated
with the uniform distribution over all words, the end and one unknown word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm import hashstore
from panelflow.llm.common import id_and_text, in_fold, lower, mix, slices, small_batches, text_bytes, word_hashes, word_spans
from panelflow.session import staging_path

FOLDS, HELD_OUT = 7, 2
FLUSH = 3 << 20              # keys a task holds before it sends them
WORDS_PER_SHARD, PAIRS_PER_SHARD = 1 << 18, 1 << 20
LARGE = 16                   # a word with this share of its shard may be spread

_BLOB = "shard long, keys binary, counts binary, size long"


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers of 8 bytes, byte planes apart, compressed."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, size: int) -> np.ndarray:
    raw = pa.decompress(data, size * 8, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, size).T).view(np.uint64).ravel()


def _blobs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """One row per shard: its keys (ascending, as differences) and their counts."""
    order = np.lexsort((keys, shard))
    keys, counts, shard = keys[order], counts[order].astype(np.uint64), shard[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]).tolist() if len(shard) else [0]
    parts = list(zip(cuts, cuts[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array([int(shard[i]) for i, _ in parts], pa.int64()),
         pa.array([_pack(np.diff(keys[i:j], prepend=np.uint64(0))) for i, j in parts], pa.binary()),
         pa.array([_pack(counts[i:j]) for i, j in parts], pa.binary()), pa.array([j - i for i, j in parts], pa.int64())],
        ["shard", "keys", "counts", "size"])


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and summed counts of a shard's blobs."""
    size = table.column("size").to_pylist()
    keys = np.concatenate([np.cumsum(_unpack(k, n), dtype=np.uint64) for k, n in zip(table.column("keys").to_pylist(), size)])
    counts = np.concatenate([_unpack(c, n) for c, n in zip(table.column("counts").to_pylist(), size)])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], np.add.reduceat(counts, head)


def _counting(keys_of: Callable[[pa.RecordBatch], np.ndarray], shard_of: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in slices(batches, "text"):
            parts.append(keys_of(b))
            held += len(parts[-1])
            if held > FLUSH:
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield _blobs(keys, counts, shard_of(keys))
                parts, held = [], 0
        if held:
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield _blobs(keys, counts, shard_of(keys))
    return run


def _small(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a batch of texts, and each text's first word."""
    data, offsets = text_bytes(b.column("text"))
    data = lower(data)
    starts, ends, first = word_spans(data, offsets)
    return word_hashes(data, starts, ends), first


class Model:
    """Where the arrays lie, and the totals; small enough to go with every task."""

    def __init__(self, uri: str, word_bits: int, pair_bits: int):
        self.uri, self.word_bits, self.pair_bits = uri, word_bits, pair_bits
        self.offsets = np.zeros((1 << word_bits) + 1, np.int64)      # first id of each shard of words
        self.large = np.zeros(0, np.int64)
        self.n_docs = self.n_tokens = self.n_types = self.n_pairs = 0
        self.discounts = self.lower_discounts = np.zeros(4)
        self.lower_rest = 1.0            # what the lower order leaves to the uniform distribution

    @property
    def end(self) -> int:
        return int(self.offsets[-1])

    @property
    def begin(self) -> int:
        return self.end + 1

    def _words(self) -> hashstore.Store:
        return hashstore.opened(f"{self.uri}/words", self.word_bits)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of words, -1 where unknown."""
        keys, back = np.unique(hashes, return_inverse=True)
        shard, at = self._words().find(keys)
        return np.where(at >= 0, self.offsets[shard] + at, -1)[back]

    def of(self, ids: np.ndarray, *fields: str) -> list[np.ndarray]:
        """Fields of ids (-1: 0), by sorted access; the end and the begin lie in a shard of their own."""
        keys, back = np.unique(ids, return_inverse=True)
        shard = np.searchsorted(self.offsets, keys, "right") - 1
        shard = np.where(keys >= self.end, 1 << self.word_bits, np.maximum(shard, 0))
        at = np.where(keys < 0, -1, keys - np.where(keys >= self.end, self.end, self.offsets[np.minimum(shard, (1 << self.word_bits) - 1)]))
        return [self._words().get(shard, at, f)[back] for f in fields]

    def pair_shard(self, pairs: np.ndarray) -> np.ndarray:
        first = pairs >> np.uint64(32)
        return hashstore.shard_of(np.where(np.isin(first, self.large.astype(np.uint64)), mix(pairs), mix(first)), self.pair_bits)

    def sequences(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every token (word or end) of the texts: its id, the id before it, and its text."""
        n = len(first) - 1
        here = np.arange(len(ids) + n)
        ends = first[1:] + np.arange(n)
        word = np.ones(len(here), bool)
        word[ends] = False
        token = np.full(len(here), self.end, np.int64)
        token[word] = ids
        before = np.concatenate([[self.begin], token[:-1]])
        before[np.concatenate([[0], ends[:-1] + 1])] = self.begin
        return token, before, np.repeat(np.arange(n), np.diff(first) + 1)

    def score(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score, score."""
        n = len(first) - 1
        token, before, text = self.sequences(self.ids(hashes), first)
        count, continues = self.of(token, "counts", "continues")
        c_before, n1, n2, n3 = self.of(before, "counts", "once", "twice", "more")
        pairs = (np.maximum(before, 0).astype(np.uint64) << np.uint64(32)) | np.maximum(token, 0).astype(np.uint64)
        keys, back = np.unique(pairs, return_inverse=True)
        shard = self.pair_shard(keys)
        order = np.argsort(shard, kind="stable")
        store = hashstore.opened(f"{self.uri}/pairs", self.pair_bits)
        seen = np.zeros(len(keys), np.float64)
        where, at = store.find(keys[order], shard[order])
        seen[order] = store.get(where, at, "counts")
        seen = np.where((token >= 0) & (before >= 0), seen[back], 0.0)
        continues, c_before = continues.astype(np.float64), c_before.astype(np.float64)
        d, low = self.discounts, self.lower_discounts
        share = np.maximum(continues - low[np.minimum(continues, 3).astype(int)], 0) / max(self.n_pairs, 1)
        p = share + self.lower_rest / (self.n_types + 1)
        rest = d[1] * n1 + d[2] * n2 + d[3] * n3
        known = c_before > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(known, np.maximum(seen - d[np.minimum(seen, 3).astype(int)], 0) / c_before + rest / c_before * p, p)
        base = np.log10((count.astype(np.float64) + 1) / (self.n_tokens + self.n_types + 1))
        return (np.bincount(text, minlength=n), np.bincount(text, count > 0, n).astype(np.int64),
                np.bincount(text, base, n), np.bincount(text, np.log10(p), n))


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts (0, D1, D2, D3) from how many things were counted 1 to 4 times.

    Where a count is missing, as in tiny corpora, the discount is half the count it is taken from.
    """
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return np.array([0.0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), k) if n[k - 1] and n[k] else k / 2 for k in (1, 2, 3)])


def _write_words(uri: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = _merged(table)
        shard = key[0].as_py()
        hashstore.write(uri, shard, "keys", keys)
        hashstore.write(uri, shard, "counts", _small(counts))
        big = np.flatnonzero(counts * np.uint64(LARGE) >= counts.sum())
        return pa.table({"shard": pa.array([shard], pa.int64()), "types": pa.array([len(keys)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64()),
                         "at": pa.array([big.tolist()], pa.list_(pa.int64())), "n": pa.array([counts[big].astype(np.int64).tolist()], pa.list_(pa.int64()))})
    return run


def _write_pairs(model: Model):
    """Writes a shard of pairs; sends on, by shard of words, each word's part in it, and one row of totals (shard -1)."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = _merged(table)
        shard = key[0].as_py()
        hashstore.write(f"{model.uri}/pairs", shard, "keys", keys)
        hashstore.write(f"{model.uri}/pairs", shard, "counts", _small(counts))
        out = []
        for kind, (ids, some) in enumerate([(keys & np.uint64(0xFFFFFFFF), counts > 0), (keys >> np.uint64(32), counts == 1),
                                            (keys >> np.uint64(32), counts == 2), (keys >> np.uint64(32), counts > 2)]):
            ids, n = np.unique(ids[some], return_counts=True)
            to = np.minimum(np.searchsorted(model.offsets, ids.astype(np.int64), "right") - 1, (1 << model.word_bits) - 1)
            batch = _blobs(ids, n, np.where(ids >= model.end, 1 << model.word_bits, to))
            out.append(pa.table([*batch.columns, pa.array([kind] * batch.num_rows, pa.int64())], names=[*batch.schema.names, "kind"]))
        totals = np.array([len(keys), *[(counts == k).sum() for k in (1, 2, 3, 4)]], np.uint64)
        out.append(pa.table([pa.array([-1], pa.int64()), pa.array([_pack(totals)], pa.binary()), pa.array([b""], pa.binary()),
                             pa.array([5], pa.int64()), pa.array([-1], pa.int64())], names=out[0].schema.names))
        return pa.concat_tables(out)
    return run


_FIELDS = ("continues", "once", "twice", "more")


def _write_followers(model: Model):
    """Writes, beside a shard of words, in how many ways each word continues and is followed."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        special = shard == 1 << model.word_bits
        base = model.end if special else int(model.offsets[shard])
        size = 2 if special else int(model.offsets[shard + 1]) - base
        kinds = table.column("kind").to_numpy()
        totals = np.zeros(4, np.int64)
        for kind, field in enumerate(_FIELDS):
            values, rows = np.zeros(size, np.uint64), np.flatnonzero(kinds == kind)
            if len(rows):
                ids, n = _merged(table.take(pa.array(rows)))
                values[ids.astype(np.int64) - base] = n
            hashstore.write(f"{model.uri}/words", shard, field, _small(values))
            if kind == 0:
                totals = np.array([(values == k).sum() for k in (1, 2, 3, 4)])
        return pa.table({f"n{k}": pa.array([int(totals[k - 1])], pa.int64()) for k in (1, 2, 3, 4)})
    return run


def fit(docs: DataFrame) -> Model:
    """Counts the texts of ``docs(text)``; null texts are empty ones."""
    spark = docs.sparkSession
    small_batches(spark)
    size, n_docs = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    model = Model(staging_path(spark, "lm"), hashstore.bits_for((size or 0) / 120, WORDS_PER_SHARD), hashstore.bits_for((size or 0) / 9, PAIRS_PER_SHARD))
    model.n_docs, bits, words = n_docs, model.word_bits, f"{model.uri}/words"
    shards = (docs.mapInArrow(_counting(lambda b: tokens(b)[0], lambda k: hashstore.shard_of(k, bits)), _BLOB)
              .groupBy("shard").applyInArrow(_write_words(words), "shard long, types long, total long, at array<long>, n array<long>").collect())
    types, total = np.zeros(1 << bits, np.int64), sum(r.total for r in shards)
    for r in shards:
        types[r.shard] = r.types
    model.offsets = np.concatenate([[0], np.cumsum(types)])
    model.n_tokens = total + n_docs
    model.n_types = model.end + (n_docs > 0)
    spread = model.n_tokens >> (model.pair_bits + 2)
    model.large = np.array([model.offsets[r.shard] + a for r in shards for a, n in zip(r.at, r.n) if n > spread] + [model.begin] * (n_docs > spread), np.int64)
    hashstore.write(words, 1 << bits, "counts", np.array([n_docs, n_docs], np.uint64))
    for f in _FIELDS:
        hashstore.write(words, 1 << bits, f, np.zeros(2, np.uint8))

    def pairs_of(b: pa.RecordBatch) -> np.ndarray:
        hashes, first = tokens(b)
        token, before, _ = model.sequences(model.ids(hashes), first)
        return (before.astype(np.uint64) << np.uint64(32)) | token.astype(np.uint64)

    path = staging_path(spark, "lm-followers")
    (docs.mapInArrow(_counting(pairs_of, model.pair_shard), _BLOB).groupBy("shard")
     .applyInArrow(_write_pairs(model), f"{_BLOB}, kind long").write.parquet(path))
    parts = spark.read.schema(f"{_BLOB}, kind long").parquet(path)
    sums = np.zeros(5, np.int64)
    for r in parts.where("kind = -1").select("keys").toLocalIterator():
        sums += _unpack(bytes(r.keys), 5).astype(np.int64)
    model.n_pairs, model.discounts = int(sums[0]), discounts(sums[1:].tolist())
    low = parts.where("kind >= 0").groupBy("shard").applyInArrow(_write_followers(model), "n1 long, n2 long, n3 long, n4 long") \
        .agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in (1, 2, 3, 4)]).first()
    model.lower_discounts = discounts(list(low))
    d, types_seen = model.lower_discounts, model.n_types
    taken = d[1] * low[0] + d[2] * low[1] + d[3] * (types_seen - low[0] - low[1])
    model.lower_rest = taken / model.n_pairs if model.n_pairs else 1.0
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            n, known, base, score = model.score(*tokens(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(known), pa.array(base), pa.array(score)],
                                             ["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) for every row; a null or empty text is its end alone."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_score(model), "doc_id long, n_tokens long, n_known long, base_score double, score double")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, scored by the model of the documents that are not held out.

    A null id is not held out. Repeated rows are counted and scored each. An
    empty table gives no rows; with nothing to learn from, every token has
    probability 1 over the one unknown type.
    """
    slim = id_and_text(docs, id_col, text_col)
    held_out = in_fold(F.col("doc_id"), FOLDS, HELD_OUT)
    model = fit(slim.where(~held_out).select("text"))
    return score(slim, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                                     F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
