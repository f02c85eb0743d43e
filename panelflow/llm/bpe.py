"""Byte-level BPE encoding and decoding on padded numpy matrices (operator 8).

Texts are split by the vocabulary's pattern. Different pieces of a slice are
encoded together: pieces of similar length become the rows of one matrix of
token ids. In each round every row merges its leftmost pair of minimum
rank; rows without a pair left leave the matrix (compaction) and the others
lose one column. Pair ranks come from an open-addressing hash table and are
looked up again only beside a merge.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm.common import id_and_text, ragged, slices, small_batches, worker_cache

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NONE = np.int32(2**31 - 1)       # rank of a pair that does not merge
LONG = 2048                      # bytes; longer pieces merge on a heap, in less than quadratic time
CELLS = 1 << 20                  # matrix cells held at once
REMEMBER = 400_000               # pieces whose ids a worker keeps between slices


class PairTable:
    """(left id, right id) -> id of the merged token, by hashing with linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 3))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]           # of several for one slot the last stays
            held = self.keys[at] == keys[left]
            self.values[at[held]] = values[left[held]]
            left, at = left[~held], (at[~held] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape = left.shape
        keys = ((left.astype(np.int64) << 20) | right.astype(np.int64)).ravel()
        out = np.full(len(keys), NONE, np.int32)
        rows, at = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0)), None
        at = self._slot(keys[rows])
        while len(rows):
            found = self.keys[at]
            hit = found == keys[rows]
            out[rows[hit]] = self.values[at[hit]]
            more = ~hit & (found != -1)
            rows, at = rows[more], (at[more] + 1) & (len(self.keys) - 1)
        return out.reshape(shape)


class Codec:
    """Ranks of one vocabulary file, and the pieces encoded so far."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        pairs = {(self.ranks[t[:i]] << 20) | self.ranks[t[i:]]: r for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks}
        self.pairs = PairTable(np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for t, r in self.ranks.items():
            tokens[r] = t
        self.token_at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.id_at, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64), 0

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pieces not met before, appended to the store."""
        raw = [p.encode() for p in pieces]
        out: list = [None] * len(raw)
        todo = []
        for i, b in enumerate(raw):
            whole = self.ranks.get(b)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif len(b) > LONG:
                out[i] = self._heap(b)
            else:
                todo.append(i)
        todo.sort(key=lambda i: len(raw[i]))
        start = 0
        while start < len(todo):
            stop, longest = start + 1, 1 << max(3, (len(raw[todo[start]]) - 1).bit_length())
            while stop < len(todo) and len(raw[todo[stop]]) <= longest and (stop - start + 1) * longest <= CELLS:
                stop += 1
            self._matrix([raw[i] for i in todo[start:stop]], todo[start:stop], out)
            start = stop
        counts = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.concatenate(out)
        n, m = len(self.known), len(out)
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used + 2 * len(flat), np.int32)])
        if n + m + 1 > len(self.id_at):
            self.id_at = np.concatenate([self.id_at[:n + 1], np.zeros(n + 2 * m + 1, np.int64)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.id_at[n + 1:n + m + 1] = self.used + np.cumsum(counts)
        self.used += len(flat)
        self.known.update(zip(pieces, range(n, n + m)))

    def _matrix(self, raw: list[bytes], where: list[int], out: list) -> None:
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        width = int(size.max())
        ids = np.full((len(raw), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        rank, row = self.pairs(ids[:, :-1], ids[:, 1:]), np.array(where)
        while True:
            n, width = ids.shape
            at = rank.argmin(axis=1) if width > 1 else np.zeros(n, np.int64)       # the leftmost of equal ranks
            best = rank[np.arange(n), at] if width > 1 else np.full(n, NONE)
            done = best == NONE
            for k in np.flatnonzero(done):
                r = ids[k]
                out[row[k]] = r[r >= 0]
            if done.all():
                return
            go = ~done
            ids, rank, row, at, best = ids[go], rank[go], row[go], at[go], best[go]
            n, r = len(row), np.arange(len(row))
            ids[r, at] = best
            gone = np.ones(ids.shape, bool)
            gone[r, at + 1] = False
            ids = ids[gone].reshape(n, width - 1)
            gone = np.ones(rank.shape, bool)
            gone[r, at] = False
            rank = rank[gone].reshape(n, width - 2)
            for side in (at - 1, at):
                k = np.flatnonzero((side >= 0) & (side < width - 2))
                rank[k, side[k]] = self.pairs(ids[k, side[k]], ids[k, side[k] + 1])

    def _heap(self, b: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of pairs over a linked list."""
        merge = {}

        def pair(x: int, y: int) -> int | None:
            if (x, y) not in merge:
                r = int(self.pairs(np.array([x]), np.array([y]))[0])
                merge[x, y] = None if r == NONE else r
            return merge[x, y]

        ids, nxt, prv = self.byte[np.frombuffer(b, np.uint8)].tolist(), list(range(1, len(b) + 1)), list(range(-1, len(b) - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(b) - 1) if (r := pair(ids[i], ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = nxt[i] if ids[i] == x else len(b)
            if j >= len(b) or ids[j] != y:
                continue
            ids[i], ids[j], nxt[i] = r, -1, nxt[j]
            if nxt[i] < len(b):
                prv[nxt[i]] = i
            for k in (prv[i], i):
                if k >= 0 and nxt[k] < len(b) and (r := pair(ids[k], ids[nxt[k]])) is not None:
                    heapq.heappush(heap, (r, k, ids[k], ids[nxt[k]]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        found = [self.pattern.findall(t) for t in texts]
        if len(self.known) > REMEMBER:
            self.forget()
        new = list(dict.fromkeys(p for f in found for p in f if p not in self.known))
        if new:
            self._learn(new)
        out = []
        for f in found:
            which = np.fromiter(map(self.known.__getitem__, f), np.int64, len(f))
            out.append(self.ids[ragged(self.id_at[which], self.id_at[which + 1])])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[ragged(self.token_at[ids], self.token_at[ids + 1])].tobytes()


def codec(path: str, pattern: str) -> Codec:
    kept = worker_cache()
    if (path, pattern) not in kept:
        kept[path, pattern] = Codec(path, pattern)
    return kept[path, pattern]


def _encoding(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in slices(batches, "text"):
            ids = own.encode([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                ["doc_id", "n_tokens", "ids"])
    return run


def _decoding(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in slices(batches, "ids", 8 << 20):
            out = [own.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "decoded"])
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, n_tokens long, ids binary: little-endian unsigned 32-bit) for every row.

    A null or empty text has no ids. Special tokens are ordinary text. A
    text of any length is one row; repeated rows each come back. ``path``
    names the vocabulary file, present on every machine with the library
    that ships it (default: the multilingual byte-level one).
    """
    path = path or public_tokenizers.path(VOCABULARY)
    small_batches(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).mapInArrow(_encoding(path, pattern), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``encode``'s rows with ``decoded`` binary, the bytes the ids stand for (null ids: none)."""
    path = path or public_tokenizers.path(VOCABULARY)
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(_decoding(path, pattern), "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encoded and decoded again: doc_id, n_tokens, ids, and digests of the ids and of the decoded bytes.

    Both steps run in one Python worker, which holds the vocabulary once.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    small_batches(docs.sparkSession)
    encoding, decoding = _encoding(path, public_tokenizers.PATTERN), _decoding(path, public_tokenizers.PATTERN)
    both = id_and_text(docs, id_col, text_col).mapInArrow(lambda batches: decoding(encoding(batches)), "doc_id long, n_tokens long, ids binary, decoded binary")
    return both.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
