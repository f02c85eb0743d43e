"""Substring dedup by seed and extend (operator 2).

Seeds are winnowed anchors: of the grams in a 20-word window the one with
the smallest hash (the leftmost of equal ones). Equal windows have the same
anchor, and the windows of one anchor lie side by side, as a run.

1. Anchors that occur twice or more are found by counting hashes alone.
2. Documents are joined on (anchor, whole run), for runs at such anchors
   only. An equal run is a match that extends over all its windows both
   ways, so all but its first occurrence is repeated.
3. Anchors with several different runs, where a match ends inside a run,
   are extended window by window between the first occurrences of the runs.
4. The repeated windows of a document, which overlap or touch within a
   maximal repeat, are cut out as word ranges.

What a step learns (hash, first place) is kept as sorted arrays in the
shared folder, which the next scan of the documents maps and looks into, so
no text is ever shuffled. Every group is summed (first place, count) before
and after its shuffle: a passage that a third of all documents share costs
one row per task and never a list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm import hashstore
from panelflow.llm.common import WORDS, mix, ragged, slices, small_batches, text_bytes, word_hashes, word_spans
from panelflow.session import staging_path

WINDOW, GRAM = 20, 8
SHARD_KEYS = 1 << 17        # anchors a shard is planned for
FLUSH = 1 << 20             # anchors a task holds before it sends them


def _runs(column: pa.Array, window: int, gram: int):
    """(text, first window, windows, anchor hash, run hash) of all runs, the sums that windows are hashed from, and each text's first word."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    sums = WORDS.sums(word_hashes(data, starts, ends))
    n, width = len(starts), window - gram + 1
    if n < window:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64), sums, first
    at = np.arange(n - gram + 1)
    best, where, span = WORDS.spans(sums, at, at + gram), at, 1
    grams = best

    def narrow(best, where, step):
        left = best[:-step] <= best[step:]
        return np.where(left, best[:-step], best[step:]), np.where(left, where[:-step], where[step:])

    while span * 2 <= width:
        best, where = narrow(best, where, span)
        span *= 2
    if span < width:
        best, where = narrow(best, where, width - span)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ok = np.flatnonzero(text[:n - window + 1] == text[window - 1:])
    anchor = where[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (np.diff(anchor) != 0) | (np.diff(ok) != 1)
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(ok)))
    s, a = ok[head], anchor[head]
    run = mix(WORDS.spans(sums, s, s + size - 1 + window) + (a - s).astype(np.uint64))
    return text[s], s, size, grams[a], run, sums, first


def _send_anchors(bits: int, window: int, gram: int):
    def sent(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, count = np.unique(np.concatenate(parts), return_counts=True)
        shard = hashstore.shard_of(keys, bits)
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(keys)]
        pairs = [(i, j) for i, j in zip(cuts, cuts[1:]) if i < j]
        return pa.RecordBatch.from_arrays(
            [pa.array([int(shard[i]) for i, _ in pairs], pa.int64()), pa.array([keys[i:j].tobytes() for i, j in pairs], pa.binary()),
             pa.array([keys[i:j][count[i:j] > 1].tobytes() for i, j in pairs], pa.binary())], ["shard", "keys", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in slices(batches, "text"):
            parts.append(_runs(b.column("text"), window, gram)[3])
            held += len(parts[-1])
            if held > FLUSH:
                yield sent(parts)
                parts, held = [], 0
        if held:
            yield sent(parts)
    return run


def _keep_repeated(uri: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for c in ("keys", "again") for x in table.column(c).to_pylist()]
        keys, count = np.unique(np.concatenate(lists), return_counts=True)
        keys = keys[count > 1]
        hashstore.write(uri, key[0].as_py(), "keys", keys)
        return pa.table({"n": pa.array([len(keys)], pa.int64())})
    return run


def _place(doc_id: np.ndarray, same: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One number for a word of a text."""
    x = mix(doc_id.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + same.astype(np.uint64))
    return mix(x + start.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Scan:
    """The runs of one slice of documents, and what the stores say about them."""

    def __init__(self, b: pa.RecordBatch, bits: int, window: int, gram: int):
        self.window = window
        self.text, self.at, self.size, self.anchor, run, self.sums, self.first = _runs(b.column("text"), window, gram)
        top = np.uint64(((1 << bits) - 1) << (64 - bits))
        self.key = (self.anchor & top) | (run >> np.uint64(bits))          # in the shard of its anchor
        self.doc = pc.fill_null(b.column("doc_id"), 0).to_numpy(zero_copy_only=False)
        self.same = b.column("same").to_numpy(zero_copy_only=False)
        self.known = np.asarray(b.column("doc_id").is_valid())[self.text]     # rows without an id have no place

    def keep(self, rows: np.ndarray) -> None:
        for c in ("text", "at", "size", "anchor", "key", "known"):
            setattr(self, c, getattr(self, c)[rows])

    def place(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        return _place(self.doc[text], self.same[text], at - self.first[text])

    def look_up(self, store: hashstore.Store, keys: np.ndarray, *fields: str) -> list[np.ndarray]:
        """Found or not, and the fields (0 where not found), in the order of ``keys``."""
        keys, back = np.unique(keys, return_inverse=True)
        shard, at = store.find(keys)
        return [(at >= 0)[back], *[store.get(shard, at, f)[back] for f in fields]]

    def windows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, hash) of all windows of some runs."""
        at = ragged(self.at[rows], self.at[rows] + self.size[rows])
        return np.repeat(self.text[rows], self.size[rows]), at, WORDS.spans(self.sums, at, at + self.window)

    def rows(self, names: tuple[str, ...], columns: list[np.ndarray], text: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        columns = [c.view(np.int64) for c in columns] + [self.doc[text], self.same[text], (at - self.first[text]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*names, "doc_id", "same", "start"])


def _seeded_runs(anchors: str, bits: int, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = hashstore.opened(anchors, bits)
        for b in slices(batches, "text"):
            scan = _Scan(b, bits, window, gram)
            scan.keep(scan.look_up(store, scan.anchor)[0])
            yield scan.rows(("key", "anchor"), [scan.key, scan.anchor], scan.text, scan.at)
    return run


def _open_windows(runs: str, bits: int, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = hashstore.opened(runs, bits)
        for b in slices(batches, "text"):
            scan = _Scan(b, bits, window, gram)
            found, place, several = scan.look_up(store, scan.key, "place", "several")
            text, at, hashes = scan.windows(found & (several > 0) & (place == scan.place(scan.text, scan.at)))
            yield scan.rows(("key",), [hashes], text, at)
    return run


def _cut(runs: str, inner: str, bits: int, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, windows = hashstore.opened(runs, bits), hashstore.opened(inner, bits)
        for b in slices(batches, "text"):
            scan = _Scan(b, bits, window, gram)
            scan.keep(scan.known)
            found, place, several = scan.look_up(store, scan.key, "place", "several")
            later = found & (place != scan.place(scan.text, scan.at))
            text, at, hashes = scan.windows(found & ~later & (several > 0))
            hit, place = scan.look_up(windows, hashes, "place")
            hit &= place != scan.place(text, at)
            step = np.zeros(scan.first[-1] + 1, np.int64)
            np.add.at(step, np.concatenate([scan.at[later], at[hit]]), 1)
            np.add.at(step, np.concatenate([(scan.at + scan.size)[later] - 1, at[hit]]) + window, -1)
            gone = np.cumsum(step[:-1]) > 0
            counts, removed, texts = np.diff(scan.first), [], []
            for i, j, t in zip(scan.first.tolist(), scan.first[1:].tolist(), b.column("text").to_pylist()):
                words = (t or "").encode().split()
                out = gone[i:j]
                removed.append(int(out.sum()))
                texts.append(b" ".join([words[k] for k in np.flatnonzero(~out).tolist()] if removed[-1] else words).decode())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                                             ["doc_id", "n_words", "n_removed", "text"])
    return run


def _write_first(uri: str, bits: int, seeds: bool):
    """Writes a shard's keys and first places; of runs also whether their anchor has several."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        col = lambda c: table.column(c).to_numpy()
        keys = col("key").view(np.uint64)
        order = np.argsort(keys)
        keep = np.ones(len(keys), bool)
        if seeds:
            _, back, n = np.unique(col("anchor"), return_inverse=True, return_counts=True)
            several = n[back] > 1
            keep = several | (col("n") > 1)
        order = order[keep[order]]
        shard = key[0].as_py()
        hashstore.write(uri, shard, "keys", keys[order])
        hashstore.write(uri, shard, "place", _place(col("doc_id"), col("same"), col("start"))[order])
        if seeds:
            hashstore.write(uri, shard, "several", several[order].astype(np.uint8))
        return pa.table({"n": pa.array([len(order)], pa.int64())})
    return run


def _store_first(rows: DataFrame, uri: str, bits: int, seeds: bool) -> None:
    firsts = rows.groupBy("key", *(["anchor"] if seeds else [])).agg(F.min(F.struct("doc_id", "same", "start")).alias("at"), F.count("*").alias("n"))
    if not seeds:
        firsts = firsts.where("n > 1")
    (firsts.select("key", *(["anchor"] if seeds else []), "at.*", "n", F.expr(f"shiftrightunsigned(key, {64 - bits})" if bits else "0L").alias("shard"))
     .groupBy("shard").applyInArrow(_write_first(uri, bits, seeds), "n long").agg(F.sum("n")).collect())


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, text) for every row; text holds the kept words, one space between them.

    A word goes if a window of ``window`` words over it also starts earlier:
    in a document of smaller id, or earlier in its own. Null and empty texts
    and texts of fewer words than a window are kept whole. Rows that repeat
    an id are ordered by the hash of their texts; equal rows are the same
    place, so neither removes the other. A row with a null id has no place
    in the order: it is kept whole and removes nothing. Empty input gives no
    rows. Window, run and anchor are compared by 64 bits of hash.
    """
    if not 0 < gram < window:
        raise ValueError("gram must be shorter than window")
    small_batches(docs.sparkSession)
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("same"), docs[text_col].alias("text"))
    placed = slim.where("doc_id is not null and text is not null")
    size = placed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = hashstore.bits_for(size / 40, SHARD_KEYS)
    anchors, runs, inner = (staging_path(docs.sparkSession, n) for n in ("anchors", "runs", "windows"))
    (placed.select("text").mapInArrow(_send_anchors(bits, window, gram), "shard long, keys binary, again binary")
     .groupBy("shard").applyInArrow(_keep_repeated(anchors), "n long").agg(F.sum("n")).collect())
    place = "doc_id long, same long, start int"
    _store_first(placed.mapInArrow(_seeded_runs(anchors, bits, window, gram), f"key long, anchor long, {place}"), runs, bits, True)
    _store_first(placed.mapInArrow(_open_windows(runs, bits, window, gram), f"key long, {place}"), inner, bits, False)
    return slim.mapInArrow(_cut(runs, inner, bits, window, gram), "doc_id long, n_words long, n_removed long, text string")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    return dedup_substrings(docs, id_col, text_col).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
