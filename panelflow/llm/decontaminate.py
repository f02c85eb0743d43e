"""Benchmark decontamination by Aho-Corasick (operator 4).

Items are cut into windows of ten normalised words. The windows of a block
of items form one automaton, which scans each normalised text once; word
numbers lead from matches back to the original text. A block holds at most
BLOCK_BYTES of item text, so what is broadcast is bounded whatever the size
of the benchmark; a larger benchmark is more blocks, scanned one after the
other over all rows, with the rows' hits carried along.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm.common import fresh, slices, small_batches, worker_cache
from panelflow.session import shared_dir

WINDOW = 10
BLOCK_BYTES = 1 << 20
# words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: fixed by the contract
_PLAIN = bytes(32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c
               for c in bytes(range(256)).lower())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


class _Matcher:
    """Automaton over the numbered words of a block's (item id, text) windows."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[i:i + window]), set()).add(item)
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, who in owners.items():
            self.found.add_word(key, (len(key), sorted(who)))
        if owners:
            self.found.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[int], list[str]]:
        """Numbers of the words inside a match, and the items met."""
        if not self.numbers or not words:
            return [], []
        met = list(self.found.iter(tuple(map(self.numbers.get, words, repeat(0)))))
        if not met:
            return [], []
        step = np.zeros(len(words) + 1, np.int64)
        end, size = np.array([e + 1 for e, _ in met]), np.array([n for _, (n, _) in met])
        np.add.at(step, end - size, 1)
        np.add.at(step, end, -1)
        return np.flatnonzero(np.cumsum(step)).tolist(), sorted({i for _, (_, s) in met for i in s})


def _scan(block, window: int, text_col: str, added: tuple[str, str, str]):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache()
        if kept.get("matcher", ("",))[0] != name:
            kept["matcher"] = name, _Matcher(block.value, window)
        matcher = kept["matcher"][1]
        for b in slices(batches, text_col):
            at = [b.schema.names.index(c) for c in added]
            words, hits, items = (b.column(i).to_pylist() for i in at)
            for row, text in enumerate(b.column(text_col).to_pylist()):
                own = words_of(text)
                words[row] = len(own)
                now, who = matcher.scan(own)
                if now:
                    hits[row], items[row] = sorted({*now, *hits[row]}), sorted({*who, *items[row]})
            cols = list(b.columns)
            for i, new in zip(at, (words, hits, items)):
                cols[i] = pa.array(new, b.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)
    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in blocks of bounded bytes, one block on the driver at a time."""
    rows = benchmark.select(benchmark[item_col].cast("string").alias("i"), benchmark[text_col].alias("t")).where("i is not null and t is not null")
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and size + len(r.t) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((r.i, r.t))
        size += len(r.t)
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, tuple[str, str, str]]:
    """``docs`` with three more columns, and those columns' names.

    They hold the number of words; the numbers (from 0) of the words inside
    a match, ascending; and the ids of the items met, sorted as strings.
    Null texts and texts without words have none, as does everything if no
    item has a word. Items with a null id or text are left out; items that
    share an id are one item; an item shorter than the window is one window.
    Repeated rows each come back; an empty table stays empty.
    """
    spark = docs.sparkSession
    small_batches(spark)
    taken = list(docs.columns)
    added = tuple(taken.append(fresh(c, taken)) or taken[-1] for c in ("n_words", "hits", "items"))
    for name, kind in zip(added, ("bigint", "array<int>", "array<string>")):
        docs = docs.withColumn(name, F.lit(0).cast(kind) if kind == "bigint" else F.array().cast(kind))
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    first = True
    for block in _blocks(benchmark, item_col, item_text_col):
        if not first:                       # cut the chain, so that one matcher is in memory at a time
            shared_dir(spark)
            docs = docs.checkpoint()
        docs = docs.mapInArrow(_scan(spark.sparkContext.broadcast(block), window, text_col, added), schema)
        first = False
    return docs, added


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    found, (words, hits, items) = contamination(slim, benchmark, "text", **more)
    return found.select(
        "doc_id", F.col(words).alias("n_words"), F.size(hits).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (F.size(hits) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **more) -> DataFrame:
    """``docs`` without the rows that hold a window of an item; all columns kept."""
    found, added = contamination(docs, benchmark, text_col, **more)
    return found.where(F.size(added[1]) == 0).drop(*added)
