"""SimHash near-duplicates by multi-index hashing (operator 10).

A fingerprint is cut into two 32-bit segments. Each fingerprint enumerates
the Hamming ball of radius 1 inside either segment, with the other segment
unchanged, as keys of one table. Two fingerprints at distance 2 or less
share a key: the point between them. A key is reached by at most 65
different fingerprints whatever the data, so no bucket needs a cap or a
salt and no group's pairs are listed; members are kept as a bit set, linked
to the smallest one, and the complete distance of every link is verified.

Rows with equal fingerprints are one class before any search.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelflow.llm.common import fresh, id_and_text, lower, slices, small_batches, text_bytes, word_spans
from panelflow.llm.components import connected_components

SHINGLE, DISTANCE, SEED = 3, 2, 42


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for b in slices(batches, "text", 1 << 20):
            data, offsets = text_bytes(b.column("text"))
            data = lower(data)
            starts, ends, first = word_spans(data, offsets)
            # words end to end with one space after each: word i starts at at[i]
            at = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(ends - starts + 1, out=at[1:])
            joined = b" ".join(chain.from_iterable(data[i:j].tobytes().split() for i, j in pairwise(offsets)))
            count = np.diff(first)
            shingles = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
            lead = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(shingles)[:-1]]), shingles) + np.arange(shingles.sum())
            last = np.minimum(lead + n, np.repeat(first[1:], shingles))
            hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(at[lead].tolist(), (at[last] - 1).tolist())), np.uint64, len(lead))
            out = np.zeros(len(count), np.uint64)
            some = np.flatnonzero(shingles)
            if len(some):
                bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                cut = np.concatenate([[0], np.cumsum(shingles[some])[:-1]])
                ones = np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
                major = (2 * ones > shingles[some][:, None]).astype(np.uint8)
                out[some] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
            more = [c for c in b.schema.names if c not in ("doc_id", "text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out.view(np.int64)), *map(b.column, more)], ["doc_id", "fp", *more])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) for every row; a text without words has fingerprint 0."""
    small_batches(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): every fingerprint of ``distinct(fp)`` tied to the smallest one it shares a key with."""
    if distance not in (0, 1, 2):
        raise ValueError("distance must be 0, 1 or 2: segments enumerate balls of radius 1")
    flips = F.sequence(F.lit(0), F.lit(64 if distance else 0))
    bit = lambda i: F.when(i < 64, F.expr("shiftleft(1L, i)")).otherwise(F.lit(0).cast("long"))
    keys = (distinct.select("fp", F.explode(flips).alias("i"))
            .select(F.col("fp").bitwiseXOR(bit(F.col("i"))).alias("key"), bit(F.col("i")).alias("flip")))
    table = (keys.groupBy("key").agg(F.bit_or("flip").alias("flips"), F.max(F.col("flip") == 0).alias("itself"))
             .where(F.bit_count("flips") + F.col("itself").cast("int") > 1))
    if distance == 1:
        table = table.where("itself")
    members = F.expr("concat(if(itself, array(key), cast(array() as array<bigint>)), "
                     "transform(filter(sequence(0, 63), i -> getbit(flips, i) = 1), i -> key ^ shiftleft(1L, i)))")
    pairs = (table.select((F.col("key") if distance == 1 else F.array_min(members)).alias("a"), F.explode(members).alias("b")))
    return pairs.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint hex, component_id) for every row.

    component_id is the smallest doc_id reachable over links of ``distance``
    bits or fewer. Empty or null texts share fingerprint 0 and are linked
    like any other. A null doc_id never names a component unless the
    component has no other id. Repeated rows each come back. Empty input
    gives no rows.
    """
    prints = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    # written, so that the join below reads two plain exchanges and AQE can split a fingerprint with many copies
    named = _named(prints, distance).select("fp", "component_id").checkpoint()
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, component_id, root) for every fingerprint; only the root tells apart components that share an id."""
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    roots = connected_components(links(least.select("fp"), distance))
    grouped = least.join(roots, least["fp"] == roots["node"]).select("fp", "first", "root")
    lowest = grouped.groupBy("root").agg(F.min("first").alias("low"))
    moved = grouped.join(lowest, "root").select("fp", "low", "root")
    return least.join(moved, "fp", "left").select("fp", F.coalesce("low", "first").alias("component_id"), F.coalesce("root", "fp").alias("root"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each component: the one whose id names it.

    All columns are kept, whatever their names. Rows that repeat an id are
    told apart by the hash of their text; of those in one component that have
    its id one stays (the one whose text sorts first). Rows with a null id
    stay, as nothing tells them apart from documents still to be numbered.
    """
    small_batches(docs.sparkSession)
    prints = (id_and_text(docs, id_col, text_col).withColumn("same", F.xxhash64("text"))
              .mapInArrow(_fingerprints(shingle), "doc_id long, fp long, same long").checkpoint())
    named = _named(prints, distance).checkpoint()
    key, text_key, root, copies, order = (fresh(c, docs.columns) for c in ("keep_id", "keep_text", "keep_root", "keep_copies", "keep_nth"))
    chosen = (prints.join(named, "fp").where("doc_id = component_id")
              .withColumn("copies", F.count("*").over(Window.partitionBy("doc_id")))
              .groupBy(F.col("doc_id").alias(key), F.col("same").alias(text_key)).agg(F.min("root").alias(root), F.max("copies").alias(copies)))
    kept = docs.join(chosen, (docs[id_col].cast("long") == chosen[key]) & (F.xxhash64(docs[text_col]) == chosen[text_key]), "inner")
    single = kept.where(F.col(copies) == 1).drop(key, text_key, root, copies)
    once = (kept.where(F.col(copies) > 1).withColumn(order, F.row_number().over(Window.partitionBy(root).orderBy(F.col(text_col))))
            .where(F.col(order) == 1).drop(order, key, text_key, root, copies))
    return single.unionByName(once).unionByName(docs.where(docs[id_col].isNull()))
