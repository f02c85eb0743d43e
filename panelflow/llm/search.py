"""Ranked lexical search over a length-stratified index (operator 12).

Documents with the same length normaliser m form a stratum. A row of the
index is one slice of a stratum: its documents, and per term the postings
grouped by term frequency. Within a stratum an impact depends on nothing but
(term, frequency), so it is computed once for each such group, and the
highest frequency of each term gives a bound on any score in the slice.

A search reads the index twice: once for the terms' document frequencies,
once for the scores. There a task orders its slices by their bounds, visits
them with the queries that can still gain from them, and skips a slice for a
query whose ten best it cannot reach. Tasks hand on ten rows a query at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelflow.llm.common import id_and_text, lower, ragged, slices, small_batches, text_bytes, word_hashes, word_spans
from panelflow.session import staging_path

BEST = 10
SLICE_TERMS = 100_000           # terms a slice of a stratum holds, about
DOC_WEIGHT = 100                # a document counts as so many terms more, which bounds a slice's documents too
BATCH_BYTES = 32 << 20
ITEM_BYTES = 1 << 20            # query text searched for at once; a longer item is a block of its own
NO_ID = np.iinfo(np.int64).max  # stands for a null id, after all others

# terms are [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ with A-Z lower-cased: fixed by the contract
_BREAK = np.zeros(256, bool)
_BREAK[[c for c in range(128) if not chr(c).isalnum()]] = True

_INDEX = ("m long, slice long, docs array<long>, terms array<long>, term_at array<int>, tfs array<int>, tf_at array<int>, postings array<int>")


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all terms, index of each text's first term and the end)."""
    data, offsets = text_bytes(column)
    data = lower(data)
    starts, ends, first = word_spans(data, offsets, _BREAK)
    return word_hashes(data, starts, ends).view(np.int64), first


def _with_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        data, offsets = text_bytes(b.column("text"))
        n = np.diff(word_spans(lower(data), offsets, _BREAK)[2])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n.astype(np.int64))], [*b.schema.names, "n"])


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _with_length(batches):
        n, times = np.unique(b.column("n").to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(times)], ["n", "docs"])


def _slice_row(key: tuple, t: pa.Table) -> pa.Table:
    """One slice of a stratum: documents by id, postings by (term, tf, document)."""
    t = t.combine_chunks()
    ids = t.column("doc_id").fill_null(int(NO_ID)).to_numpy()
    t, ids = t.take(pa.array(np.argsort(ids, kind="stable"))), np.sort(ids, kind="stable")
    hashes, first = terms_of(t.column("text").combine_chunks())
    doc = np.repeat(np.arange(len(ids)), np.diff(first))
    order = np.lexsort((doc, hashes))
    hashes, doc = hashes[order], doc[order]
    start = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])]))
    tf = np.diff(np.append(start, len(hashes)))
    hashes, doc = hashes[start], doc[start]
    order = np.lexsort((doc, tf, hashes))
    hashes, tf, doc = hashes[order], tf[order], doc[order]
    new_term = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    group = np.flatnonzero(new_term | np.concatenate([[True], tf[1:] != tf[:-1]]))
    terms = np.flatnonzero(new_term)
    lists = [ids, hashes[terms], np.append(np.searchsorted(group, terms), len(group)).astype(np.int32), tf[group].astype(np.int32),
             np.append(group, len(doc)).astype(np.int32), doc.astype(np.int32)]
    return pa.table([pa.array([key[0].as_py()]), pa.array([key[1].as_py()]),
                     *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in lists)],
                    names=["m", "slice", "docs", "terms", "term_at", "tfs", "tf_at", "postings"])


class Index:
    """A written index with the two numbers of the corpus that scores need."""

    def __init__(self, rows: DataFrame, n_docs: int, n_terms: int):
        self.rows, self.n_docs, self.n_terms = rows, n_docs, n_terms


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of every row of ``docs``; rows without a term (null and empty texts) are in no stratum.

    Two scans: one counts the lengths, which give N, L, the strata and their
    sizes; the other deals the documents to slices of their strata. A stratum
    has as many slices as its size asks for, so one that holds a third of the
    corpus is many groups.
    """
    spark = docs.sparkSession
    small_batches(spark)
    slim = id_and_text(docs, id_col, text_col)
    path = staging_path(spark, "lengths")
    (slim.select("text").mapInArrow(_lengths, "n long, docs long").groupBy("n").agg(F.sum("docs").alias("docs")).where("n > 0").write.parquet(path))
    lengths = spark.read.schema("n long, docs long").parquet(path)
    n_docs, n_terms = (x or 0 for x in lengths.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first())
    path = staging_path(spark, "lexical-index")
    if not n_docs:
        return Index(spark.createDataFrame([], _INDEX), 0, 0)
    normaliser = F.expr(f"10 + (90 * n * {n_docs}L) div {n_terms}L")
    strata = (lengths.groupBy(normaliser.alias("m")).agg(F.sum(F.col("docs") * (F.col("n") + DOC_WEIGHT)).alias("size"))
              .select("m", F.expr(f"size div {SLICE_TERMS} + 1").alias("of")))
    dealt = (slim.mapInArrow(_with_length, "doc_id long, text string, n long").where("n > 0").withColumn("m", normaliser).drop("n")
             .join(strata, "m").withColumn("slice", F.expr("pmod(xxhash64(doc_id, text), of)")).drop("of"))
    dealt.groupBy("m", "slice").applyInArrow(_slice_row, _INDEX).write.parquet(path)
    return Index(spark.read.schema(_INDEX).parquet(path), n_docs, n_terms)


def _values(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[dict[str, np.ndarray]]:
    flat = {c: (batch.column(c).flatten().to_numpy(zero_copy_only=False),
                np.concatenate([[0], np.cumsum(batch.column(c).value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)) for c in names}
    for k in range(batch.num_rows):
        yield {c: v[at[k]:at[k + 1]] for c, (v, at) in flat.items()}


def _where(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(those of ``wanted`` that are among ``terms``, as positions in each)."""
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    have = np.flatnonzero(terms[at] == wanted)
    return have, at[have]


def _frequencies(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(wanted), np.int64)
        for b in batches:
            for row in _values(b, ("terms", "term_at", "tf_at")):
                have, at = _where(row["terms"], wanted)
                df[have] += row["tf_at"][row["term_at"][at + 1]] - row["tf_at"][row["term_at"][at]]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])
    return run


class _Best:
    """The best documents of each query so far: score, then id."""

    def __init__(self, n: int, keep: int):
        self.keep = keep
        self.q = self.score = self.doc = np.zeros(0, np.int64)
        self.least = np.ones(n, np.int64)                   # the score a document must reach

    def add(self, q: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        q, score, doc = np.concatenate([self.q, q]), np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score, q))
        q, score, doc = q[order], score[order], doc[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        keep = nth < self.keep
        self.q, self.score, self.doc = q[keep], score[keep], doc[keep]
        last = nth[keep] == self.keep - 1
        self.least[self.q[last]] = self.score[last]


def _searching(wanted: np.ndarray, weight: np.ndarray, term_q_at: np.ndarray, term_q: np.ndarray, n_queries: int, keep: int):
    """``term_q[term_q_at[t]:term_q_at[t + 1]]`` are the queries with term ``wanted[t]``."""
    def impacts(tf: np.ndarray, term: np.ndarray, m: int) -> np.ndarray:
        return weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(n_queries, keep)
        for b in batches:
            rows, bounds = [], []
            for m, row in zip(b.column("m").to_pylist(), _values(b, ("docs", "terms", "term_at", "tfs", "tf_at", "postings"))):
                have, at = _where(row["terms"], wanted)
                most = row["tfs"][row["term_at"][at + 1] - 1].astype(np.int64)       # frequencies ascend within a term
                own = impacts(most, have, m)
                bound = np.zeros(n_queries, np.int64)
                pairs = ragged(term_q_at[have], term_q_at[have + 1])
                np.add.at(bound, term_q[pairs], np.repeat(own, term_q_at[have + 1] - term_q_at[have]))
                rows.append((m, row, have, at))
                bounds.append(bound)
            for k in sorted(range(len(rows)), key=lambda k: -int(bounds[k].max(initial=0))):
                active = bounds[k] >= best.least
                if not active.any():
                    continue
                m, row, have, at = rows[k]
                number = np.cumsum(active) - 1
                q_of, n_docs = np.flatnonzero(active), len(row["docs"])
                # one impact for each (term, frequency) of the stratum, then its postings, then the queries of the term
                groups = ragged(row["term_at"][at], row["term_at"][at + 1])
                size = row["term_at"][at + 1] - row["term_at"][at]
                impact = impacts(row["tfs"][groups].astype(np.int64), np.repeat(have, size), m)
                value = np.repeat(impact, row["tf_at"][groups + 1] - row["tf_at"][groups])
                docs = row["postings"][ragged(row["tf_at"][groups].astype(np.int64), row["tf_at"][groups + 1].astype(np.int64))]
                n_post = (row["tf_at"][row["term_at"][at + 1]] - row["tf_at"][row["term_at"][at]]).astype(np.int64)
                stop = np.cumsum(n_post)
                pairs = ragged(term_q_at[have], term_q_at[have + 1])
                which = np.repeat(np.arange(len(have)), term_q_at[have + 1] - term_q_at[have])
                asked = active[term_q[pairs]]
                q, which = number[term_q[pairs][asked]], which[asked]
                places = ragged(stop[which] - n_post[which], stop[which])
                score = np.zeros(len(q_of) * n_docs, np.int64)
                np.add.at(score, np.repeat(q, n_post[which]) * n_docs + docs[places], value[places])
                good = np.flatnonzero(score >= np.repeat(best.least[q_of], n_docs))
                best.add(q_of[good // n_docs], score[good], row["docs"][good % n_docs])
        part = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays([pa.array(best.q), pa.array(best.score), pa.array(best.doc), pa.array(np.full(len(best.q), part))], ["q", "score", "doc", "part"])
    return run


def _light_batches(spark: SparkSession) -> None:
    """Index rows are about a megabyte each: a Python worker gets BATCH_BYTES of them at once at most."""
    small_batches(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(name))
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def _blocks(items: DataFrame) -> Iterator[list]:
    held, size = [], 0
    for r in items.toLocalIterator():
        held.append(r)
        size += len((r.text or "").encode())
        if size >= ITEM_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _top(found: DataFrame, by: list[str], best: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("doc")))).where(F.col("rank") <= best)


def search(index: Index, items: DataFrame, item_col: str = "item_id", text_col: str = "text", best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``best`` documents of each row of ``items`` with a score above 0.

    Equal scores rank by ascending id, a null id last; rows that repeat an id
    rank each on their own. A null or empty item, or one whose terms no
    document holds, has no rows; items that repeat an id each have their
    ranks. Items are searched in blocks of ITEM_BYTES of text; each block
    reads the index, not the texts.
    """
    spark = items.sparkSession
    _light_batches(spark)
    kind = items.schema[item_col].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    out = None
    for block in _blocks(items.select(items[item_col].alias("item_id"), items[text_col].alias("text"))) if index.n_docs else ():
        hashes, first = terms_of(pa.array([r.text for r in block], pa.string()))
        q = np.repeat(np.arange(len(block)), np.diff(first))
        pairs = np.unique(np.stack([hashes, q], axis=1), axis=0) if len(q) else np.zeros((0, 2), np.int64)
        wanted, at = np.unique(pairs[:, 0], return_index=True)
        if not len(wanted):
            continue
        df = np.zeros(len(wanted), np.int64)
        counted = index.rows.select("terms", "term_at", "tf_at").mapInArrow(_frequencies(wanted), "term long, df long")
        for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():        # one row for each term of the block at most
            df[r.term] = r.df
        weight = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        run = _searching(wanted, weight, np.append(at, len(pairs)).astype(np.int64), pairs[:, 1].copy(), len(block), best)
        found = index.rows.select("m", "docs", "terms", "term_at", "tfs", "tf_at", "postings").mapInArrow(run, "q long, score long, doc long, part long")
        found = _top(_top(found, ["q", "part"], best).drop("rank"), ["q"], best)
        names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(block)], f"q long, item_id {kind}")
        rows = found.join(names, "q").select("item_id", "rank", F.when(F.col("doc") != int(NO_ID), F.col("doc")).alias("doc_id"), "score")
        out = rows if out is None else out.union(rows)
    return spark.createDataFrame([], schema) if out is None else out


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every item's ten best documents, from an index of all documents built for it."""
    return search(build(docs), items)
