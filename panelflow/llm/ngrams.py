"""Jaccard join of word n-gram sets by vertical partitioning (operator 11).

Documents with equal sets are one class. The n-grams have one global order:
rare ones first, as counted in BUCKETS hash buckets, then by hash. Two sets
of Jaccard t or more share one of the first n - ceil(t n) + 1 n-grams of
either, so only these prefixes are indexed, and only n-grams that two
prefixes share go further.

The overlap of a candidate pair is counted by fragments. Cuts of the order
divide every set into FRAGMENTS segments; a segment meets only the segment of
the same fragment of the other set, a pair whose other fragments cannot make
up for what is missing in one is dropped there, and the partial overlaps are
summed per pair.

Components need no list of all links. First each set is compared with the
smallest set under each n-gram it shares, then with the greatest one and the
next in a random order that are in another component, then with the next in
another order: n near copies are linked by comparisons in proportion to n, also
where they drift away from each other. After that only sets of different
components under one n-gram are compared, so every link between different
components is still found.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelflow.llm.common import WORDS, id_and_text, lower, slices, small_batches, text_bytes, word_hashes, word_spans
from panelflow.llm.components import connected_components
from panelflow.session import staging_path
from panelflow.sinks.paths import delete

SIZE, SIMILARITY = 4, Fraction(85, 100)
BUCKET_BITS = 20                # 2**20 counts of four bytes in a counting task; one byte each in the order
_PARTS = 1 << 8                 # the counts travel in so many parts
TASKS_SUMMED = 512
FRAGMENTS = 16
SIGNATURE_BITS = 512
_SIGNATURE = [f"s{k}" for k in range(SIGNATURE_BITS // 64)]
BEFORE = 16                     # n-grams before one of a prefix that its index row names
ORDERED = 1 << 17               # index rows of an n-gram that are put into one order
SENT_ROWS = 1 << 20             # rows of two columns that are sent to every task rather than joined by a shuffle


def _ngrams(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of each text's different n-grams, first of each text and the end)."""
    data, offsets = text_bytes(column)
    data = lower(data)
    starts, ends, first = word_spans(data, offsets)
    count = np.diff(first)
    n = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    text = np.repeat(np.arange(len(n)), n)
    lead = np.arange(len(text)) + (first[:-1] - np.cumsum(n) + n)[text]
    hashes = WORDS.spans(WORDS.sums(word_hashes(data, starts, ends)), lead, np.minimum(lead + size, first[1:][text]))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(n)))]).astype(np.int64)


def _keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit key of each text's set."""
    return WORDS.spans(WORDS.sums(hashes), first[:-1], first[1:]).view(np.int64)


def _bucket_counts(size: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for b in slices(batches, "text"):
            h, _ = _ngrams(b.column("text"), size)
            counts += np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        wide = "<i8" if counts.max() >= 1 << 31 else "<i4"
        tasks = TaskContext.get().partitionId() // TASKS_SUMMED
        for part, c in enumerate(counts.reshape(_PARTS, -1)):
            if c.any():
                yield pa.RecordBatch.from_arrays([pa.array([tasks], pa.int32()), pa.array([part], pa.int32()), pa.array([c.astype(wide).tobytes()])],
                                                 ["tasks", "part", "counts"])
    return run


def _summed(t: pa.Table, length: int) -> np.ndarray:
    total = np.zeros(length, np.int64)
    for c in t.column("counts").to_pylist():
        total += np.frombuffer(c, "<i8" if len(c) == 8 * length else "<i4")
    return total


def _add_up(length: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        return pa.table({"part": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([_summed(t, length).tobytes()])})
    return run


def _rank(length: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        ranks = np.minimum(255, 4 * np.log2(_summed(t, length) + 1)).astype(np.uint8)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "ranks": pa.array([ranks.tobytes()])})
    return run


def order_of(docs: DataFrame, size: int = SIZE, bits: int = BUCKET_BITS) -> np.ndarray:
    """For each hash bucket how frequent its n-grams are in ``docs(text)``, 0 to 255: 2**bits bytes, whatever the corpus."""
    length = (1 << bits) // _PARTS
    out = np.zeros((_PARTS, length), np.uint8)
    # summed for TASKS_SUMMED tasks at a time first, so that no group holds the counts of all tasks
    counted = (docs.select("text").mapInArrow(_bucket_counts(size, bits), "tasks int, part int, counts binary")
               .groupBy("tasks", "part").applyInArrow(_add_up(length), "part int, counts binary"))
    for r in counted.groupBy("part").applyInArrow(_rank(length), "part int, ranks binary").collect():      # one megabyte
        out[r.part] = np.frombuffer(r.ranks, np.uint8)
    return out.ravel()


def _ordered(hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places in the global order: the bucket's rank, then 56 bits of the hash."""
    bits = len(ranks).bit_length() - 1
    return (ranks[(hashes >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))


def _prefixes(size: int, t: Fraction, ranks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, first = _ngrams(b.column("text"), size)
            n = np.diff(first)
            places = _ordered(h, ranks)
            text = np.repeat(np.arange(len(n)), n)
            places = places[np.lexsort((places, text))]
            # the parity of the n-grams in each of SIGNATURE_BITS hash buckets
            odd = np.bincount(text * SIGNATURE_BITS + (h & np.uint64(SIGNATURE_BITS - 1)).astype(np.int64), minlength=len(n) * SIGNATURE_BITS) & 1
            signature = np.packbits(odd.astype(np.uint8).reshape(len(n), -1), axis=1).reshape(len(n), -1).view(np.int64)
            # a set of n has a different partner only if n of n + 1 n-grams are enough
            length = np.where(n * t.denominator >= (n + 1) * t.numerator, n + (-n * t.numerator) // t.denominator + 1, 0)
            at = np.concatenate([[0], np.cumsum(length)])
            own = np.repeat(first[:-1] - at[:-1], length) + np.arange(at[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("same"), pa.array(_keys(h, first)), pa.array(n), *(pa.array(np.ascontiguousarray(c)) for c in signature.T),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(places[own].view(np.int64)))], ["doc_id", "same", "key", "n", *_SIGNATURE, "prefix"])
    return run


def _segments(size: int, ranks: np.ndarray, cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, first = _ngrams(b.column("text"), size)
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            fragment = np.searchsorted(cuts, _ordered(h, ranks), "right")
            order = np.lexsort((fragment, text))
            h, group = h[order], (text * (len(cuts) + 1) + fragment)[order]
            start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
            keys = _keys(*_ngrams(b.column("text"), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[group[start] // (len(cuts) + 1)]), pa.array((group[start] % (len(cuts) + 1)).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(np.append(start, len(h)), pa.int32()), pa.array(h.view(np.int64)))], ["key", "fragment", "grams"])
    return run


def _stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written below the shared folder and read again; what its shuffles left is freed with its plan."""
    spark, schema = df.sparkSession, df.schema
    df.write.parquet(path)
    del df
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def _small(df: DataFrame) -> DataFrame:
    """``df``, a written table of two columns at most, to be sent to all tasks if it is counted to be small."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def _cuts(ranks: np.ndarray, fragments: int) -> np.ndarray:
    """The first place of each fragment but the first; a fragment has about as many buckets as any other.

    Buckets of one rank are divided by their hashes.
    """
    order = np.lexsort((np.arange(len(ranks)), ranks))
    chosen = order[[len(order) * k // fragments for k in range(1, fragments)]]
    shift = 56 - (len(ranks).bit_length() - 1)
    return (ranks[chosen].astype(np.uint64) << np.uint64(56)) | (chosen.astype(np.uint64) << np.uint64(shift))


class Join:
    """The classes of a corpus, their shared prefixes, and pair checks by fragments."""

    def __init__(self, docs: DataFrame, size: int = SIZE, similarity: Fraction = SIMILARITY):
        small_batches(docs.sparkSession)
        # same tells rows that repeat an id apart
        self.docs, self.size, self.t = docs.withColumn("same", F.xxhash64("text")), size, similarity
        self.ranks = order_of(docs, size)
        # every table lies in a folder of its own, so that the large ones can go when nothing reads them any more
        self.folder, spark = staging_path(docs.sparkSession, "ngram-join"), docs.sparkSession
        rows = self._keep(self.docs.mapInArrow(_prefixes(size, similarity, self.ranks), 
                                              f"doc_id long, same long, key long, n long, {', '.join(f'{c} long' for c in _SIGNATURE)}, prefix array<long>"), "sets")
        self.members = self._keep(rows.select("doc_id", "key", "n"), "members")
        classes = rows.where("size(prefix) > 0").groupBy("key").agg(F.min(F.struct("doc_id", "same")).alias("at"), *[F.first(c).alias(c) for c in ("n", *_SIGNATURE, "prefix")])
        classes = self._keep(classes, "classes")
        del rows
        delete(spark, f"{self.folder}/sets")
        self.places = self._keep(classes.select("key", "at.doc_id", "at.same", *_SIGNATURE), "places")
        index = classes.select("key", "n", F.posexplode("prefix").alias("pos", "gram"))
        repeated = self._keep(index.groupBy("gram").count().where("count > 1").select("gram"), "repeated")
        index = self._keep(index.join(repeated, "gram"), "index")
        del classes
        delete(spark, f"{self.folder}/classes")
        least = index.groupBy("gram").agg(F.min(F.struct("key", "n")).alias("least"))
        self.shared = self._keep(index.join(least, "gram").select("gram", "key", "n", "pos", F.col("least.key").alias("low"), F.col("least.n").alias("low_n")), "shared")

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return _stored(df, f"{self.folder}/{name}")

    def _need(self, x: str, y: str) -> str:
        num, den = self.t.numerator, self.t.denominator
        return f"((({x} + {y}) * {num} + {num + den - 1}) div {num + den})"

    def _long_enough(self, x: str, y: str) -> str:
        return f"least({x}, {y}) * {self.t.denominator} >= greatest({x}, {y}) * {self.t.numerator}"

    def _close(self, x: str, y: str, nx: str, ny: str) -> str:
        """May the sets be similar? Two sets differ in at least as many n-grams as their signatures in bits."""
        return f"{' + '.join(f'bit_count({x}.{c} ^ {y}.{c})' for c in _SIGNATURE)} <= {nx} + {ny} - 2 * {self._need(nx, ny)}"

    def first_pairs(self) -> DataFrame:
        """(a, b, na, nb): every set with one other, of those that are smallest under an n-gram of its prefix the one it shares most with."""
        shares = (self.shared.where("key <> low and " + self._long_enough("n", "low_n"))
                  .groupBy("key", "n", "low", "low_n").agg(F.count("*").alias("both")))
        pairs = (shares.groupBy(F.col("key").alias("a"), F.col("n").alias("na")).agg(F.max(F.struct("both", "low", "low_n")).alias("most"))
                 .select("a", F.col("most.low").alias("b"), "na", F.col("most.low_n").alias("nb")))
        return self._by_signature(pairs)

    def _mixed(self, labels: DataFrame, name: str) -> DataFrame:
        """The index rows (gram, key, n, pos, label) of n-grams that sets of different labels share, and how many (held) each has."""
        named = self._keep(self.shared.select("gram", "key", "n", "pos").join(_small(labels), "key", "left").withColumn("label", F.coalesce("label", "key")), f"{name}-labelled")
        mixed = named.groupBy("gram").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("held")).where("x <> y").select("gram", "held")
        mixed = self._keep(named.join(_small(self._keep(mixed, f"{name}-grams")), "gram"), f"{name}-mixed")
        delete(labels.sparkSession, f"{self.folder}/{name}-labelled")
        return mixed

    def _next(self, rest: DataFrame, order: int) -> DataFrame:
        """(a, b, na, nb): every set of ``rest`` with the one after it under each n-gram, in a random order of its own, where their labels differ.

        An n-gram of more than ORDERED sets has several such orders.
        """
        place = F.xxhash64("key", "gram", F.lit(order))
        near = Window.partitionBy("gram", F.pmod(F.xxhash64(F.lit(order), "key"), F.expr(f"held div {ORDERED} + 1"))).orderBy(place, "key")
        pairs = rest.withColumn("next", F.lead(F.struct("key", "n", "label")).over(near)).where("label <> next.label and " + self._long_enough("n", "next.n"))
        x, y = F.struct("key", "n"), F.struct("next.key", "next.n")
        return (pairs.select(F.greatest(x, y).alias("x"), F.least(x, y).alias("y"))
                .select(F.col("x.key").alias("a"), F.col("y.key").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")))

    def second_pairs(self, labels: DataFrame) -> DataFrame:
        """(a, b, na, nb): every set with the greatest set under each n-gram it shares and with the next one, where their labels differ."""
        rest = self._mixed(labels, "second")
        high = rest.groupBy("gram").agg(F.max(F.struct("key", "n", "label")).alias("high"))
        pairs = (rest.join(high, "gram").where("label <> high.label and " + self._long_enough("n", "high.n"))
                 .select(F.col("high.key").alias("a"), F.col("key").alias("b"), F.col("high.n").alias("na"), F.col("n").alias("nb")))
        return self._by_signature(pairs.union(self._next(rest, 0)).distinct())

    def third_pairs(self, labels: DataFrame) -> DataFrame:
        """(a, b, na, nb): every set with the next set, in another order, under each n-gram it shares, where their labels differ."""
        return self._by_signature(self._next(self._mixed(labels, "third"), 1).distinct())

    def _by_signature(self, pairs: DataFrame) -> DataFrame:
        of = self.places.select("key", *_SIGNATURE)
        return (pairs.join(of.alias("x"), F.col("a") == F.col("x.key")).join(of.alias("y"), F.col("b") == F.col("y.key"))
                .where(self._close("x", "y", "na", "nb")).select("a", "b", "na", "nb"))

    def other_pairs(self, labels: DataFrame) -> DataFrame:
        """(a, b, na, nb): all sets under one n-gram whose labels differ."""
        return self.other_rows(labels).distinct()

    def other_rows(self, labels: DataFrame) -> DataFrame:
        """The pairs of :meth:`other_pairs`, some more than once.

        Near copies share most of their prefixes. A pair is left out under an
        n-gram if one of the last BEFORE shared n-grams of both is the same:
        it meets there too, and nothing is left out under the first n-gram
        that the two have in common.
        """
        before = F.collect_list("gram").over(Window.partitionBy("key").orderBy("pos").rowsBetween(-BEFORE, -1))
        rest = self._mixed(labels, "other").drop("held").withColumn("before", before)
        rest = self._keep(rest.join(self.places.select("key", *_SIGNATURE), "key"), "other-signed")
        need = self._need("x.n", "y.n")
        return (rest.alias("x").join(rest.alias("y"), F.expr(f"""x.gram = y.gram and y.key < x.key and x.label <> y.label
                    and {self._long_enough('x.n', 'y.n')} and least(x.n - x.pos, y.n - y.pos) >= {need} and {self._close('x', 'y', 'x.n', 'y.n')}
                    and not arrays_overlap(x.before, y.before)"""))
                .selectExpr("x.key as a", "y.key as b", "x.n as na", "y.n as nb"))

    def segments(self, pairs: DataFrame, name: str) -> DataFrame:
        """(key, fragment, grams) of the sets in ``pairs``, each from the text at its first place."""
        wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
        places = self._keep(self.places.join(wanted, "key").select("doc_id", "same"), f"{name}-places")
        at = [F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")), F.col("x.same") == F.col("y.same")]
        texts = self.docs.alias("x").join(_small(places).alias("y"), at[0] & at[1], "left_semi").dropDuplicates(["doc_id", "same"])
        run = _segments(self.size, self.ranks, _cuts(self.ranks, FRAGMENTS))
        return self._keep(texts.select("text").mapInArrow(run, "key long, fragment int, grams array<long>"), f"{name}-segments")

    def linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """The (a, b) of ``pairs(a, b, na, nb)`` whose Jaccard is high enough: partial overlaps by fragment, summed per pair."""
        pairs = self._keep(pairs, f"{name}-pairs")
        for done in ("mixed", "signed"):                # what the pairs were made from
            delete(pairs.sparkSession, f"{self.folder}/{name}-{done}")
        s = self.segments(pairs, name)
        x, y = s.select(F.col("key").alias("a"), "fragment", F.col("grams").alias("ga")), s.select(F.col("key").alias("b"), "fragment", F.col("grams").alias("gb"))
        # of the segments on the second side only those of sets that stand there
        y = y.join(_small(self._keep(pairs.select("b").distinct(), f"{name}-second")), "b", "left_semi")
        met = _small(pairs).join(x, "a").join(y, ["b", "fragment"]).withColumn("both", F.size(F.array_intersect("ga", "gb")))
        need = self._need("na", "nb")
        # the other fragments hold na - |ga| and nb - |gb| n-grams; if they cannot make up the rest the pair falls short anyway
        met = met.where(f"both > 0 and both + least(na - size(ga), nb - size(gb)) >= {need}")
        summed = met.groupBy("a", "b", "na", "nb").agg(F.sum("both").alias("both")).where(f"both >= {need}").select("a", "b")
        links = self._keep(summed, f"{name}-links")
        delete(pairs.sparkSession, f"{self.folder}/{name}-segments")
        return links


def _merged(join: Join, labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(key, label) after ``links`` tie the components that ``labels`` names; a set without a label is its own."""
    named = lambda side: labels.select(F.col("key").alias(side), F.col("label").alias(f"{side}_label"))
    between = (links.join(named("a"), "a", "left").join(named("b"), "b", "left")
               .select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")))
    roots = join._keep(connected_components(between).select(F.col("node").alias("label"), "root"), f"{name}-roots")
    known = labels.join(roots, "label", "left").select("key", F.coalesce("root", "label").alias("label"))
    alone = roots.join(labels.select("label").distinct(), "label", "left_anti").select(F.col("label").alias("key"), F.col("root").alias("label"))
    return join._keep(known.union(alone), f"{name}-labels")


def components(join: Join) -> DataFrame:
    """(key, label) of the classes that are linked to another one: the same label for all of a component."""
    none = join.members.sparkSession.createDataFrame([], "key long, label long")
    labels = _merged(join, none, join.linked(join.first_pairs(), "first"), "first")
    labels = _merged(join, labels, join.linked(join.second_pairs(labels), "second"), "second")
    labels = _merged(join, labels, join.linked(join.third_pairs(labels), "third"), "third")
    return _merged(join, labels, join.linked(join.other_pairs(labels), "other"), "other")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, similarity: Fraction = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    A set holds a text's different ``size``-word n-grams, A-Z lower-cased; a
    text of fewer words is one n-gram; null, empty and blank texts have an
    empty set and are linked with nothing. Sets link at a Jaccard of
    ``similarity`` or more, equal sets always. component_id is the smallest
    id reachable; null ids never name a component that has another id. Rows
    that repeat an id are judged each by its own text. An empty table gives
    no rows. N-grams and sets are compared by 64 bits of hash.
    """
    join = Join(id_and_text(docs, id_col, text_col), size, Fraction(similarity))
    roots = components(join).withColumnRenamed("label", "root")
    least = join.members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = least.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that the last join reads two plain exchanges and a class with many copies can be split
    names = join._keep(named.join(lowest, "root").select("key", "component_id"), "names")
    some = join.members.where("n > 0").join(names, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.union(join.members.where("n = 0").select("doc_id", "n", "doc_id"))
