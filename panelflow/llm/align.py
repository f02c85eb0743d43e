"""Alignment of two tokenizers by merge-path partitioning (operator 13).

Both tokenizers cut the same bytes, a space and the text. The byte ends of
their tokens are two ascending sequences; merging them tells where tokens
of both end, and these places cut the tokens into groups. The merge is
divided by diagonals: the point where a diagonal crosses the merge path is
found by a binary search, and every PIECE steps between two diagonals are a
piece of equal work, whatever documents it covers. All pieces of a slice
merge in lockstep, one numpy step for all of them; a place where both end
that lies across two pieces is stitched when their outputs stand together.

A document's links (token pairs that end together) are kept as counted pair
codes. Counts of id pairs over the corpus are summed in tasks first, then by
Spark, and written as sorted arrays in the shared folder that the last pass
maps. Their number is bounded by the two vocabularies, not by the corpus.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm import hashstore
from panelflow.llm.common import id_and_text, mix, ragged, slices, small_batches, worker_cache
from panelflow.session import staging_path

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE = 128                     # merge steps of a piece
SLICE = 1 << 20                 # text bytes handled at once; a longer text is a slice of its own
SHARD_BITS = 5                  # the pair table has 2**5 shards
HELD_PAIRS = 1 << 20            # different pairs a counting task holds before it hands them on
# the white space sentencepiece writes in pieces: fixed by its format
_MARK = "▁"


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as the characters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class _Vocabulary:
    """Bytes of every token id, and an encoder."""

    def __init__(self, tokens: list[bytes], encode: Callable[[list[str]], list]):
        self.tokens, self.encode = tokens, encode
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.at = np.concatenate([[0], np.cumsum(self.size)])

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.at[ids], self.at[ids + 1])]


def byte_level(path: str) -> _Vocabulary:
    """A byte-level BPE file of the tokenizers library; each text is encoded with a space before it.

    Where the file's ids are its merge ranks, tiktoken gives the same ids in
    a third of the time; texts that its pattern matcher refuses (long runs
    of white space) and other files go to the library itself.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    byte = _byte_of_char()
    vocab = {bytes(byte[c] for c in t): i for t, i in file["model"]["vocab"].items()}
    added = {t["id"]: t["content"].encode() for t in file.get("added_tokens") or ()}
    by_id = {i: t for t, i in vocab.items()} | added
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    whole = tokenizers.Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    ranked = True
    for k, merge in enumerate(file["model"]["merges"]):
        x, y = merge.split(" ") if isinstance(merge, str) else merge
        ranked = ranked and file["model"]["vocab"].get(x + y) == 256 + k
    plain = (file.get("pre_tokenizer") or {}) == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    quick = None
    if ranked and plain and not file.get("normalizer") and len(vocab) == 256 + len(file["model"]["merges"]):
        quick = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab, special_tokens={})

    def one(text: str):
        if quick is not None:
            try:
                return quick.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
            except ValueError:
                pass
        return np.array(whole.encode(" " + text, add_special_tokens=False).ids, np.int64)

    return _Vocabulary(tokens, lambda texts: [one(t) for t in texts])


def pieces(path: str) -> _Vocabulary:
    """A sentencepiece model, which adds the space before a text itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        tokens.append(bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_MARK, " ").encode())
    return _Vocabulary(tokens, lambda texts: [np.array(x, np.int64) for x in model.encode(texts, num_threads=1)])


def _opened(kind: Callable, path: str) -> _Vocabulary:
    kept = worker_cache()
    if ("align", path) not in kept:
        kept["align", path] = kind(path)
    return kept["align", path]


def diagonals(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) where the merge path of ascending ``a`` and ``b`` crosses every ``step``-th diagonal, ends included.

    Of the first i + j merged values i come from ``a``; equal values take
    ``a`` first. All diagonals are searched at once, by halving.
    """
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, step), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, d - low
        mid = (low[open_] + high[open_]) // 2
        before = a[mid] <= b[d[open_] - mid - 1]
        low[open_[before]], high[open_[~before]] = mid[before] + 1, mid[~before]


def merged(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> np.ndarray:
    """For each place of the merge of ``a`` and ``b``, equal values ``a`` first: does its value come from ``a``?

    Every piece between two diagonals is merged on its own; all of them
    take their next value in the same numpy step.
    """
    i, j = diagonals(a, b, step)
    i_end, j_end = i[1:], j[1:]
    i, j = i[:-1].copy(), j[:-1].copy()
    a1, b1 = np.append(a, np.iinfo(np.int64).max), np.append(b, np.iinfo(np.int64).max)
    out = np.zeros((len(i), step), bool)
    for k in range(step):
        take = (i < i_end) & ((j >= j_end) | (a1[i] <= b1[j]))
        out[:, k] = take
        i += take
        j += ~take & (j < j_end)
    return out.ravel()[:len(a) + len(b)]


class Aligned:
    """The alignment of a slice of texts that stand end to end: per text its tokens' span, groups and links."""

    def __init__(self, a_ends: np.ndarray, b_ends: np.ndarray, step: int = PIECE):
        from_a = merged(a_ends, b_ends, step)
        n_a = np.cumsum(from_a)                                  # tokens of A among the places up to here
        n_b = np.arange(1, len(from_a) + 1) - n_a
        # an end of A with the same end of B right after it, be it in the next piece
        x = np.flatnonzero(from_a[:-1] & ~from_a[1:])
        x = x[a_ends[n_a[x] - 1] == b_ends[n_b[x + 1] - 1]]
        self.link_a, self.link_b = n_a[x] - 1, n_b[x + 1] - 1    # the tokens that end there
        self.ends = a_ends[self.link_a]
        size_a, size_b = np.diff(self.link_a, prepend=-1), np.diff(self.link_b, prepend=-1)
        before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        # places of the tokens when each group lists those of A, then those of B
        self.place_a = np.arange(len(a_ends)) + np.repeat(before_b, size_a)
        self.place_b = np.arange(len(b_ends)) + np.repeat(before_a + size_a, size_b)


def _aligning(a_path: str, b_path: str, keep_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = _opened(byte_level, a_path), _opened(pieces, b_path)
        kept = worker_cache()
        if ("align-text", a_path, b_path) not in kept:
            # a token's decimal id with what follows it: of A "," or "|", of B "," or ";"
            kept["align-text", a_path, b_path] = [f"{i}{c}".encode() for v, marks in ((va, ",|"), (vb, ",;")) for c in marks for i in range(len(v.tokens))]
        written, na, nb = kept["align-text", a_path, b_path], len(va.tokens), len(vb.tokens)
        if na * nb >= 1 << 34:
            raise ValueError("a pair of ids must fit 34 bits")
        for batch in slices(batches, "text", SLICE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            some = [k for k, t in enumerate(texts) if t]
            ids_a, ids_b = va.encode([texts[k] for k in some]), vb.encode([texts[k] for k in some])
            whole = [np.frombuffer((" " + texts[k]).encode(), np.uint8) for k in some]
            same = [len(w) == va.size[x].sum() and len(w) == vb.size[y].sum() and np.array_equal(w, va.bytes_of(x)) and np.array_equal(w, vb.bytes_of(y))
                    for w, x, y in zip(whole, ids_a, ids_b)]
            use = [k for k, ok in enumerate(same) if ok]
            n = len(texts)
            n_a, n_b, n_groups = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            digest, text, pair_lists = [""] * n, [""] * n, np.zeros(n + 1, np.int64)
            codes = counts = np.zeros(0, np.int64)
            if use:
                rows = np.array([some[k] for k in use])
                n_a[rows], n_b[rows] = [len(ids_a[k]) for k in use], [len(ids_b[k]) for k in use]
                a, b = np.concatenate([ids_a[k] for k in use]), np.concatenate([ids_b[k] for k in use])
                done = Aligned(np.cumsum(va.size[a]), np.cumsum(vb.size[b]))
                stops = np.cumsum([len(whole[k]) for k in use])
                owner = np.searchsorted(stops, done.ends)                 # the text of each link
                n_groups[rows] = np.bincount(owner, minlength=len(use))
                code = (owner.astype(np.int64) << 34) + a[done.link_a] * nb + b[done.link_b]
                distinct, counts = np.unique(code, return_counts=True)
                pair_lists[rows + 1] = np.bincount(distinct >> 34, minlength=len(use))
                codes = distinct & ((1 << 34) - 1)
                flat = np.empty(len(a) + len(b), np.int64)
                flat[done.place_a], flat[done.place_b] = a, b + 2 * na
                flat[done.place_a[done.link_a]] += na
                flat[done.place_b[done.link_b]] += nb
                cut = np.concatenate([[0], np.cumsum(n_a[rows] + n_b[rows])])
                for r, s, e in zip(rows.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                    joined = b"".join(map(written.__getitem__, flat[s:e].tolist()))[:-1]
                    digest[r] = hashlib.sha256(joined).hexdigest()
                    if keep_groups:
                        text[r] = joined.decode()
            offsets = pa.array(np.cumsum(pair_lists), pa.int32())
            columns = [batch.column("doc_id"), *(pa.array(x) for x in (n_a, n_b, n_groups)), pa.array(digest),
                       pa.ListArray.from_arrays(offsets, pa.array(codes)), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))]
            names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(text)] if keep_groups else columns, [*names, "groups"] if keep_groups else names)
    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None,
          keep_groups: bool = True) -> DataFrame:
    """Every row of ``docs`` with its alignment: doc_id, n_a, n_b, n_groups, groups_sha256, pairs, times, and groups.

    ``groups`` lists the groups' ids as ``a1,a2|b1;a3|b2,b3``. ``pairs`` are
    the different id pairs that are linked in the text, as a * |B| + b, and
    ``times`` how often each is. A text that is null, empty, or not given
    back byte for byte by both tokenizers has no tokens: zeros, empty lists
    and an empty digest. Special tokens in a text are ordinary text. A text
    of any length is one row; repeated rows each come back.
    """
    a_path, b_path = a_path or public_tokenizers.path(A_VOCABULARY), b_path or public_tokenizers.path(B_VOCABULARY)
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"
    return id_and_text(docs, id_col, text_col).mapInArrow(_aligning(a_path, b_path, keep_groups), schema + ", groups string" * keep_groups)


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, first pair of each row and the end)."""
    pairs, times = batch.column("pairs"), batch.column("times")
    return (pairs.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64))


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(inverse, np.concatenate(n), len(k)).astype(np.int64)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    held, waiting, n = (none, none), [], 0
    out = lambda x: pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1])], ["pair", "n"])
    for batch in batches:
        pairs, times, _ = _lists(batch)
        waiting.append((pairs, times))
        n += len(pairs)
        if n > HELD_PAIRS:
            held, waiting, n = _summed([held[0], *(w[0] for w in waiting)], [held[1], *(w[1] for w in waiting)]), [], 0
            if len(held[0]) > HELD_PAIRS:
                yield out(held)
                held = (none, none)
    yield out(_summed([held[0], *(w[0] for w in waiting)], [held[1], *(w[1] for w in waiting)]))


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(a, b, n, best) for each id pair linked anywhere: how many links hold it, and whether no pair of ``b`` has more."""
    counts = (aligned.select("pairs", "times").mapInArrow(_counting, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
              .select((F.expr(f"pair div {b_size}")).alias("a"), (F.col("pair") % b_size).alias("b"), "n"))
    spark = aligned.sparkSession
    path = staging_path(spark, "pair-counts")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _write_shard(uri: str):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        k = mix(t.column("pair").to_numpy().astype(np.uint64))
        order = np.argsort(k)
        hashstore.write(uri, key[0].as_py(), "keys", k[order])
        hashstore.write(uri, key[0].as_py(), "value", (t.column("n").to_numpy() * 2 + t.column("best").to_numpy())[order].astype(np.uint64))
        return pa.table({"written": pa.array([len(k)], pa.int64())})
    return run


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        k = mix(b.column("pair").to_numpy().astype(np.uint64))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hashstore.shard_of(k, SHARD_BITS))], [*b.schema.names, "shard"])


def _scored(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = hashstore.opened(uri, SHARD_BITS)
        for batch in batches:
            pairs, times, cut = _lists(batch)
            distinct, inverse = np.unique(pairs, return_inverse=True)
            keys = mix(distinct.astype(np.uint64))
            order = np.argsort(keys)
            value = np.zeros(len(keys), np.int64)
            value[order] = store.get(*store.find(keys[order]), "value").astype(np.int64)
            value = value[inverse]
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[cut])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), pa.array(sums(times)), pa.array(sums(times * (value & 1))),
                 pa.array(sums(times * (value >> 1))), batch.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Every text is encoded once; its counted pairs are written to the shared
    folder, summed over the corpus and looked up again. See :func:`align`
    for texts without tokens; ids may be null and may repeat. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    a_path, b_path = a_path or public_tokenizers.path(A_VOCABULARY), b_path or public_tokenizers.path(B_VOCABULARY)
    path, uri = staging_path(spark, "aligned"), staging_path(spark, "pair-store")
    align(docs, id_col, text_col, a_path, b_path, keep_groups=False).write.parquet(path)
    done = spark.read.parquet(path)
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    counts = pair_counts(done, b_size).select((F.col("a") * b_size + F.col("b")).alias("pair"), "n", "best")
    (counts.mapInArrow(_shards, "pair long, n long, best boolean, shard long").groupBy("shard")
     .applyInArrow(_write_shard(uri), "written long").agg(F.sum("written")).collect())
    return done.select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times").mapInArrow(
        _scored(uri), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
