"""Alignment, n-gram join and ranked search against their plain definitions."""

import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from panelflow.llm import align, ngrams, search
from panelflow.llm import queries as llm_queries
from tests.conftest import SF_SMALL
from tests.llm import brute


def plain_tokenizers():
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path(align.A_VOCABULARY))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.B_VOCABULARY))
    byte = align._byte_of_char()
    a_bytes = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab().items() if t != "<|endoftext|>"}
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    return lambda t: a.encode(t, add_special_tokens=False).ids, b.encode, a_bytes, b_bytes


@given(st.lists(st.integers(0, 60), max_size=80, unique=True), st.lists(st.integers(0, 60), max_size=80, unique=True), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_merge_path(x, y, step):
    a, b = np.array(sorted(x), np.int64), np.array(sorted(y), np.int64)
    got = align.merged(a, b, step)
    assert [(v, not k) for v, k in zip(sorted([*x, *y]), got)] == sorted([(v, False) for v in x] + [(v, True) for v in y])
    i, j = align.diagonals(a, b, step)
    assert (np.diff(i + j) <= step).all() and (np.diff(i + j)[:-1] == step).all() and (i[-1], j[-1]) == (len(a), len(b))


AWKWARD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "ﬁ ＡＢ é  x　y", "tab\tand\r\nlines\n\n", "\x00\x01 zero", "🙂🙃 emoji 👩‍👩‍👧", " lead", "trail  ",
           "日本語のテキスト", "'s 'LL don't", "a" * 3000, " " * 2000, "▁ mark ▁▁x"]


def test_alignment(spark, docs, texts, empty):
    rows = [(k, t) for k, t in enumerate([*texts, *AWKWARD])] + [(None, "One more"), (None, None), (3, "One more")]
    table = spark.createDataFrame([(k, t, "x", "y") for k, t in rows], "doc_id long, text string, n_a string, pairs string").repartition(3)
    expected = {}
    for (k, t), e in zip(rows, brute.alignment([t for _, t in rows], *plain_tokenizers())):
        expected.setdefault((k, t), e)
    got = align.report(table).collect()
    assert len(got) == len(rows)
    want = sorted((str(k), *e[:6], brute.sha(e[6]) if e[6] else "") for (k, t), e in ((r, expected[r]) for r in rows))
    assert sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == want
    full = {r.doc_id: r.groups for r in align.align(table.where("doc_id < 30 and doc_id <> 3")).collect()}
    assert all(full[k] == expected[k, t][6] for k, t in rows if k in full)
    assert align.report(empty).count() == 0 and align.align(empty).count() == 0


def test_alignment_over_small_pieces_and_full_counters(spark, monkeypatch):
    monkeypatch.setattr(align, "HELD_PAIRS", 5)
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "über", "gamma-ray", "x1y2"]) for _ in range(rng.randint(1, 60)))) for k in range(30)]
    got = {r.doc_id: r for r in align.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (k, _), e in zip(rows, brute.alignment([t for _, t in rows], *plain_tokenizers())):
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (*e[:6], brute.sha(e[6]))


def test_a_text_longer_than_a_pattern_matcher_takes(spark):
    r = align.report(spark.createDataFrame([(1, " " * 1_200_000 + "end")], "doc_id long, text string")).first()
    assert r.n_a and r.n_b and r.n_groups == r.n_links


def test_alignment_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = brute.alignment([r.text for r in docs], *plain_tokenizers())
    got = {r.doc_id: r for r in llm_queries.QUERIES["op13_align"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d, e in zip(docs, expected):
        r = got[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (*e[:6], brute.sha(e[6]) if e[6] else "")


def _ranked(spark, rows, items, **more):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string").repartition(3)
    asked = spark.createDataFrame([(*r, "x") for r in items], "item_id string, text string, rank string")
    return sorted((tuple(r) for r in search.search(search.build(docs), asked, **more).collect()), key=str)


@pytest.mark.parametrize("slice_terms, item_bytes", [(100_000, 1 << 20), (60, 200)])
def test_search(spark, texts, monkeypatch, slice_terms, item_bytes):
    monkeypatch.setattr(search, "SLICE_TERMS", slice_terms)
    monkeypatch.setattr(search, "ITEM_BYTES", item_bytes)
    rows = [(k, t) for k, t in enumerate([*texts, *AWKWARD, "Étage ÉTAGE w1 W1 w1"])] + [(None, "w1 w2"), (None, None), (3, "w5 w5"), (3, "w6")]
    items = [("a", "w1 w2 w3"), ("b", texts[9]), ("c", None), ("d", " ?! "), ("e", "nowhere"), ("f", "W5 the THE of"), ("f", "w6"), (None, "w7-w8_w9"), ("g", texts[-1])]
    assert _ranked(spark, rows, items) == sorted(brute.ranked(rows, items), key=str)
    assert _ranked(spark, rows, items, best=3) == sorted(brute.ranked(rows, items, 3), key=str)


def test_search_orders_ties_and_one_hot_length(spark, monkeypatch):
    monkeypatch.setattr(search, "SLICE_TERMS", 500)
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(4))) for k in rng.sample(range(1000), 300)]
    items = [(str(k), " ".join(rng.sample("abcdefghi", 3))) for k in range(12)]
    assert _ranked(spark, rows, items) == sorted(brute.ranked(rows, items), key=str)


def test_search_of_empty_tables(spark, empty):
    items = spark.createDataFrame([("a", "w1")], "item_id string, text string")
    assert search.report(empty, items).count() == 0 and search.report(empty.sparkSession.createDataFrame([(1, "w1")], "doc_id long, text string"), items.where("1 = 0")).count() == 0


def _joined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key string, n string").repartition(3)
    return sorted((tuple(r) for r in ngrams.report(df, **more).collect()), key=str)


def _near_copies(seed):
    """Chains and clusters of near copies, short texts, shared passages, rows that repeat an id or have none."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(60)}"
    passage = [word() for _ in range(30)]
    rows = [(None, None), (None, "A b C d"), (7, "a B c d"), (7, "other text of five words"), (8, " "), (9, ""), (10, "a b"), (11, "A B"), (12, "a b c")]
    k = 100
    for _ in range(8):
        base = [word() for _ in range(rng.choice([7, 9, 12, 60, 90]))]
        for _ in range(rng.choice([2, 5, 14])):
            if rng.random() < 0.5:                       # drifts away from the first
                base = list(base)
            w = base if rng.random() < 0.5 else list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(400)}"
            if rng.random() < 0.2:
                w = w + passage
            rows.append((k, " ".join(w)))
            k += rng.choice([0, 1, 1, 1])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(spark, seed):
    rows = _near_copies(seed)
    assert _joined(spark, rows) == sorted(brute.ngram_components(rows), key=str)


def test_ngram_join_at_another_size_and_similarity(spark):
    rows = _near_copies(5)
    assert _joined(spark, rows, size=2, similarity=Fraction(1, 2)) == sorted(brute.ngram_components(rows, 1, 2, 2), key=str)


def test_ngram_join_of_awkward_texts(spark, texts, empty):
    rows = [(k, t) for k, t in enumerate([*texts, *AWKWARD])]
    assert _joined(spark, rows) == sorted(brute.ngram_components(rows), key=str)
    assert ngrams.report(empty).count() == 0


def test_fragments_divide_the_order():
    ranks = np.random.default_rng(1).integers(0, 9, 1 << 12).astype(np.uint8)
    cuts = ngrams._cuts(ranks, 16)
    h = np.random.default_rng(2).integers(0, 1 << 63, 100_000, dtype=np.uint64) * np.uint64(2)
    sizes = np.bincount(np.searchsorted(cuts, ngrams._ordered(h, ranks), "right"), minlength=16)
    assert (np.diff(cuts.astype(np.float64)) > 0).all() and sizes.min() > 4000
